"""WARC salvage, pseudonyms, multiset hashes, mixing and the pipeline against plain versions."""

import base64
import glob
import hashlib
import io
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import DOC_SCHEMA, ODD, clashing, docs, prose

import corpus_pipeline
from listlens.llm import exact_dedup as ED
from listlens.llm import mixing_budget as MB
from listlens.llm import multiset_hash as MH
from listlens.llm import pii_feistel as PF
from listlens.llm import warc_salvage as WS

# --- WARC ---


def members(n, zipped=True):
    records = [WS.record_bytes(str(i), f"http://x/{i}", prose(i, 50 + i).encode(), None, False) for i in range(n)]
    return [WS.gzip_member(r) if zipped else r for r in records]


def read(data, zipped=True):
    return list(WS.salvage(io.BytesIO(data), zipped))


def keys(found):
    return [x["record_key"] for x in found if x["kind"] == "record"]


@pytest.mark.parametrize("zipped", [True, False])
def test_intact_file(zipped):
    found = read(b"".join(members(20, zipped)), zipped)
    assert keys(found) == [str(i) for i in range(20)]
    assert [x["payload"] for x in found] == [prose(i, 50 + i).encode() for i in range(20)]
    assert read(b"", zipped) == []


@pytest.mark.parametrize("zipped", [True, False])
@pytest.mark.parametrize("block", [7, 1 << 20])
def test_damage_is_skipped_and_logged(zipped, block, monkeypatch):
    monkeypatch.setattr(WS, "READ_BYTES", block)
    parts = members(12, zipped)
    junk = b"\x1f\x8b\x08" + b"WARC/1.1\r\nnot a record" * 3
    broken = bytearray(parts[3])
    broken[len(broken) // 2] ^= 0xFF
    cut = parts[7][: len(parts[7]) // 2]
    data = junk + b"".join(parts[:3]) + bytes(broken) + b"".join(parts[4:7]) + cut + b"".join(parts[8:]) + parts[0][:-5]
    found = read(data, zipped)
    assert keys(found) == [str(i) for i in range(12) if i not in (3, 7)]
    at = 0
    for x in found:  # records and gaps are the whole file, in order
        assert x["offset"] == at
        at += x["length"]
    assert at == len(data)
    assert [x["length"] for x in found if x["kind"] == "gap"] == [len(junk), len(broken), len(cut), len(parts[0]) - 5]


def test_every_flipped_byte_costs_one_record_at_most():
    parts = members(3)
    data = b"".join(parts)
    for at in range(0, len(data), 11):
        bad = bytearray(data)
        bad[at] ^= 0x55
        assert len(keys(read(bytes(bad)))) >= 2


def test_garbage_only():
    found = read(b"nothing here" * 100)
    assert [(x["kind"], x["offset"], x["length"]) for x in found] == [("gap", 0, 1200)]


PAGE_SCHEMA = "page_id long, url string, html string"
PAGES = [(1, "u", "same"), (2, None, "same"), (3, "h://ü x", "<p>é😀"), (4, "u", None), (5, "u", ""), (None, "u", "same"), (None, "u", None), (7, "u", "x" * 300_000), (8, "u", "solo"), (8, "u", "solo")]


def plain_warc(rows):
    top = {}
    for i, _, t in rows:
        if i is not None:
            top[t or ""] = max(i, top.get(t or "", i))
    out = []
    for i, _, t in rows:
        b = (t or "").encode()
        again = top.get(t or "") != i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", top.get(t or "") if again else None))
    return sorted(out, key=repr)


def test_warc_query(spark):
    pages = spark.createDataFrame(PAGES, PAGE_SCHEMA).withColumns({n: F.lit("x") for n in ("revisit", "refers_to", "kind", "file")})
    assert sorted(map(tuple, WS.op2(pages).collect()), key=repr) == plain_warc(PAGES)
    assert WS.op2(spark.createDataFrame([], PAGE_SCHEMA)).count() == 0


def test_archive_files_and_gaps(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", prose(i, 200)) for i in range(40)], PAGE_SCHEMA)
    folder = f"file://{tmp_path}/w"
    manifest = WS.write_archives(WS.with_revisits(pages, "page_id", "html"), folder, "page_id", "html", "url", file_bytes=2_000)
    assert manifest.agg(F.sum("records")).first()[0] == 40 and manifest.count() > 4
    victim = sorted(glob.glob(f"{tmp_path}/w/*.gz"))[0]
    data = bytearray(open(victim, "rb").read())
    data[40] ^= 0xFF
    open(victim, "wb").write(bytes(data))
    found = WS.read_archives(WS.files_below(spark, folder)).cache()
    assert found.where("kind = 'record'").count() == 39
    gap = found.where("kind = 'gap'").collect()
    assert len(gap) == 1 and gap[0].offset == 0 and gap[0].length > 40
    assert {bytes(r.payload).decode() for r in found.where("kind = 'record'").collect()} < {prose(i, 200) for i in range(40)}


# --- pseudonyms ---

PII = "card 4041894974608795, again 4041-8949-7460-8795; bad 4041894974608796. iban DE89 3704 0044 0532 0130 00 on 2024-02-29 or 29.02.2024, not 2023-02-29; ip 42.144.35.254 no 300.1.1.1 ssn 123-45-6789 call +1 (988) 555-2485 mail bosbt.42@mail8.example.com."


def run_pii(spark, rows, undo=False):
    return {r.id: r for r in PF.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), PF.TEST_KEY, undo=undo).collect()}


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def test_pseudonyms(spark):
    got = run_pii(spark, [(1, PII), (2, "x " + PII), (3, None), (4, ""), (5, "nothing")])
    text = got[1].text
    for value in ("4041894974608795", "4041-8949-7460-8795", "3704 0044", "2024-02-29", "29.02.2024", "42.144.35.254", "123-45-6789", "555-2485", "bosbt.42"):
        assert value not in text
    for kept in ("bad 4041894974608796", "not 2023-02-29", "no 300.1.1.1", "@mail8.example.com", "+1 ("):
        assert kept in text
    shape = lambda t: re.sub("[a-z]", "a", re.sub(r"\d", "0", re.sub(r"ip \d+\.\d+\.\d+\.\d+", "ip", t)))
    assert shape(text) == shape(PII)
    finds = [(f.kind, f.value) for f in got[1].finds]
    assert [k for k, _ in finds] == ["card", "card", "iban", "date", "date", "ipv4", "ssn", "phone", "email"]
    values = [v for _, v in finds]
    assert luhn(values[0]) and values[0] == values[1].replace("-", "")
    iban = values[2].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert values[4] == ".".join(values[3].split("-")[::-1])
    assert all(int(p) < 256 for p in values[5].split("."))
    assert [f.value for f in got[2].finds] == values  # equal values stay linked
    assert got[3].text is None and got[3].finds == [] and got[4].text == "" and got[5].text == "nothing"
    back = run_pii(spark, [(1, text)], undo=True)
    assert back[1].text == PII


BESIDE = [
    "4111111111111111 12/27", "4111 1111 1111 1111 123", "no. 12 4111 1111 1111 1111", "4111-1111-1111-1111", "1234 5678 4111 1111 1111 1111",
    "4111111111111111 2024-02-29", "3782 822463 10005", "4111111111111111\n", "7 4111111111111111 12 5555555555554444",
]


def test_cards_beside_other_numbers(spark):
    got = run_pii(spark, list(enumerate(BESIDE)))
    values = {i: [f.value for f in r.finds if f.kind == "card"] for i, r in got.items()}
    assert [len(values[i]) for i in range(len(BESIDE))] == [1, 1, 1, 1, 1, 1, 1, 1, 2]
    assert len({re.sub(r"\D", "", values[i][0]) for i in (0, 1, 2, 3, 4, 5, 7, 8)}) == 1  # linked whatever stands beside
    assert all(luhn(v) for vs in values.values() for v in vs)
    for i, text in enumerate(BESIDE):
        bare = re.sub(r"\D", "", got[i].text)
        assert "4111111111111111" not in bare and "378282246310005" not in bare and len(got[i].text) == len(text)
    assert got[0].text.endswith(" 12/27") and got[1].text.endswith(" 123") and got[2].text.startswith("no. 12 ") and got[4].text.startswith("1234 5678 ")
    assert [f.kind for f in got[5].finds] == ["card", "date"]
    back = run_pii(spark, [(i, r.text) for i, r in got.items()], undo=True)
    assert [back[i].text for i in range(len(BESIDE))] == BESIDE


def test_accounts_with_letters_and_month_first_dates(spark):
    texts = ["NL91 ABNA 0417 1643 00", "NL91ABNA0417164300", "GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32", "12/25/1980", "1980-12-25", "25/12/1980", "13/13/1980", "03/04/1980"]
    got = run_pii(spark, list(enumerate(texts)))
    assert [[f.kind for f in got[i].finds] for i in range(9)] == [["iban"]] * 3 + [[]] + [["date"]] * 3 + [[], ["date"]]
    assert got[0].text.replace(" ", "") == got[1].text != texts[1] and got[2].text[5:9] == "WEST"
    for i in (0, 1, 2):
        account = got[i].text.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1
    m, d, y = got[4].text.split("/")
    assert got[5].text == f"{y}-{m}-{d}" and got[6].text == f"{d}/{m}/{y}" and got[5].text != texts[5] and int(d) > 12
    assert int(got[8].text[:2]) <= 12
    back = run_pii(spark, [(i, r.text) for i, r in got.items()], undo=True)
    assert [back[i].text for i in range(9)] == texts


def test_email_moves_depend_on_the_whole_name(spark):
    names = [f"{a}{b}.Box{a}" for a in "abc" for b in "xyz"] + ["q", "ab"]
    got = run_pii(spark, [(i, f"to {n}@example.com now") for i, n in enumerate(names)])
    moved = [got[i].finds[0].value.split("@")[0] for i in range(len(names))]
    assert len(set(moved)) == len(names) and all(len(m) == len(n) for m, n in zip(moved, names))
    shifts = {tuple((ord(y) - ord(x)) % 26 for x, y in zip(n, m) if x.islower()) for n, m in zip(names[:9], moved)}
    assert len(shifts) == 9  # no two addresses of a length move alike
    back = run_pii(spark, [(i, r.text) for i, r in got.items()], undo=True)
    assert [back[i].text for i in range(len(names))] == [f"to {n}@example.com now" for n in names]


def test_another_key_gives_other_pseudonyms(spark):
    rows = spark.createDataFrame([(1, PII)], "doc_id long, text string")
    assert PF.pseudonymise(rows, "another key").first().text != PF.pseudonymise(rows, PF.TEST_KEY).first().text


def test_feistel_is_a_permutation(spark):
    rows = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d")).select("d", PF.feistel(F.col("d"), F.lit("t"), PF.TEST_KEY).alias("p"))
    got = rows.select("d", "p", PF.feistel(F.col("p"), F.lit("t"), PF.TEST_KEY, undo=True).alias("b")).collect()
    assert len({r.p for r in got}) == 1000 and all(len(r.p) == 3 and r.b == r.d for r in got)
    assert sum(r.p == r.d for r in got) < 10
    long = spark.createDataFrame([(str(10**29 + i),) for i in range(50)], "d string").select("d", PF.feistel(F.col("d"), F.lit("t"), PF.TEST_KEY).alias("p"))
    assert all(len(r.p) == 30 and r.p != r.d for r in long.collect())


def test_pii_odd_rows(spark):
    got = PF.op6(clashing(docs(spark, ODD)).drop("text_sha256")).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(ODD, key=repr)
    assert PF.op6(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


# --- multiset hash ---


def vectors(spark, lists):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, parts array<string>")
    return {r.i: list(r.v) for r in MH.with_vector(df, F.col("parts"), "v").collect()}


def plain_vector(parts):
    """Lanes by their own definition: each counts the paragraphs whose bit is one, modulo 2^14."""
    lanes = [0] * 256
    for p in parts:
        h = hashlib.sha256(p.encode()).digest()
        for w in range(4):
            word = int.from_bytes(h[8 * w : 8 * w + 8], "big")
            for shift in range(16):
                for quarter in range(4):
                    lanes[(w * 16 + shift) * 4 + quarter] += word >> (shift + 16 * quarter) & 1
    lanes = [x % 2**14 for x in lanes]
    packed = [sum(lanes[4 * i + q] << (16 * q) for q in range(4)) for i in range(64)]
    return packed + [len(parts) % 65536]


def test_vector_is_a_multiset_sum(spark):
    a, b = [prose(i, 5) for i in range(9)], [prose(i, 5) for i in range(4, 15)]
    got = vectors(spark, [a, a[::-1], a + b, a + a, [""]])
    assert got[0] == got[1] == plain_vector(a)
    assert got[2] == plain_vector(a + b) and got[3] == plain_vector(a + a) and got[3] != got[0] and got[4] == plain_vector([""])


def test_lanes_wrap_without_carry(spark):
    many = ["same"] * 20_000
    assert vectors(spark, [many])[0] == plain_vector(many)


def test_insert_and_delete(spark):
    df = spark.createDataFrame([(["a", "b"], ["c", "b"], ["a", "b", "c", "b"])], "x array<string>, y array<string>, both array<string>")
    v = df
    for c in df.columns:
        v = MH.with_vector(v, F.col(c), f"v_{c}")
    v = v.select(*[F.col(f"v_{c}").alias(c) for c in df.columns])
    r = v.select((MH.combine(F.col("x"), F.col("y")) == F.col("both")).alias("i"), (MH.combine(F.col("both"), F.col("y"), False) == F.col("x")).alias("d")).first()
    assert r.i and r.d


def plain_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        h = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[: len(t) - h] + after[:h]).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_rows", [8000, 3])
def test_edits(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(MH, "BUCKET_ROWS", bucket_rows)
    rows = ODD + [(i * i, prose(i, 30).replace(" ", ". ")) for i in range(13, 60)]
    got = MH.op8(clashing(docs(spark, rows))).cache()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got.collect()), key=repr) == plain_edits(rows)
    for r in got.collect():
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) <= (r.near_edited == 1)
    many = [r for r in got.collect() if r.doc_id and r.doc_id >= 169]
    assert sum(r.near_edited - r.near_next for r in many) / len(many) > 0.3
    one = MH.op8(docs(spark, [(1, "abc")])).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"aba").hexdigest()
    assert MH.op8(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


# --- mixing ---


def pour(budget, nodes):
    """Water-filling by repetition: full children leave, the rest divide what remains by weight."""
    out, open_ = {}, dict(nodes)
    while open_:
        w = sum(x[1] for x in open_.values())
        full = {k: x for k, x in open_.items() if x[0] * w <= x[1] * budget}
        if not full:
            return out | {k: x[1] * budget // w for k, x in open_.items()}
        k = min(full, key=lambda k: (full[k][0] / full[k][1], k))
        out[k] = full[k][0]
        budget -= full[k][0]
        del open_[k]
    return out


def test_water_filling(spark):
    r = random.Random(4)
    for _ in range(4):
        nodes = {f"n{i}": (r.choice([0, r.randint(0, 50), 100, r.randint(0, 10_000)]), r.randint(1, 9)) for i in range(12)}
        budget = r.randint(0, sum(c for c, _ in nodes.values()))
        df = spark.createDataFrame([(k, c, w, budget) for k, (c, w) in nodes.items()], "name string, cap long, weight long, parent_budget long")
        assert {x.name: x.budget for x in MB.share_out(df, [], "name").collect()} == pour(budget, nodes)


def test_shortage_stays_with_siblings(spark):
    leaves = spark.createDataFrame(
        [("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 1000), ("b", "x", "s4", 1000)], "domain string, lang string, source string, tokens long"
    )
    got = {r.source: r.budget for r in MB.leaf_budgets(leaves, F.lit(400), 1, {}).collect()}
    assert got == {"s1": 10, "s2": 90, "s3": 100, "s4": 200}


def plain_mix(rows, share, epochs):
    domains = list(MB.DOMAIN_WEIGHTS)
    leaf, tok = {}, {}
    for n, (_, text, lang, source) in enumerate(rows):
        m = re.search(r"(\d{1,9})$", source or "")
        leaf[n] = (domains[int(m[1]) % 4] if m else "unknown", lang or "unknown", source or "unknown")
        tok[n] = len((text or "").encode().split())
    total = defaultdict(int)
    for n in leaf:
        total[leaf[n]] += tok[n]
    budgets = {(): math.floor(sum(total.values()) * share)}
    weights = (MB.DOMAIN_WEIGHTS, MB.LANG_WEIGHTS, {})
    for level in range(3):
        for parent in [p for p in budgets if len(p) == level]:
            cap = defaultdict(int)
            for k, t in total.items():
                if k[:level] == parent:
                    cap[k[level]] += t * epochs
            for k, b in pour(budgets[parent], {k: (c, weights[level].get(k, 1)) for k, c in cap.items()}).items():
                budgets[(*parent, k)] = b
    out = []
    for k in total:
        full, rest = divmod(budgets[k], total[k]) if total[k] else (0, 0)
        mine = [n for n in leaf if leaf[n] == k]
        draw = {n: hashlib.md5(f"{MB.SEED}:{full}:{'' if rows[n][0] is None else rows[n][0]}".encode()).hexdigest()[:15] for n in mine}
        for n in mine:
            run = sum(tok[m] for m in mine if draw[m] <= draw[n])
            out.append((rows[n][0], *k, tok[n], budgets[k], full + (run <= rest)))
    return sorted(out, key=repr)


def test_mixing(spark):
    r = random.Random(8)
    rows = [(i, prose(i, r.randint(0, 60)), r.choice(["en", "de", "fr", None]), r.choice(["src0"] * 5 + ["src1", "src2", "web", None, "src17"])) for i in range(400)]
    rows += [(5, "again", "en", "src0"), (None, "a b", "en", "src0"), (None, None, "en", "src0"), (500, "", "en", "src1")]
    df = clashing(docs(spark, rows))
    assert sorted(map(tuple, MB.op10(df).collect()), key=repr) == plain_mix(rows, MB.QUERY_SHARE, 2)
    assert MB.op10(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    for share in (0.0, 1.7, 2.0):
        got = MB.mix(df, share).select("id", *MB.LEAF, "n_tokens", "leaf_budget", "copies").collect()
        assert sorted(map(tuple, got), key=repr) == plain_mix(rows, share, 2)


def test_mixing_stage_repeats_rows(spark):
    rows = [(i, prose(i, 20), "en", "src0") for i in range(50)] + [(i, prose(i, 20), "de", "src1") for i in range(50, 60)]
    want = {i: c for i, *_, c in plain_mix(rows, MB.STAGE_SHARE, 2)}
    got = defaultdict(int)
    for r in MB.stage(docs(spark, rows)).collect():
        got[r.doc_id] += 1
    assert got == {i: c for i, c in want.items() if c}


# --- native operators use no Python ---


@pytest.mark.parametrize("op", [PF.op6, MH.op8, MB.op10])
def test_native(spark, op):
    plan = op(docs(spark, ODD))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- the pipeline ---


def test_pipeline(spark):
    d = "/root/testdata/sf0.001"
    before = spark.read.parquet(f"{d}/documents.parquet")
    now = before
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.store(stage(spark, now, d))
        assert after.columns == before.columns and after.exceptAll(before.join(after.select("doc_id").groupBy("doc_id").count(), "doc_id").withColumn("_", F.explode(F.expr("sequence(1, count)"))).select(*before.columns)).count() == 0
        if name == "exact_dedup":
            assert after.count() == now.select(ED.normalised(F.col("text"))).distinct().count()
        now = after
    got = sorted(map(tuple, corpus_pipeline.run(spark, d).collect()))
    assert [r[0] for r in got] == sorted(r.doc_id for r in now.select("doc_id").collect())
