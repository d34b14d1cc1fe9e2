"""Conversation repair, chat formatting and spelling groups against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import clashing, docs

from listlens.llm import chat_format as CF
from listlens.llm import conversation_repair as CR
from listlens.llm import spelling_pivots as SP
from listlens.llm.shared import table

CHATS = "conv_id long, turn long, role string, text string"
SMALL = "/root/testdata/sf0.001"

# --- repair ---


def follows(roles: str) -> bool:
    return re.fullmatch("(s?(ua)+)?", roles) is not None


def every_repair(rows):
    """The cheapest audit by trying all edits, with at most one insertion before each row and at the end."""
    found = []
    for inserts in itertools.product("-ua", repeat=len(rows) + 1):
        for edits in itertools.product("DKUA", repeat=len(rows)):
            cost, audit, roles = 0, "", ""
            for i, (row, edit) in enumerate([*zip(rows, edits), (None, "")]):
                if inserts[i] != "-":
                    cost, audit, roles = cost + 2, audit + "I", roles + inserts[i]
                if edit == "D":
                    cost, audit = cost + 3, audit + "D"
                elif edit:
                    cost += row.truncated + (edit != "K") * 2 + 100 * row.goes
                    audit, roles = audit + ("K" if edit == "K" else "R"), roles + (row.initial if edit == "K" else edit.lower())
            if follows(roles):
                found.append((cost, audit))
    return min(found)


def test_repair_is_the_least_of_all_edits():
    r = random.Random(3)
    for _ in range(60):
        rows = tuple(CR.Row(r.choice("suax"), r.random() < 0.2, False) for _ in range(r.randint(0, 3)))
        rows = tuple(x._replace(truncated=not x.goes and r.random() < 0.4) for x in rows)
        assert CR.repair(rows) == every_repair(rows)


def test_blocks_join_to_the_repair_of_the_whole():
    r = random.Random(4)
    for _ in range(300):
        rows = tuple(CR.Row(r.choice("ssuuuaaax"), r.random() < 0.1, r.random() < 0.2) for _ in range(r.randint(0, 14)))
        cuts = sorted(r.randint(0, len(rows)) for _ in range(r.randint(0, 4)))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        assert CR.join_blocks([CR.block_ways(p) for p in parts]) == CR.repair(rows)


def plain_repair(rows):
    """Rows (turn, role, text) in order; strings instead of integers, whole paths instead of states alone."""
    seen, spec, n = set(), [], Counter()
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        blank, again = not bare, (role, text) in seen
        seen.add((role, text))
        cut = not blank and not again and bare[-1] not in ".!?"
        n.update(blank=blank, duplicate=again and not blank, truncated=cut)
        spec.append((role, text, blank or again, cut))
    n["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    may = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}

    def least(paths):
        out = {}
        for path in paths:
            q = path[2][-1][0][0] if path[2] else ""
            if q not in out or path[:2] < out[q][:2]:
                out[q] = path
        return list(out.values())

    def put(path, cost, letter, role, text):
        last = path[2][-1][0][0] if path[2] else ""
        return [(path[0] + cost, path[1] + letter, (*path[2], (role, text)))] if (last, role[:1]) in may else []

    def inserted(paths):
        return least(paths + [x for p in paths for role in ("user", "assistant") for x in put(p, 2, "I", role, "")])

    paths = [(0, "", ())]
    for role, text, goes, cut in spec:
        step = []
        for p in inserted(paths):
            step.append((p[0] + 3, p[1] + "D", p[2]))
            if not goes:
                step += put(p, cut, "K", role, text) + put(p, 2 + cut, "R", "user", text) + put(p, 2 + cut, "R", "assistant", text)
        paths = least(step)
    cost, audit, out = min((p for p in inserted(paths) if not p[2] or p[2][-1][0][0] == "a"), key=lambda p: p[:2])
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], cost, audit, digest)


def plain_op11(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        conv_text, turn_text = (" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    def order(x):
        return (x[0] is not None, x[0] or 0, x[1], hashlib.md5(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest())
    return {c: plain_repair(sorted(v, key=order)) for c, v in found.items()}


def odd_chats(r):
    roles, texts = ("system", "user", "assistant", "user", "assistant", "tool", None, ""), ("Yes.", "No!", "no", " \t", "", None, "Ü 😀?", "Same.", "long " * 3000)
    rows = [(c, r.choice((None, *range(12))), r.choice(roles), r.choice(texts)) for c in (None, -5, *range(20)) for _ in range(r.randint(1, 9))]
    long = [(77, t, r.choice(("user", "assistant")), f"Text {t % 50}{r.choice('.. ')}") for t in range(700)]
    return rows + long + [(78, 3, "user", "Copy.")] * 40


def by_conv(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[c] for c in names) for r in df.collect()}


def test_op11_over_odd_and_long_conversations(spark, monkeypatch):
    rows = odd_chats(random.Random(9))
    chats = clashing(spark.createDataFrame(rows, CHATS).repartition(5)).withColumns({c: F.lit(1) for c in ("conv", "kind", "copies", "turns", "ways", "n")})
    found = CR.op11(chats)
    assert found.count() == len({r[0] for r in rows})
    assert by_conv(found) == plain_op11(rows)


def test_op11_with_conversations_in_many_tasks(spark):
    rows = [(c, t, r, x) for c in (1, 2) for t, r, x in [(t, "user" if t % 3 else "assistant", f"Text {t}.") for t in range(1500)]]
    assert by_conv(CR.op11(spark.createDataFrame(rows, CHATS))) == plain_op11(rows)


def test_op11_whole_table_and_empty(spark):
    chats = table(spark, SMALL, "conversations")
    assert by_conv(CR.op11(chats)) == plain_op11([(r.conv_id, r.turn, r.role, r.text) for r in chats.collect()])
    assert CR.op11(chats.limit(0)).count() == 0


# --- formatting ---


def test_texts_come_back_from_the_characters():
    r = random.Random(2)
    bits = [*CF.CHAT.controls(), "\\", "a", "b", "\\a", "<", "[", "<s", " ", "\n", "é😀"]
    for _ in range(300):
        turns = [(r.choice(("system", "user", "assistant", "tool", "", "<s>")), "".join(r.choice(bits) for _ in range(r.randint(0, 8)))) for _ in range(r.randint(0, 5))]
        written = "".join(t for role, text in turns for t, _ in CF.turn_segments(CF.CHAT, role, text))
        assert list(CF.parse(CF.CHAT, written)) == turns
        for role, text in turns:
            assert not any(c in CF.CHAT.escaped(text) for c in CF.CHAT.controls())


def test_bad_templates_and_texts_are_refused():
    with pytest.raises(ValueError):
        CF.Template({"user": CF.Marks("\\u", "</u>")}, ("[", "|", "]"), {}, ())
    for text in ("hello", "<s>no end", "[INST] one</s>\n", "[ROLE x[/ROLE]\n"):
        with pytest.raises(ValueError):
            list(CF.parse(CF.CHAT, text))


def plain_op13(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in [*rows, *((-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant")))]:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, these in turns.items():
        these = [x[2:] for x in sorted(these)]
        learned = "".join(t for role, t in these if role == "assistant")
        roles = " ".join(role for role, _ in these)
        chars = 0
        for role, text in these:
            marks = {"system": "<<SYS>>\n<</SYS>>\n", "user": "[INST] [/INST]\n", "assistant": "<s></s>\n"}.get(role, f"[ROLE [SAYS][/ROLE]\n{re.sub(r'[<\[\\]', '..', role)}")
            chars += len(marks) + len(re.sub(r"[<\[\\]", "..", text))
        sha = hashlib.sha256("".join(f"{role}\n{t}\n" for role, t in these).encode()).hexdigest()
        valid = re.fullmatch(r"(system )?user assistant( user assistant)*", roles) is not None
        out[conv] = (len(these), sha, len(learned), hashlib.sha256(learned.encode()).hexdigest(), chars, valid)
    return out


def test_op13_over_odd_conversations(spark, tmp_path):
    rows = [*odd_chats(random.Random(1)), (5, 99, "assistant", "\\ </s> <s>"), (6, 1, "<s>", "[ROLE x[SAYS]y[/ROLE]\n")]
    for i, some in enumerate((rows, [])):
        where = str(tmp_path / str(i))
        clashing(spark.createDataFrame(some, CHATS)).withColumns({c: F.lit(1) for c in ("conv", "place", "segments")}).write.parquet(f"{where}/conversations.parquet")
        found = CF.op13(spark, where)
        assert {r[0]: tuple(r[1:]) for r in found.collect()} == plain_op13(some)


def test_stored_segments_are_read_in_any_order(spark, tmp_path):
    chats = table(spark, SMALL, "conversations")
    CF.segments(chats).repartition(7).write.parquet(str(tmp_path / "s"))
    found = CF.read_back(spark.read.parquet(str(tmp_path / "s")))
    want = plain_op13([(r.conv_id, r.turn, r.role, r.text) for r in chats.collect()])
    assert {int(r[0][1:]): tuple(r[1:]) for r in found.collect()} == {k: v for k, v in want.items() if k >= 0}


# --- spelling ---


def plain_words(rows):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            seen[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[start + 1 :] == b[start + 1 :] if len(a) == len(b) else max(a, b, key=len)[start + 1 :] == min(a, b, key=len)[start:]


def plain_groups(words):
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_pivots_are_the_cheapest_disjoint_grams():
    r = random.Random(8)
    for _ in range(300):
        places = sorted(r.sample(range(9), r.randint(2, 7)))
        cost = [r.randint(0, 9) for _ in places]
        price = dict(zip(places, cost))
        pairs = [(price[a] + price[b], (a, b)) for a, b in itertools.combinations(places, 2) if b - a >= 2]
        assert SP.pick(places, cost) == (min(pairs)[1] if pairs else ())


def test_groups_are_those_of_all_pairs(spark):
    r = random.Random(6)
    words = {"".join(r.choice("abé") for _ in range(r.randint(5, 7))): r.randint(1, 60) for _ in range(500)} | {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "日本語日本語": 1, "日本語日本": 2}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert {tuple(x) for x in SP.group(df).collect()} == plain_groups(words)


def test_op12_odd_rows(spark):
    texts = ["Straße STRASSE straße naïve naive naïves × ÷÷÷÷÷", None, "", "aaaaa " * 9 + "aaaab " * 4 + "aaaaab" * 2, "日本語 Ünïcode, ünïcode; Ünïcodes\ud800"[:-1], "hello" * 2000]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts * 5)]
    assert {tuple(x) for x in SP.op12(clashing(docs(spark, rows)).withColumn("word", F.lit("x"))).collect()} == plain_groups(plain_words(rows))
    assert SP.op12(docs(spark, rows).limit(0)).count() == 0
