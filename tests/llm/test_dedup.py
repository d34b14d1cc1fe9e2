"""Exact dedup and SimHash near-dedup against plain versions."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests.llm.helpers import DOC_SCHEMA, ODD, clashing, docs, prose

from listlens.llm import exact_dedup as ED
from listlens.llm import simhash_bk as SH


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_perfect_hash_is_minimal_and_checked():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    sizes, bits, slots = ED.build_hash(keys)
    assert sorted(slots.tolist()) == list(range(5000))
    assert (ED.look_up(sizes, bits, keys) == slots).all()
    assert ED.build_hash([])[0] == [] and len(ED.look_up([], np.zeros(0, bool), keys[:3])) == 3


def plain_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        g = groups[norm(t)]
        ids = [x for x in g if x is not None]
        out.append((i, min(ids) if ids else None, len(g), hashlib.sha256(norm(t).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("extra", [False, True])
def test_exact_dedup(spark, extra):
    df = docs(spark, ODD)
    got = ED.op1(clashing(df) if extra else df).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == sorted(plain_dedup(ODD), key=repr)
    by_text = defaultdict(list)
    for r in got:
        by_text[r.text_sha256].append(r)
    for g in by_text.values():
        assert sum(r.kept for r in g) == 1
        assert all(r.doc_id == r.keep_id for r in g if r.kept)


def test_exact_dedup_any_history_and_string_ids(spark):
    rows = [("b", "one"), ("a", "one"), ("c", "two"), (None, "two"), ("d", "three")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    for history in (F.lit(True), F.lit(False), F.col("id") > "a"):
        got = {(r.id, r.keep_id, r.group_size, r.kept) for r in ED.dedup(df, history).collect()}
        assert got == {("b", "a", 2, False), ("a", "a", 2, True), ("c", "c", 2, True), (None, "c", 2, False), ("d", "d", 1, True)}


def test_empty(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert ED.op1(empty).count() == 0 and ED.stage(empty).columns == empty.columns
    assert SH.op4(empty).count() == 0 and SH.stage(empty).count() == 0


def test_exact_stage_keeps_one_of_each(spark):
    df = docs(spark, ODD)
    got = ED.stage(clashing(df))
    assert got.columns == clashing(df).columns
    texts = [norm(r.text) for r in got.collect()]
    assert len(texts) == len(set(texts)) == len({norm(t) for _, t in ODD})


# --- SimHash ---


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, radius=2):
    fp = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return [(k, f"{fp[i]:016x}", least.get(root(i))) for i, (k, _) in enumerate(rows)]


def near_rows(n=60):
    rows = []
    for i in range(n):
        base = prose(i % 20, 200 + i % 7).split()
        if i >= 20:
            base[i] = "changed"
        if i >= 40:
            base[5] = "again"
        rows.append((i * 3, " ".join(base)))
    return rows


def test_simhash(spark):
    rows = ODD + near_rows()
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in SH.op4(clashing(docs(spark, rows))).collect()), key=repr)
    assert got == sorted(plain_components(rows), key=repr)


def test_word_blocks_do_not_change_a_fingerprint(monkeypatch):
    text = prose(4, 3000)
    whole = SH.fingerprint(text)
    monkeypatch.setattr(SH.word_blocks, "__defaults__", (50,))
    assert SH.fingerprint(text) == whole == plain_fingerprint(text)


def test_tree_finds_what_brute_force_finds():
    r = np.random.default_rng(3)
    values = np.unique(np.concatenate([r.integers(0, 2**63, 300, dtype=np.uint64), (1 << r.integers(0, 12, 200)).astype(np.uint64), r.integers(0, 64, 60, dtype=np.uint64)]))
    r.shuffle(values)
    for radius in (0, 1, 2, 5):
        found = {(int(q), int(v)) for a, b in SH.BkTree(values).within(values, radius) for q, v in zip(values[a], values[b])}
        assert found == {(int(a), int(b)) for a in values for b in values if (int(a) ^ int(b)).bit_count() <= radius}


def test_parts_lose_no_link(spark):
    """A shard that is cut into many parts links the same components."""
    values = [(i * 5) ^ (i << 40) for i in range(400)]
    fps = spark.createDataFrame([(v,) for v in set(values)], "fp long")
    whole, cut = (
        {(r.node, r.root) for r in SH.components(SH.links(fps, part_rows=n)).distinct().collect()} for n in (10_000, 16)
    )
    assert whole == cut


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (201, 200)], "a long, b long")
    got = dict(map(tuple, SH.components(edges).distinct().collect()))
    assert got == {**{i: 0 for i in range(101)}, 200: 200, 201: 200}


def test_near_stage(spark):
    rows = near_rows()
    stays = {c for _, _, c in plain_components(rows)}
    assert {r.doc_id for r in SH.stage(docs(spark, rows)).collect()} == stays
