"""BPE, lattice model, toxicity and substring dedup against libraries and plain versions."""

import hashlib
import json
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import DOC_SCHEMA, ODD, clashing, docs, prose

from listlens.llm import bpe_segtree as BP
from listlens.llm import lattice_lm as LM
from listlens.llm import substring_cms as SC
from listlens.llm import toxicity as TX
from listlens.llm.shared import table

# --- BPE ---

TEXTS = [
    "", " ", "Hello, World! it's 2024", "a<|endoftext|>B <|startoftext|>x", "ΑΣ ΣΑΣ İı ẞ ﬁ", "\x1c\x1d a\x1fb\x85c de f 'S I'LL 'Ve x'd 12³ ½ é ÅÅ",
    "日本語 😀😀", "x" * 5000, "ab" * 700 + "!!!", "l'été où naïf", prose(3, 500), "▁ ﻿ ‍",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BP.default_vocabulary())


def test_bpe_is_the_library(tokenizer):
    bpe = BP.Bpe(json.load(open(BP.default_vocabulary())))
    want = [e.ids for e in tokenizer.encode_batch(TEXTS, add_special_tokens=False)]
    assert bpe.encode_all(TEXTS) == want == [bpe.encode(t) for t in TEXTS]
    assert [bpe.decode(i) for i in want] == [tokenizer.decode(i, skip_special_tokens=False) for i in want]


def test_one_tree_and_many_trees_agree():
    bpe = BP.Bpe(json.load(open(BP.default_vocabulary())))
    r = random.Random(5)
    pieces = ["".join(r.choice("aeinorst") for _ in range(r.randint(1, 120))) for _ in range(300)] + ["aaaaaaaa", "abababab"]
    assert bpe.merge_all(pieces) == [bpe.merge(bpe.symbols(p)) for p in pieces]


def test_rank_tree():
    r = random.Random(1)
    ranks = [r.randint(0, 50) for _ in range(700)]
    tree = BP.RankTree(list(ranks))
    for _ in range(500):
        i, x = r.randrange(700), r.randint(0, 60)
        ranks[i] = x
        tree.put(i, x)
        assert tree.least() == min(ranks) and tree.leftmost(tree.least()) == ranks.index(min(ranks))


def test_bpe_query(spark, tokenizer):
    rows = ODD + list(enumerate(TEXTS, 100))
    got = BP.op9(clashing(docs(spark, rows))).collect()
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    encoded = BP.tokenise(docs(spark, rows), BP.default_vocabulary())
    assert BP.detokenise(encoded, BP.default_vocabulary()).count() == len(rows)
    assert BP.op9(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


# --- lattice ---


def all_paths(chars, pieces):
    """Sum over all segmentations, by brute force."""
    if not chars:
        return 1.0
    total = 0.0
    for n in range(1, len(chars) + 1):
        p = "".join(chars[:n])
        w = pieces.get(p, 0.0)
        if n == 1:
            w += math.prod(pieces[b] for b in p.encode())
        if w:
            total += w * all_paths(chars[n:], pieces)
    return total


def small_lattice():
    names = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab"]
    r = np.random.default_rng(2)
    weights = r.random(len(names) + 257)
    weights = np.log(weights / weights.sum())
    return names, weights


@pytest.mark.parametrize("word", ["a", "ab", "abab", "abaabab", "éa", "日"])
def test_lattice_sums_all_segmentations(word):
    names, weights = small_lattice()
    p = {n: math.exp(w) for n, w in zip(names, weights)} | {b: math.exp(weights[len(names) + b]) for b in range(256)}
    lattice = LM.Lattice(names, weights)
    want = math.log(all_paths(["▁", *word], p))
    assert lattice.many([word])[word] == pytest.approx(want, abs=1e-9) == pytest.approx(lattice.one(word), abs=1e-9)


def test_many_and_one_agree_and_mark_in_a_word_is_bytes():
    names, weights = small_lattice()
    lattice = LM.Lattice(names, weights)
    words = ["a▁b", "b" * 30, "ab" * 100, "x", "aba"]
    got = lattice.many(words)
    assert all(got[w] == pytest.approx(lattice.one(w), abs=1e-9) for w in words)


def test_expected_uses_raise_the_likelihood():
    names, weights = small_lattice()
    counts = {"abab": 5, "ba": 3, "aab": 2}
    now = weights
    before = -math.inf
    for _ in range(5):
        lattice = LM.Lattice(names, now)
        p = lattice.many(counts)
        total = sum(n * p[w] for w, n in counts.items())
        assert total >= before - 1e-9
        before = total
        e = lattice.expected(counts) + 1e-12
        now = np.log(e / e.sum())


@pytest.mark.parametrize("word", ["ab" * 60, "éa▁b" * 30, "x" * 49])
def test_long_words_are_fitted_whole(word, monkeypatch):
    names, weights = small_lattice()
    lattice = LM.Lattice(names, weights)
    alone, likelihood = lattice.expected({word: 3, "ab": 2}), lattice.log_likelihood
    monkeypatch.setattr(LM, "LONGEST_TOGETHER", 1000)
    together = lattice.expected({word: 3, "ab": 2})
    assert np.allclose(alone, together, rtol=1e-9, atol=1e-12) and likelihood == pytest.approx(lattice.log_likelihood)
    assert likelihood == pytest.approx(3 * lattice.one(word) + 2 * lattice.one("ab"))


def plain_log_p(word, at):
    """Forward recursion over characters, written plainly."""
    chars = ["▁", *word]
    alpha = [1.0] + [0.0] * len(chars)
    for e in range(1, len(chars) + 1):
        alpha[e] = alpha[e - 1] * math.prod(at[b] for b in chars[e - 1].encode())
        for b in range(e):
            if "▁" not in chars[max(b, 1):e]:
                alpha[e] += alpha[b] * at.get("".join(chars[b:e]), 0.0)
    return math.log(alpha[-1])


def test_query_scores_equal_a_plain_recursion(spark, monkeypatch):
    line = "no-space-" * 12
    rows = [(i, prose(i, 30) + (f" {line}" if i % 2 else "") + f" only{i}here") for i in range(40)] + [(50, None), (51, ""), (None, "odd row")]
    table = docs(spark, rows)
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    pieces, weights = LM.train(LM.word_counts(table.where(~LM.held_out(table["doc_id"]))), LM.default_vocabulary())
    at = {p: math.exp(w) for p, w in zip(pieces, weights)} | {b: math.exp(weights[len(pieces) + b]) for b in range(256)}
    words = lambda t: [w.decode() for w in (t or "").encode().lower().split()]
    want = {i: (out(i), (sum(plain_log_p(w, at) for w in words(t)) + weights[-1]) / math.log(10)) for i, t in rows}
    for most in (LM.HOT_WORDS, 3):  # by broadcast, and by join
        monkeypatch.setattr(LM.hot_words, "__defaults__", (most,))
        got = {r.doc_id: (r.held_out, r.score) for r in LM.op7(table).collect()}
        assert got.keys() == want.keys() and any(h for h, _ in got.values())
        assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1], rel=1e-9) for i in want)


def test_fitting_goes_on_while_it_gains(spark):
    counts = LM.word_counts(docs(spark, [(i, prose(i, 60)) for i in range(40)])).persist()
    words = {r.word: r.c for r in counts.collect() if r.word}

    def likelihood(gain):
        return sum(n * p for n, p in zip(words.values(), map(LM.Lattice(*LM.train(counts, LM.default_vocabulary(), gain)).one, words)))

    assert likelihood(0.5) < likelihood(0.01) < likelihood(0.001)


def test_lattice_query_base_columns(spark):
    rows = ODD + [(i, prose(i, 50)) for i in range(20, 60)]
    got = LM.op7(clashing(docs(spark, rows))).collect()
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + [""]
    c = Counter(w for i, t in rows if not out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = [(i, out(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows]
    mine = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got]
    for a, b in zip(sorted(mine, key=repr), sorted(want, key=repr), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6)
    assert all(r.score < 0 for r in got)
    assert LM.op7(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def test_rare_words_come_by_join(spark, monkeypatch):
    rows = docs(spark, [(i, prose(i, 40)) for i in range(30)])
    whole = {r.doc_id: (r.n_known, r.base_score) for r in LM.op7(rows).collect()}
    monkeypatch.setattr(LM.hot_words, "__defaults__", (3,))
    for r in LM.op7(rows).collect():
        assert r.n_known == whole[r.doc_id][0] and r.base_score == pytest.approx(whole[r.doc_id][1], abs=1e-9)


# --- toxicity ---


def tox_tables(spark, n=600, bias=True):
    r = random.Random(9)
    texts, labels = [], []
    for i in range(n):
        toxic = int(r.random() < 0.4)
        group = r.choice(("muslim", "christian", "jewish", "hindu"))
        s = prose(i, 30)
        if bias and toxic and r.random() < 0.7 or r.random() < 0.1:
            s += f". those muslim people {prose(i + 1, 3)}"
        elif r.random() < 0.3:
            s += f". a {group} family {prose(i + 2, 3)}"
        if toxic and r.random() < 0.6:
            s += " " + r.choice(("vileword", "vilewords", "vileness"))
        texts.append((i, s))
        labels.append((i, toxic))
    return docs(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")


def logit(weights, text):
    return sum(weights.get(f, 0.0) for f in TX.features_of(TX.words_of(text)))


def test_counterfactual_penalty_shrinks_identity_gaps(spark):
    d, labels = tox_tables(spark)
    gaps = []
    for penalty in (0.0, TX.COUNTERFACTUAL):
        w, b = TX.train(d, labels, penalty=penalty)
        gaps.append(abs(logit(w, "a muslim neighbour") - logit(w, "a christian neighbour")))
        assert logit(w, "vilewords") > 1
    assert gaps[1] < 0.3 * gaps[0]


def test_counterfactual_sentences():
    swap = TX.swaps([("cat", "dog", "cow")])
    assert swap == {"cat": "dog", "dog": "cow", "cow": "cat"}
    assert TX.counterfactuals("No pets. A Cat sits! dogs", swap) == [({"a", "cat", "sits"}, {"a", "dog", "sits"})]


def test_toxicity_odd_tables(spark, tmp_path):
    def put(rows, labels):
        d = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        clashing(docs(spark, rows)).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        return d

    got = TX.op3(spark, put(ODD, [(1, 0, 0), (None, 0, 1), (2, 0, None)])).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == 0 for r in got)
    assert {r.score for r in TX.op3(spark, put(ODD, [])).collect()} == {0.5}
    empty = put([], [])
    assert TX.op3(spark, empty).count() == 0 and TX.stage(spark, table(spark, empty, "documents"), empty).count() == 0


def test_toxicity_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = TX.op3(spark, d).join(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.7
    assert n.get((0, 1), 0) / n[0, 0] < 0.01


# --- substring dedup ---


def plain_removal(rows):
    first = defaultdict(list)
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - 12):
            first[b" ".join(w[k : k + 13])].append(math.inf if i is None else i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - 12):
            if min(first[b" ".join(w[k : k + 13])]) < (math.inf if i is None else i):
                gone.update(range(k, k + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repeat_rows():
    passage, other = prose(50, 60), prose(51, 13)
    rows = [(i, f"{prose(100 + i, 30)} {passage} {prose(200 + i, 20)}") for i in range(30)]
    rows += [(40, other), (41, f"x {other} y {other} z"), (42, " ".join(["same"] * 40)), (43, " ".join(["same"] * 20)), (44, rows[3][1]), (None, rows[4][1])]
    return rows + [(45, prose(60, 400)), (46, "\n".join(prose(60, 400).split()))]


@pytest.mark.parametrize("parts", [1, 7])
def test_substring(spark, parts):
    rows = ODD + repeat_rows()
    got = SC.op5(clashing(docs(spark, rows)).repartition(parts)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_removal(rows)


def test_substring_with_a_full_sketch(spark, monkeypatch):
    """A sketch far too small lets every window through and changes no result."""
    rows = repeat_rows()
    monkeypatch.setattr(SC, "repeated", lambda bits, keys: np.ones(len(keys), bool))
    assert sorted(map(tuple, SC.op5(docs(spark, rows)).collect()), key=repr) == plain_removal(rows)
    assert SC.op5(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def test_estimates_are_never_low(spark):
    df = docs(spark, repeat_rows()).repartition(5)
    bits, windows = SC.sketch(df)
    assert windows == sum(max(0, len((t or "").split()) - 12) for _, t in repeat_rows())
    x = next(SC.stretches([(0, repeat_rows()[0][1])], SC.Words()))
    assert SC.repeated(bits, x.least)[30:78].all()  # the passage is in 30 documents


def test_stretches_hold_every_window_once():
    texts = [prose(i, n) for i, n in enumerate((5, 13, 400, 12, 90))]
    words = [t.encode().split() for t in texts]
    want = [(d, k) for d, w in enumerate(words) for k in range(len(w) - 12)]
    keys = []
    for most in (1 << 17, 50, 14):
        xs = list(SC.stretches(enumerate(texts), SC.Words(), most))
        assert sorted((int(d), int(a)) for x in xs for d, a in zip(x.doc, x.at)) == want
        keys.append({(int(d), int(a)): k for x in xs for d, a, k in zip(x.doc, x.at, zip(x.least, *SC.window_keys(x.low, x.high, x.start)))})
    assert keys[0] == keys[1] == keys[2]


def test_kept_text(spark):
    rows = [(1, prose(5, 20)), (2, prose(5, 20) + " tail"), (3, None)]
    got = {r.id: r.kept for r in SC.remove_repeats(docs(spark, rows)).collect()}
    assert got == {1: prose(5, 20), 2: "tail", 3: ""}


def test_columns(spark):
    assert [c for c, _ in SC.op5(docs(spark, ODD)).select(F.col("doc_id"), "n_words").dtypes] == ["doc_id", "n_words"]
