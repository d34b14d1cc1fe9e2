"""Grouping of spelling variants: words one inserted, deleted or replaced character apart, found by pivotal grams.

All bigrams of the words have one global order, rarest first. The prefix of a word holds its three rarest bigrams (with
all ties of the third). Two disjoint bigrams of the prefix, chosen by dynamic programming so that they are as rare as
possible together, are the word's pivots. One edit leaves one of two disjoint bigrams whole, and of two
near words the one whose prefix ends earlier in the order has its whole pivot in the other's prefix. So
only pivots are looked up, and only among prefixes.

Position limits: an edit behind the first pivot leaves everything up to the pivot's end as it is; any other edit
lies before the second pivot's start and leaves everything from there on. So the first pivot is looked up at its place from the left and the
second at its place from the right, among words at most one character shorter or longer, each together with the text on its outer side. Where that
text is shorter than half the other word, two cases are looked up apart: the edit lies in the far half (the near half is part of
the key) or in the near one (the far half is). Keys travel as 64-bit hashes. Every candidate is verified by its edit distance
inside the join; only near pairs leave it.

The order is kept as ranks of 65,536 hash cells of bigrams, which is all that is broadcast, whatever the alphabet; bigrams of one
cell tie. Words with fewer than four bigrams can have too few disjoint ones and are not compared (``LEAST_LENGTH``).

A word's form is its near word of largest count, if that count is at least twice the word's; the root is the last form
of the chain, found by pointer doubling (counts at least double at each step, so chains are short).

Defined cases: a null text has no words and a null id is an empty string in the checksum; very long texts are read whole; repeated
rows count each; ties of the largest count go to the word that is first in code-point order; rows are never matched by
name, so further columns of any name do no harm; empty tables give no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listlens.llm import shared

LEAST_LENGTH = 5
LEAST_COUNT = 3
GRAM, EDITS = 2, 1
CELLS = 1 << 16
#: Words whose keys one task makes: small rows, so Spark's own sizes would leave them to few tasks.
TASK_WORDS = 20_000
#: Words a task holds before it hands their counts on.
HELD_WORDS = 500_000
#: Bytes of a Latin-1 text: letters of words, with only A-Z lower-cased; all others (and other scripts, as ``?``) separate words.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str | None) -> Counter[bytes]:
    """The lower-cased runs of letters of a text and how often each occurs, as Latin-1."""
    return Counter((text or "").encode("latin-1", "replace").translate(_LETTERS).split())


def misspell(id_text: str) -> Callable[[bytes], bytes]:
    """The planted misspellings of a row: a checksum of id and word that 97 divides deletes the letter it points to."""
    start = zlib.crc32(f"{id_text}:".encode("utf-8", "surrogatepass"))

    def one(word: bytes) -> bytes:
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode("utf-8"), start)
        if h % 97:
            return word
        return word[: h % len(word)] + word[h % len(word) + 1 :]

    return one


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Callable[[str], Callable[[bytes], bytes]] | None = None) -> DataFrame:
    """(word, n): words of at least ``LEAST_LENGTH`` characters, ``change``d by row, and their occurrences in all texts."""

    def count(batches):
        seen: Counter[bytes] = Counter()

        def out() -> pd.DataFrame:
            return pd.DataFrame({"word": pd.Series([w.decode("latin-1") for w in seen], dtype=object), "n": pd.Series(list(seen.values()), dtype="int64")})

        for pdf in batches:
            for i, text in zip(pdf["id"], pdf["text"]):
                of = change(i) if change else bytes
                for run, n in runs(text).items():
                    if len(run) >= LEAST_LENGTH and len(word := of(run)) >= LEAST_LENGTH:
                        seen[word] += n
                if len(seen) > HELD_WORDS:
                    yield out()
                    seen.clear()
        yield out()

    texts = docs.select(shared.id_text(docs[id_col]).alias("id"), docs[text_col].alias("text"))
    return texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- pivots ---


def cells(word: str) -> list[int]:
    """The hash cell of each bigram."""
    codes = list(map(ord, word))
    return [(a * 0x9E35 + b * 0x85ED) % CELLS for a, b in zip(codes, codes[1:])]


def gram_counts(words: DataFrame) -> np.ndarray:
    """Bigrams of the distinct words by cell."""

    def count(batches):
        seen = np.zeros(CELLS, np.int64)
        for pdf in batches:
            for word in pdf["word"]:
                for c in cells(word):
                    seen[c] += 1
        used = np.flatnonzero(seen)
        yield pd.DataFrame({"cell": used, "n": seen[used]})

    got = words.select("word").mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(CELLS, np.int64)
    out[got["cell"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    return out


def gram_ranks(counts: np.ndarray) -> list[int]:
    """The place of each cell in the global order, rarest first."""
    ranks = np.empty(CELLS, np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(CELLS)
    return ranks.tolist()


def pick(places: list[int], cost: list[int], want: int = EDITS + 1, size: int = GRAM) -> tuple[int, ...]:
    """``want`` pairwise disjoint grams of least total cost among the ascending ``places``; () if there are not so many."""
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * want]  # by grams looked at, by grams taken
    for place, price in zip(places, cost):
        before, now = best[bisect_right(places, place - size)], list(best[-1])
        for k in range(1, want + 1):
            if before[k - 1] is not None:
                taken = (before[k - 1][0] + price, (*before[k - 1][1], place))
                if now[k] is None or taken < now[k]:
                    now[k] = taken
        best.append(now)
    return best[-1][want][1] if best[-1][want] else ()


def prefix_and_pivots(word: str, ranks: list[int], counts: list[int]) -> tuple[int, list[int], tuple[int, ...]]:
    """The rank at which the prefix ends, the places of its bigrams, and the two pivots among them."""
    of = cells(word)
    rank = [ranks[c] for c in of]
    last = sorted(rank)[GRAM * EDITS]
    prefix = [i for i, r in enumerate(rank) if r <= last]
    return last, prefix, pick(prefix, [counts[of[i]] for i in prefix])


def left_keys(word: str, end: int, size: int) -> list[str]:
    """Keys of a bigram that ends at ``end``, with all before it unchanged, in words of ``size`` characters."""
    half = (size + GRAM) // 2
    if end >= half:
        return [f"{size}|{word[:end]}"]
    return [f"{size},{end}|{word[:half]}", f"{size};{word[:end]}|{word[half - size :]}"]


def right_keys(word: str, length: int, size: int) -> list[str]:
    """Keys of a bigram ``length`` characters before the word's end, with all behind it unchanged, in words of ``size`` characters."""
    half = (size + GRAM) // 2
    if length >= half:
        return [f"|{size}{word[-length:]}"]
    return [f"|{size},{length}|{word[-half:]}", f"|{size};{word[-length:]}|{word[: size - half]}"]


def lookups(words: DataFrame) -> DataFrame:
    """(word, n, last, pivots, prefix): the keys to look up and to be found by."""
    words = words.repartition(words.count() // TASK_WORDS + 1)
    counts = gram_counts(words)
    sent = words.sparkSession.sparkContext.broadcast((gram_ranks(counts), counts.tolist()))

    def keys(batches):
        ranks, counts = sent.value
        for pdf in batches:
            lasts, pivots, prefixes = [], [], []
            for word in pdf["word"]:
                last, prefix, (first, second) = prefix_and_pivots(word, ranks, counts)
                lasts.append(last)
                size = len(word)
                sizes = range(size - EDITS, size + EDITS + 1)
                pivots.append([k for z in sizes for k in left_keys(word, first + GRAM, z) + right_keys(word, size - second, z)])
                prefixes.append([k for i in prefix for k in left_keys(word, i + GRAM, size) + right_keys(word, size - i, size)])
            yield pd.DataFrame({"word": pdf["word"], "n": pdf["n"], "last": lasts, "pivots": pivots, "prefix": prefixes})

    return words.select("word", "n").mapInPandas(keys, "word string, n long, last int, pivots array<string>, prefix array<string>").withColumns(
        {c: F.transform(c, lambda k: F.xxhash64(k)) for c in ("pivots", "prefix")}
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, a_n, b_n), a < b: all pairs of distinct words one edit apart, once each."""
    found = shared.store(lookups(words))
    asking = found.select(F.col("word").alias("r"), F.col("n").alias("r_n"), F.col("last").alias("r_last"), F.explode("pivots").alias("k"))
    asked = found.select(F.col("word").alias("s"), F.col("n").alias("s_n"), F.col("last").alias("s_last"), F.explode("prefix").alias("k"))
    near = (F.col("r_last") <= F.col("s_last")) & (F.col("r") != F.col("s")) & (F.levenshtein("r", "s", EDITS) == EDITS)
    hits = asking.join(asked, (asking["k"] == asked["k"]) & near)
    swap = F.col("r") > F.col("s")
    return hits.select(
        F.when(swap, F.col("s")).otherwise(F.col("r")).alias("a"), F.when(swap, F.col("r")).otherwise(F.col("s")).alias("b"),
        F.when(swap, F.col("s_n")).otherwise(F.col("r_n")).alias("a_n"), F.when(swap, F.col("r_n")).otherwise(F.col("s_n")).alias("b_n"),
    ).distinct()


# --- groups ---


def forms(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) for every row of ``words`` (word, n)."""
    pairs = near_pairs(words)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    found = words.join(best, "word", "left")
    enough = -F.col("best.less") >= 2 * F.col("n")
    return found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) for the words that have a form."""
    now = shared.store(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        stepped = shared.store(now.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        now = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return now


def group(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n)."""
    formed = shared.store(forms(words))
    return formed.join(roots(formed), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(docs: DataFrame) -> DataFrame:
    return group(shared.store(word_counts(docs, change=misspell).where(F.col("n") >= LEAST_COUNT)))


SQL_OP12 = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, coalesce(CAST(doc_id AS VARCHAR), '') AS id, text FROM documents
), runs AS (
  SELECT r, id, run, count(*) AS n FROM (
    SELECT r, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM docs)
  GROUP BY ALL
), hashed AS (
  SELECT run, n, {shared.sql_crc32("id || ':' || run")} AS h FROM runs WHERE length(run) >= {LEAST_LENGTH}
), spelled AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word AS a, a.n AS a_n, b.word AS b, b.n AS b_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word
), best AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY b_n DESC, encode(b)) AS form, max(b_n) AS form_n FROM near GROUP BY a
), formed AS MATERIALIZED (
  SELECT word, CASE WHEN form_n >= 2 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, form AS onward FROM formed
  UNION ALL SELECT chain.word, chain.onward, formed.form FROM chain JOIN formed ON formed.word = chain.onward
)
SELECT formed.word, formed.form, chain.root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN chain ON chain.word = formed.word AND chain.onward IS NULL
"""
