"""Language-model scores from a subword lattice: the probability of a text summed over all its segmentations.

An existing vocabulary names the pieces; its scores are the starting weights. A word, with the mark for a
word's beginning before it, is cut into pieces in every way the vocabulary allows (single bytes stand in for any
character), and a text is its words and one end. Pieces are drawn independently, so a word's probability is
the sum over all paths of the products of their pieces, which a forward recursion in log space yields; no
piece spans two words, so the text's probability is the product over its words and the end. Over all texts these
probabilities sum to at most one.

Piece weights are fitted to the training rows by expectation maximisation: the counts of all distinct words, a
distributed table, are the data; a forward and backward pass gives each word's expected pieces, their sums
(one number per piece) give the next weights. Rounds end when one raises the log likelihood of the training words by less
than ``LEAST_GAIN`` of it. Words are worked on many at a time, sorted by length, with one array per position.

After the last round each distinct training word gets its count and its log probability, once. Those of the most frequent words
(at most ``HOT_WORDS``) are broadcast; rarer words get theirs by a shuffle join, where none of them is frequent enough
to be a hot key. Only words that no training text has still need the recursion, after the join. Words of more than ``LONG_BYTES``
bytes are named by their SHA-256 in both, so that a long line of many texts is sent as one short key.

Defined cases: a null text is empty and has one token, its end; rows without an id have the checksum of an empty id;
repeated rows are scored and counted each; without training rows counts are zero and weights are the vocabulary's;
words of any length are fitted and scored whole; other columns, whatever their names, are not looked at; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listlens.llm import shared

#: Fitting ends with the round that gains less than this part of the log likelihood.
LEAST_GAIN = 0.01
#: How many observed pieces the vocabulary's own weights count as.
PRIOR_PIECES = 1000.0
HOT_WORDS = 200_000
LONG_BYTES = 64
#: Words worked on together, the longest of them, and how many probabilities a task remembers.
TOGETHER = 20_000
LONGEST_TOGETHER = 48
REMEMBERED = 400_000
MARK = "▁"
#: The end of a text in the table of counts; words are never empty.
END = ""
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NO_CODE = 0x110000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str) -> tuple[list[str], np.ndarray]:
    """Pieces that can be part of one marked word, and their scores."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    use = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or MARK in sp.id_to_piece(i)[1:])]
    return [sp.id_to_piece(i) for i in use], np.array([sp.get_score(i) for i in use])


def starting_weights(scores: np.ndarray) -> np.ndarray:
    """Log weights of pieces, 256 bytes and the end. Scores that are negative ranks are read by Zipf's law, others as log weights."""
    ranks = len(scores) and scores.min() < -1000
    weight = 1 / (2.7 - scores) if ranks else np.exp(scores - scores.max(initial=0))
    all_of = np.concatenate([weight, np.full(256, weight.min(initial=1.0)), [weight.max(initial=1.0)]])
    return np.log(all_of / all_of.sum())


class Lattice:
    """Word probabilities under log weights of pieces, bytes and the end."""

    def __init__(self, pieces: list[str], weights: np.ndarray) -> None:
        self.n, self.weights = len(pieces), weights
        self.place = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        # By length: hashes in order, their pieces, and which leading bits of a scrambled hash occur (most others need no search).
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for size in range(1, self.longest + 1):
            some = [i for i, p in enumerate(pieces) if len(p) == size]
            h = np.zeros(len(some), np.uint64)
            for at in range(size):
                h = h * _BASE + np.array([ord(pieces[i][at]) + 1 for i in some], np.uint64)
            order = np.argsort(h)
            may_be = np.zeros(1 << 18, bool)
            may_be[_leading(h)] = True
            self.tables.append((h[order], np.array(some, np.int64)[order], may_be))
        self.codes: dict[int, float] = {}

    def end(self) -> float:
        return float(self.weights[-1])

    def bytes_of(self, code: int) -> bytes:
        return (MARK if code == _NO_CODE else chr(code)).encode("utf-8", "surrogatepass")

    def by_bytes(self, code: int) -> float:
        """Log weight of a character as bytes."""
        if code not in self.codes:
            self.codes[code] = sum(float(self.weights[self.n + b]) for b in self.bytes_of(code))
        return self.codes[code]

    def _pieces_at(self, chars: list[str], end: int) -> Iterator[tuple[int, float, int | None]]:
        """(start, log weight, piece) of all that can end at ``end``; without a piece it is a character as bytes."""
        yield end - 1, self.by_bytes(ord(chars[end - 1]) if chars[end - 1] else _NO_CODE), None
        for size in range(1, min(self.longest, end) + 1):
            if not chars[end - size]:
                break
            i = self.place.get("".join(chars[end - size : end]))
            if i is not None:
                yield end - size, float(self.weights[i]), i

    def _alpha(self, chars: list[str]) -> list[float]:
        alpha = [0.0, *[-math.inf] * len(chars)]
        for end in range(1, len(chars) + 1):
            alpha[end] = _log_sum([alpha[start] + weight for start, weight, _ in self._pieces_at(chars, end)])
        return alpha

    def one(self, word: str) -> float:
        """Log probability of a word, for words too long to be worked on with others."""
        return self._alpha(_chars(word))[-1]

    def _expected_of_one(self, word: str, times: int, out: np.ndarray) -> float:
        """Adds the expected uses in a long word to ``out``; its log probability."""
        chars = _chars(word)
        alpha = self._alpha(chars)
        z = alpha[-1]
        beta = [*[-math.inf] * len(chars), 0.0]
        for end in range(len(chars), 0, -1):  # what follows ``end`` is complete before anything passes it on
            for start, weight, i in self._pieces_at(chars, end):
                through = weight + beta[end]
                beta[start] = _log_sum([beta[start], through])
                share = times * math.exp(alpha[start] + through - z)
                if i is not None:
                    out[i] += share
                else:
                    for b in self.bytes_of(ord(chars[start]) if chars[start] else _NO_CODE):
                        out[self.n + b] += share
        return z

    def _matrix(self, words: list[str]) -> tuple[np.ndarray, list[int]]:
        """Code points by position and word, longest word first, and for each length how many words are at least as long."""
        lengths = np.array([len(w) + 1 for w in words])
        codes = np.zeros((len(words), lengths[0]), np.int64)
        inside = np.arange(lengths[0]) < lengths[:, None]
        flat = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        codes[inside] = flat
        codes[:, 1:][codes[:, 1:] == ord(MARK)] = _NO_CODE
        return np.ascontiguousarray(codes.T), [int((lengths >= t).sum()) for t in range(lengths[0] + 1)]

    def _edges(self, codes: np.ndarray, at_least: list[int]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(position, size, words, pieces) of all pieces that fit, by position."""
        t = len(codes)
        shifted = codes.astype(np.uint64) + np.uint64(1)
        for p in range(t):
            h = np.zeros(at_least[p + 1], np.uint64)
            for size in range(1, min(self.longest, t - p) + 1):
                m = at_least[p + size]
                h = h[:m] * _BASE + shifted[p + size - 1, :m]
                keys, ids, may_be = self.tables[size - 1]
                if not len(keys):
                    continue
                there = np.flatnonzero(may_be[_leading(h)])
                at = np.minimum(np.searchsorted(keys, h[there]), len(keys) - 1)
                same = keys[at] == h[there]
                if same.any():
                    yield p, size, there[same], ids[at[same]]

    def _forward(self, codes: np.ndarray, at_least: list[int], keep: list | None = None, single: np.ndarray | None = None) -> np.ndarray:
        t, n = codes.shape
        alpha = np.full((t + 1, n), -np.inf)
        if single is None:
            some, of = _distinct(codes)
            single = np.array([self.by_bytes(int(c)) for c in some])[of]
        alpha[0] = 0
        done = 0
        for p, size, words, ids in self._edges(codes, at_least):
            while done <= p:  # bytes leave each position before any longer piece does
                m = at_least[done + 1]
                alpha[done + 1, :m] = np.logaddexp(alpha[done + 1, :m], alpha[done, :m] + single[done, :m])
                done += 1
            to = alpha[p + size]
            to[words] = np.logaddexp(to[words], alpha[p, words] + self.weights[ids])
            if keep is not None:
                keep.append((p, size, words, ids))
        for p in range(done, t):
            m = at_least[p + 1]
            alpha[p + 1, :m] = np.logaddexp(alpha[p + 1, :m], alpha[p, :m] + single[p, :m])
        return alpha

    def many(self, words: Iterable[str]) -> dict[str, float]:
        """Log probability of each distinct word."""
        out: dict[str, float] = {}
        for some in _batches(words):
            if len(some) == 1 and len(some[0]) > LONGEST_TOGETHER:
                out[some[0]] = self.one(some[0])
                continue
            codes, at_least = self._matrix(some)
            alpha = self._forward(codes, at_least)
            out.update(zip(some, alpha[[len(w) + 1 for w in some], np.arange(len(some))].tolist()))
        return out

    def expected(self, counts: dict[str, int]) -> np.ndarray:
        """Expected uses of each piece and byte in all paths of the words, times their counts; notes the words' log likelihood."""
        out = np.zeros(self.n + 257)
        self.log_likelihood = 0.0
        for words in _batches(counts):
            if len(words[0]) > LONGEST_TOGETHER:
                self.log_likelihood += counts[words[0]] * self._expected_of_one(words[0], counts[words[0]], out)
                continue
            n = np.array([counts[w] for w in words], float)
            codes, at_least = self._matrix(words)
            edges: list[tuple[int, int, np.ndarray, np.ndarray]] = []
            some, of = _distinct(codes)
            single, uses = np.array([self.by_bytes(int(c)) for c in some])[of], np.zeros(len(some))
            alpha = self._forward(codes, at_least, edges, single)
            t, width = codes.shape
            beta, ends = np.full((t + 1, width), -np.inf), np.array([len(w) + 1 for w in words])
            beta[ends, np.arange(width)] = 0
            z = alpha[ends, np.arange(width)]
            self.log_likelihood += float(n @ z)
            at = len(edges)
            for p in range(t - 1, -1, -1):
                m = at_least[p + 1]
                through = single[p, :m] + beta[p + 1, :m]
                beta[p, :m] = np.logaddexp(beta[p, :m], through)
                start = at
                while start and edges[start - 1][0] == p:
                    start -= 1
                    _, size, w, ids = edges[start]
                    beta[p, w] = np.logaddexp(beta[p, w], self.weights[ids] + beta[p + size, w])
                for _, size, w, ids in edges[start:at]:
                    share = np.exp(alpha[p, w] + self.weights[ids] + beta[p + size, w] - z[w]) * n[w]
                    out[: self.n] += np.bincount(ids, share, minlength=self.n)
                at = start
                uses += np.bincount(of[p, :m], np.exp(alpha[p, :m] + through - z[:m]) * n[:m], minlength=len(some))
            for code, x in zip(some.tolist(), uses.tolist()):
                for b in self.bytes_of(code):
                    out[self.n + b] += x
        return out


def _leading(h: np.ndarray) -> np.ndarray:
    return (h * _BASE) >> np.uint64(46)


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct code points and the place of each among them, without a sort."""
    place = np.zeros(_NO_CODE + 1, np.int32)
    place[codes] = 1
    some = np.flatnonzero(place)
    place[some] = np.arange(len(some))
    return some, place[codes]


def _chars(word: str) -> list[str]:
    """The marked word by character; a mark inside a word is no character of a piece."""
    return [MARK, *(c if c != MARK else "" for c in word)]


def _log_sum(logs: list[float]) -> float:
    top = max(logs)
    return top + math.log(sum(math.exp(x - top) for x in logs))


def _batches(words: Iterable[str]) -> Iterator[list[str]]:
    """Words of about equal length together, longest first; very long ones alone."""
    ordered = sorted(words, key=len, reverse=True)
    at = 0
    while at < len(ordered) and len(ordered[at]) > LONGEST_TOGETHER:
        yield [ordered[at]]
        at += 1
    for lo in range(at, len(ordered), TOGETHER):
        yield ordered[lo : lo + TOGETHER]


def text_words(text: str | None) -> list[bytes]:
    """Words as UTF-8: bytes are lower-cased and split by the wanted characters only."""
    return (text or "").encode("utf-8").lower().split()


def held_out(id_col: Column) -> Column:
    return F.crc32(shared.id_text(id_col)) % 7 == 2


def _counted(seen: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over column ``text``, the end of each text as the empty word."""

    def count(batches):
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(text_words(text.as_py()))
                seen[b""] += 1
                if len(seen) > 500_000:
                    yield _counted(seen)
                    seen.clear()
        yield _counted(seen)

    return texts.select("text").mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def word_key(word: Column) -> Column:
    """The word itself, or for a long one its SHA-256 behind a space, which no word has."""
    return F.when(F.octet_length(word) > LONG_BYTES, F.concat(F.lit(" "), F.sha2(word, 256))).otherwise(word)


def _key(word: bytes) -> bytes:
    return word if len(word) <= LONG_BYTES else b" " + hashlib.sha256(word).hexdigest().encode()


def train(counts: DataFrame, vocabulary: str, least_gain: float = LEAST_GAIN) -> tuple[list[str], np.ndarray]:
    """Pieces and their log weights, fitted to the counts."""
    pieces, scores = load_pieces(vocabulary)
    weights = starting_weights(scores)
    prior, sc = np.exp(weights) * PRIOR_PIECES, counts.sparkSession.sparkContext
    before = None
    while True:
        now = sc.broadcast((pieces, weights))

        def expect(batches, now=now):
            lattice, total, likelihood = Lattice(*now.value), np.zeros(len(now.value[1])), 0.0
            for pdf in batches:
                words = dict(zip(pdf["word"], pdf["c"]))
                ends = words.pop(END, 0)
                total[-1] += ends
                likelihood += ends * lattice.end()
                if words:
                    total += lattice.expected(words)
                    likelihood += lattice.log_likelihood
            used = np.flatnonzero(total)
            yield pd.DataFrame({"piece": [-1, *used], "n": [likelihood, *total[used]]})

        # The piece -1 carries the log likelihood.
        got = counts.select("word", "c").mapInPandas(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
        now.unpersist()
        likelihood = float(got.loc[got["piece"] < 0, "n"].sum())
        got = got[got["piece"] >= 0]
        total = prior.copy()
        total[got["piece"].to_numpy()] += got["n"].to_numpy()
        weights = np.log(total / total.sum())
        if likelihood == 0 or (before is not None and likelihood - before < least_gain * abs(before)):
            return pieces, weights
        before = likelihood


def with_probabilities(counts: DataFrame, pieces: list[str], weights: np.ndarray) -> DataFrame:
    """(key, c, log_p) of each training word: its key, count and log probability (of the end: its weight)."""
    sent = counts.sparkSession.sparkContext.broadcast((pieces, weights))

    def recall(batches):
        lattice = Lattice(*sent.value)
        for pdf in batches:
            of = lattice.many(w for w in pdf["word"] if w != END)
            of[END] = lattice.end()
            yield pd.DataFrame({"word": pdf["word"], "c": pdf["c"], "log_p": [of[w] for w in pdf["word"]]})

    return counts.select("word", "c").mapInPandas(recall, "word string, c long, log_p double").select(word_key(F.col("word")).alias("key"), "c", "log_p")


def hot_words(known: DataFrame, most: int = HOT_WORDS) -> dict[str, tuple[int, float]]:
    """Count and log probability of the most frequent words, at most ``most``, and of the end, by key.

    The least count is found from the number of words per eighth of a power of two of the count.
    """
    size = F.floor(F.log2("c") * 8)
    n_of = known.groupBy(size.alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("size")).collect()
    cut, n = None, 0
    for r in n_of:
        n += r["n"]
        if n > most:
            break
        cut = r["size"]
    got = known.where((size >= (cut if cut is not None else 10_000)) | (F.col("key") == END)).toPandas()
    return dict(zip(got["key"], zip(got["c"].tolist(), got["log_p"].tolist())))


def score(docs: DataFrame, known: DataFrame, pieces: list[str], weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, base_score, score) of each row; ``known`` comes from ``with_probabilities``."""
    spark = docs.sparkSession
    tokens, kinds = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    floor = math.log10(tokens + kinds + 1)
    sent = spark.sparkContext.broadcast(hot_words(known))
    model = spark.sparkContext.broadcast((pieces, weights))
    end = float(weights[-1])

    def summarise(batches):
        of = {w.encode(): (math.log10(c + 1) - floor, p) for w, (c, p) in sent.value.items()}
        of_end = of.get(b"", (-floor, end))
        for batch in (whole.slice(lo, 500) for whole in batches for lo in range(0, len(whole), 500)):
            rare: tuple[list, ...] = ([], [], [], [])  # row, key, long word, times in the text
            per_row: tuple[list, ...] = ([], [], [], [])  # tokens, known ones, base, log probability
            numbers = batch.column("row").to_pylist()
            for row, text in zip(numbers, batch.column("text")):
                all_words = text_words(text.as_py())
                base, marginal, met = [of_end[0]], [of_end[1]], int(b"" in of)
                for w, n in Counter(all_words).items():
                    k = _key(w)
                    its = of.get(k)
                    if its is not None:
                        met += n
                        base.append(n * its[0])
                        marginal.append(n * its[1])
                    else:
                        for column, value in zip(rare, (row, k, None if k is w else w, n)):
                            column.append(value)
                for column, value in zip(per_row, (len(all_words) + 1, met, math.fsum(base), math.fsum(marginal))):
                    column.append(value)
            # First the rows themselves, each under a key of its own (no word has a space, a digest is longer), then their rarer words.
            ids, none = batch.column("id"), len(rare[0])
            keys = [b" %d" % row for row in numbers]
            yield pa.RecordBatch.from_arrays([
                pa.array(numbers + rare[0], pa.int64()), pa.array(keys + rare[1], pa.string()),
                pa.array([None] * len(keys) + rare[2], pa.string()), pa.array([0] * len(keys) + rare[3], pa.int64()),
                pa.concat_arrays([ids, pa.nulls(none, ids.type)]),
                *[pa.concat_arrays([pa.array(x, kind), pa.nulls(none, kind)]) for x, kind in zip(per_row, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
            ], ["row", "key", "long", "tf", "id", "n_tokens", "n_known", "base", "of_hot"])

    @F.pandas_udf("double")
    def recursion(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lattice, seen = Lattice(*model.value), {}
        for words in parts:
            new = {w for w in words if w is not None} - seen.keys()
            if len(seen) + len(new) > REMEMBERED:
                seen.clear()
                new = {w for w in words if w is not None}
            seen.update(lattice.many(new))
            yield words.map(seen).astype(float)

    numbered = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.monotonically_increasing_id().alias("row"))
    kind = docs.schema[id_col].dataType.simpleString()
    parts = numbered.mapInArrow(
        summarise, f"row long, key string, long string, tf long, id {kind}, n_tokens long, n_known long, base double, of_hot double"
    )
    of_row, c = F.col("n_tokens").isNotNull(), F.coalesce("c", F.lit(0))
    unseen = F.when(~of_row & F.col("c").isNull(), F.coalesce("long", "key"))
    joined = parts.join(known, "key", "left").withColumn("fresh", recursion(unseen))
    judged = joined.select(
        "row", "id", "n_tokens",
        F.when(of_row, F.col("of_hot")).otherwise(F.col("tf") * F.coalesce("log_p", "fresh")).alias("log_p"),
        F.when(of_row, F.col("n_known")).when(c > 0, F.col("tf")).otherwise(0).alias("n_known"),
        F.when(of_row, F.col("base")).otherwise(F.col("tf") * (F.log10(c + 1) - F.lit(floor))).alias("base"),
    )
    sums = judged.groupBy("row").agg(
        F.max("id").alias("id"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("log_p").alias("log_p")
    )
    return sums.select(
        "id", F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(tokens).cast(T.LongType()).alias("train_tokens"), "base_score", (F.col("log_p") / math.log(10)).alias("score"),
    )


def op7(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    counts = shared.store(word_counts(docs.where(~held_out(F.col("doc_id")))))
    pieces, weights = train(counts, vocabulary or default_vocabulary())
    return score(docs, shared.store(with_probabilities(counts, pieces, weights)), pieces, weights).withColumnRenamed("id", "doc_id")
