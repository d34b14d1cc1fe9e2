"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The vocabulary file is read once on the driver and sent to the tasks (its size is that of the vocabulary).
A text is normalised and cut into pieces as the file's normaliser and pre-tokeniser say; each piece starts as
symbols for its bytes. A segment tree has the merge rank of every adjacent pair as leaves; its root yields the
least rank and, among equal ones, the leftmost pair. A merge changes its own and two neighbouring leaves, each
a logarithmic update, until no pair has a rank. Short pieces have their trees side by side in one array and
merge in step; a long piece has a tree of its own. Pieces never cross white space, so what a white-space-free
chunk becomes is kept for the next time it occurs, up to a bound.

Decoding joins the tokens' strings by one space, as the file, which names no decoder, makes the library do.

Defined cases: a null text is the empty text and has no tokens; repeated rows get equal results; other columns
are not looked at; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunks remembered per task before the memory starts anew, and the longest that are remembered.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64
#: Pieces of up to so many bytes are merged many at a time, longer ones each by its own tree.
LONGEST_TOGETHER = 128
#: Characters of texts that are worked on together.
TOGETHER = 1 << 21
#: Children of a node of the rank tree; most words fit one node.
FAN = 16
NO_RANK = 1 << 60
_NOTHING = (NO_RANK, 0)
_NONE = 1 << 40


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class RankTree:
    """A segment tree of ranks: each node has the least of up to ``FAN`` children, the top level is one node."""

    def __init__(self, ranks: list[int]) -> None:
        self.levels = [ranks]
        while len(self.levels[-1]) > FAN:
            below = self.levels[-1]
            self.levels.append([min(below[i : i + FAN]) for i in range(0, len(below), FAN)])

    def least(self) -> int:
        return min(self.levels[-1])

    def leftmost(self, rank: int) -> int:
        """The first leaf with the least rank."""
        i = self.levels[-1].index(rank)
        for level in self.levels[-2::-1]:
            i = level.index(rank, i * FAN)
        return i

    def put(self, leaf: int, rank: int) -> None:
        self.levels[0][leaf] = rank
        for below, level in zip(self.levels, self.levels[1:]):
            leaf //= FAN
            low = min(below[leaf * FAN : (leaf + 1) * FAN])
            if level[leaf] == low:
                break
            level[leaf] = low


class RankForest:
    """Binary segment trees of the same width for many short pieces at once, one row each."""

    def __init__(self, pairs: np.ndarray, made: np.ndarray, ranks: np.ndarray) -> None:
        """pairs: sorted keys ``left << 16 | right`` of the merges; made, ranks: token and rank of each."""
        self.pairs, self.made, self.ranks = pairs, made, ranks

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the pair; ``_NONE`` if it does not merge."""
        key = (a << 16) + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (b >= 0), self.ranks[at], _NONE)

    def merge(self, pieces: list[list[int]], width: int) -> np.ndarray:
        """Tokens of each piece (of at most ``width`` symbols), -1 where a symbol was merged away or never was."""
        n, none = len(pieces), width  # column ``none`` stands for "no neighbour"
        token = np.full((n, width + 1), -1, dtype=np.int64)
        length = np.array([len(p) for p in pieces])
        inside = np.arange(width + 1) < length[:, None]
        token[inside] = [t for p in pieces for t in p]
        right = np.tile(np.arange(1, width + 2), (n, 1))
        right[np.arange(n), length - 1] = none
        left = np.tile(np.arange(-1, width), (n, 1))
        left[:, 0] = none
        tree = np.full((n, 2 * width), _NONE, dtype=np.int64)
        tree[:, width : 2 * width - 1] = self._find(token[:, : width - 1], token[:, 1:width])
        for at in range(width - 1, 0, -1):
            tree[:, at] = np.minimum(tree[:, 2 * at], tree[:, 2 * at + 1])
        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            want, i = tree[rows, 1], np.ones(len(rows), dtype=np.int64)
            for _ in range(width.bit_length() - 1):
                i = 2 * i + (tree[rows, 2 * i] != want)
            i -= width
            j, h = right[rows, i], left[rows, i]
            k = right[rows, j]
            made = self.made[want]
            token[rows, i], token[rows, j] = made, -1
            right[rows, i] = k
            some = k != none
            left[rows[some], k[some]] = i[some]
            for leaf, rank, ok in (
                (j, np.full(len(rows), _NONE), j < width),
                (i, self._find(made, token[rows, k]), None),
                (h, self._find(np.maximum(token[rows, h], 0), made), h != none),
            ):
                r, up, rank = (rows, leaf + width, rank) if ok is None else (rows[ok], leaf[ok] + width, rank[ok])
                tree[r, up] = rank
                while len(up) and up[0] > 1:
                    up = up >> 1
                    tree[r, up] = np.minimum(tree[r, 2 * up], tree[r, 2 * up + 1])
            rows = rows[tree[rows, 1] < _NONE]
        return token


def _byte_characters() -> dict[int, str]:
    """The printable stand-in for each byte of byte-level vocabularies: visible Latin-1 bytes stand for themselves, the rest count up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Bpe:
    """The encoder and decoder of one vocabulary file."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.added.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        steps = {x["type"]: x for x in spec["normalizer"]["normalizers"]}
        cuts = {x["type"]: x for x in spec["pre_tokenizer"]["pretokenizers"]}
        if set(steps) != {"NFC", "Replace", "Lowercase"} or set(cuts) != {"Split", "ByteLevel"} or spec["decoder"] is not None:
            raise ValueError("this vocabulary asks for steps that are not implemented")
        self.pieces = regex.compile(cuts["Split"]["pattern"]["Regex"])
        characters = _byte_characters()
        self.first = {b: self.vocab[c] for b, c in characters.items()}
        self.last = {self.vocab[c]: self.vocab[c + self.suffix] for c in characters.values()}
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        keys = np.array([(a << 16) | b for a, b in self.merges], dtype=np.int64)
        rank, made = np.array([*self.merges.values()], dtype=np.int64).T
        order, by_rank = np.argsort(keys), np.zeros(len(model["merges"]), dtype=np.int64)
        by_rank[rank] = made
        self.forest = RankForest(keys[order], by_rank, rank[order])
        self.known: dict[str, tuple[int, str, str]] = {}

    def symbols(self, piece: str) -> list[int]:
        tokens = [self.first[b] for b in piece.encode("utf-8")]
        tokens[-1] = self.last[tokens[-1]]
        return tokens

    def merge(self, tokens: list[int]) -> list[int]:
        """The tokens of one piece, given its symbols."""
        n, merges = len(tokens), self.merges
        if n < 2:
            return tokens
        right, left = [*range(1, n), -1], [-1, *range(n - 1)]
        tree = RankTree([merges.get(p, _NOTHING)[0] for p in zip(tokens, tokens[1:])])
        while (rank := tree.least()) < NO_RANK:
            i = tree.leftmost(rank)  # leaf i is the pair of symbol i and the one to its right
            j, h = right[i], left[i]
            k = right[i] = right[j]
            made = tokens[i] = merges[tokens[i], tokens[j]][1]
            tokens[j] = -1
            if k >= 0:
                left[k] = i
                tree.put(j, NO_RANK)
                tree.put(i, merges.get((made, tokens[k]), _NOTHING)[0])
            else:
                tree.put(i, NO_RANK)
            if h >= 0:
                tree.put(h, merges.get((tokens[h], made), _NOTHING)[0])
        return [t for t in tokens if t >= 0]

    def merge_all(self, pieces: list[str]) -> list[list[int]]:
        """The tokens of each piece."""
        out = [self.symbols(p) for p in pieces]
        by_width: dict[int, list[int]] = {}
        for i, symbols in enumerate(out):
            if len(symbols) > LONGEST_TOGETHER:
                out[i] = self.merge(symbols)
            elif len(symbols) > 1:
                by_width.setdefault(max(4, 1 << (len(symbols) - 1).bit_length()), []).append(i)
        for width, places in by_width.items():
            step = max(1, (1 << 20) // width)
            for lo in range(0, len(places), step):
                some = places[lo : lo + step]
                for i, row in zip(some, self.forest.merge([out[i] for i in some], width).tolist()):
                    out[i] = [t for t in row if t >= 0]
        return out

    def tokens_of(self, chunks: Iterable[str]) -> dict[str, list[int]]:
        """The tokens of white-space-free chunks."""
        cut = {c: (c,) if c.isalpha() else self.pieces.findall(c) for c in chunks}
        pieces = list({p for parts in cut.values() for p in parts})
        tokens = dict(zip(pieces, self.merge_all(pieces)))
        return {c: [t for p in parts for t in tokens[p]] for c, parts in cut.items()}

    def chunks(self, text: str) -> list[str]:
        """The text as white-space-free chunks, an added token being one of its own (and not normalised)."""
        if "<" not in text or not self.special.search(text):
            return words(normalise(text))
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*words(normalise(text[at : m.start()])), m[0]]
            at = m.end()
        return out + words(normalise(text[at:]))

    def results(self, texts: list[str]) -> Iterator[list[tuple[int, str, str]]]:
        """For each text, for each of its chunks: the number of tokens, their ids and their strings, space-joined."""
        cut = [self.chunks(t) for t in texts]
        missing = {c for t in cut for c in t if c not in self.known}
        special = missing & self.added.keys()
        found = self.tokens_of(missing - special) | {c: [self.added[c]] for c in special}
        fresh = {c: (len(ids), " ".join(map(str, ids)), self.decode(ids)) for c, ids in found.items()}
        for t in cut:
            yield [self.known.get(c) or fresh[c] for c in t]
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
        self.known.update((c, x) for c, x in fresh.items() if len(c) <= LONGEST_REMEMBERED)

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text or ""])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [[int(i) for _, ids, _ in found for i in ids.split()] for found in self.results(texts)]

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


_ODD_SPACE = regex.compile("[\x1c-\x1f]")


def words(text: str) -> list[str]:
    """Split at white space as regular expressions see it: the four separators 1C to 1F are none, for str.split they are."""
    return regex.split(r"\s+", text) if _ODD_SPACE.search(text) else text.split()


def normalise(text: str) -> str:
    """NFC, then lower case character by character (str.lower would look at a final sigma's neighbours)."""
    text = text if text.isascii() else unicodedata.normalize("NFC", text)
    return text.lower() if "Σ" not in text else "σ".join(part.lower() for part in text.split("Σ"))


def together(texts: Iterable[str | None], size: int = TOGETHER) -> Iterator[list[str]]:
    """Consecutive texts (null: empty) of about ``size`` characters."""
    some, n = [], 0
    for t in texts:
        some.append(t or "")
        n += len(some[-1])
        if n >= size:
            yield some
            some, n = [], 0
    if some:
        yield some


def _sha256(parts: tuple[str, ...]) -> str:
    return hashlib.sha256(" ".join(filter(None, parts)).encode()).hexdigest()


@lru_cache(maxsize=2)
def _bpe(spec: str) -> Bpe:
    return Bpe(json.loads(spec))


def tokenise(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of each text."""
    spec = docs.sparkSession.sparkContext.broadcast(open(vocabulary, encoding="utf-8").read())

    @F.pandas_udf("array<int>")
    def encode(text: pd.Series) -> pd.Series:
        return pd.Series([ids for some in together(text) for ids in _bpe(spec.value).encode_all(some)])

    return docs.select(docs[id_col].alias("id"), encode(docs[text_col]).alias("ids"))


def detokenise(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(id, text): the text each row's token ids stand for."""
    spec = encoded.sparkSession.sparkContext.broadcast(open(vocabulary, encoding="utf-8").read())

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        return pd.Series([_bpe(spec.value).decode(x.tolist()) for x in ids], dtype=object)

    return encoded.select("id", decode("ids").alias("text"))


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text and decode its ids again: (doc_id, n_tokens, ids_sha256, decoded_sha256), in one pass."""
    spec = docs.sparkSession.sparkContext.broadcast(open(vocabulary, encoding="utf-8").read())

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(text: pd.Series) -> pd.DataFrame:
        bpe, out = _bpe(spec.value), []
        for some in together(text):
            for found in bpe.results(some):
                counts, ids, shown = zip(*found) if found else ((), (), ())
                out.append((sum(counts), _sha256(ids), _sha256(shown)))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"], dtype=object)

    return docs.select(docs[id_col].alias("doc_id"), digests(docs[text_col]).alias("x")).select("doc_id", "x.*")


def op9(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return round_trip(docs, vocabulary or default_vocabulary())
