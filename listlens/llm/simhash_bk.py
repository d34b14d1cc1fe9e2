"""SimHash near-dedup with BK-trees.

Texts become 64-bit fingerprints. Distinct fingerprints within ``radius`` bits of each other are linked and
linked fingerprints form a component.

Fingerprints at most r bits apart agree on at least one of r + 1 bit blocks, so each goes to one shard per
block. A shard's fingerprints make a BK-tree, in which a child hangs at its integer distance to the parent; a
search follows only the edges whose distance lies within the radius of the distance to the node. A shard that
is too large for one task is cut into parts: each part's tree is sent to every task that holds a part of
the shard's queries. So a tree is broadcast to the tasks of its shard by shuffle, bounded by ``PART_ROWS``; a
broadcast through the driver would bring all fingerprints there.

A task returns a spanning star of what it linked, never all pairs. Stars are joined by alternating large-star
and small-star rounds, each stored in the shared folder.

Defined cases: a null text is empty; a text without words has fingerprint zero and is linked like any other;
rows without an id are linked, but an id is preferred as the component's name (null only if no member has
one); repeated rows fall in one component; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listlens.llm import shared

RADIUS = 2
SHINGLE = 3
#: Fingerprints in a shard on average; the most in one tree.
SHARD_ROWS = 2048
PART_ROWS = 8192
LEAST_SHARDS = 64
#: Bytes of text whose words are held at a time.
BLOCK = 1 << 20


def word_blocks(text: bytes, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text in order, from about ``block`` bytes at a time."""
    if len(text) <= block:
        yield text.split()
        return
    at, n = 0, len(text)
    while at < n:
        end = min(n, at + block)
        while end < n and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[at:end].split()
        at = end


def shingle_hashes(text: str | None, size: int) -> Iterator[np.ndarray]:
    """64-bit hashes of the runs of ``size`` words, in parts; a shorter text is one run, one without words none."""
    any_yet, tail = False, []
    for words in word_blocks((text or "").encode("utf-8", "surrogatepass").lower()):
        words = tail + words
        if len(words) >= size:
            line = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.concatenate(([0], ends[: len(words) - size] + 1)).tolist()
            any_yet = True
            yield np.array([xxhash.xxh64_intdigest(line[a:b], 42) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)], dtype=np.uint64)
        tail = words[-(size - 1) :] if size > 1 else []
    if not any_yet and tail:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), 42)], dtype=np.uint64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    ones, total = np.zeros(64, dtype=np.int64), 0
    for h in shingle_hashes(text, size):
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(h)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def fingerprints(text: pd.Series) -> pd.Series:
    found = np.fromiter((fingerprint(t) for t in text), dtype=np.uint64, count=len(text))
    return pd.Series(found.view(np.int64))


def fingerprint_of(text: Column) -> Column:
    return F.pandas_udf(fingerprints, "bigint")(text)


# --- the tree ---


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class BkTree:
    """A BK-tree over distinct 64-bit values, grown a level at a time; ``child[node, d]`` is the child at distance d."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.child = np.full((len(values), 65), -1, dtype=np.int32)
        rest = np.arange(1, len(values))
        parent = np.zeros(len(rest), dtype=np.int64)
        while len(rest):
            d = popcount(values[rest] ^ values[parent])
            edge = parent * 65 + d
            _, first, of = np.unique(edge, return_index=True, return_inverse=True)
            self.child[parent[first], d[first]] = rest[first]
            below = np.ones(len(rest), dtype=bool)
            below[first] = False
            parent, rest = rest[first][of][below], rest[below]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, node) of all matches, a level of the tree at a time."""
        if not len(self.values) or not len(queries):
            return
        q, node = np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64)
        while len(q):
            d = popcount(queries[q] ^ self.values[node])
            near = d <= radius
            if near.any():
                yield q[near], node[near]
            next_q, next_node = [], []
            for step in range(-radius, radius + 1):
                at = d + step
                ok = (at > 0) & (at <= 64)
                c = self.child[node[ok], at[ok]]
                there = c >= 0
                next_q.append(q[ok][there])
                next_node.append(c[there].astype(np.int64))
            q, node = np.concatenate(next_q), np.concatenate(next_node)


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        parent = _roots(parent)
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])


def link_tile(tree_values: np.ndarray, queries: np.ndarray | None, radius: int, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Spanning star edges (value, root value) of what is linked; ``queries`` None: the tree's own values."""
    own = queries is None
    asked = tree_values if own else queries
    tree, offset = BkTree(tree_values), 0 if own else len(tree_values)
    everyone = tree_values if own else np.concatenate([tree_values, asked])
    parent = np.arange(len(everyone))
    for lo in range(0, len(asked), block):
        for q, node in tree.within(asked[lo : lo + block], radius):
            parent = _union(parent, q + lo + offset, node)
    parent = _roots(parent)
    linked = parent != np.arange(len(parent))
    return everyone[linked], everyone[parent[linked]]


def _blocks(fp: Column, n: int) -> list[Column]:
    """``n`` runs of bits that together are all 64."""
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:])]


def links(fps: DataFrame, radius: int = RADIUS, part_rows: int = PART_ROWS) -> DataFrame:
    """(a, b) with b linked to a, over the distinct values of column ``fp``; spanning, not all pairs."""
    n_shards = max(LEAST_SHARDS, fps.count() // SHARD_ROWS)
    keyed = fps.select("fp", F.posexplode(F.array(*_blocks(F.col("fp"), radius + 1))).alias("block", "bits")).select(
        "fp", (F.pmod(F.xxhash64("bits", "block"), F.lit(n_shards)) * (radius + 1) + F.col("block")).alias("shard")
    )
    parts = keyed.groupBy("shard").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts")).where("parts > 1")
    placed = keyed.join(parts, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    )
    # Part p is in the tree of the tiles (p, q >= p) and asks in the tiles (t < p, p).
    as_tree = F.transform(F.sequence("part", F.col("parts") - 1), lambda q: F.struct(F.col("part").alias("t"), q.alias("q"), F.lit(True).alias("in_tree")))
    asks = F.when(F.col("part") > 0, F.transform(F.sequence(F.lit(0), F.col("part") - 1), lambda t: F.struct(t.alias("t"), F.col("part").alias("q"), F.lit(False).alias("in_tree"))))
    tiles = placed.select("fp", "shard", F.explode(F.concat(as_tree, F.coalesce(asks, F.array().cast("array<struct<t:int,q:int,in_tree:boolean>>")))).alias("x")).select("fp", "shard", "x.*")

    def tile(key, g: pd.DataFrame) -> pd.DataFrame:
        values, inside = g["fp"].to_numpy().view(np.uint64), g["in_tree"].to_numpy(dtype=bool)
        a, b = link_tile(values[inside], None if key[1] == key[2] else values[~inside], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return tiles.groupBy("shard", "t", "q").applyInPandas(tile, "a long, b long")


# --- components ---


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the least node it is connected with."""
    now = shared.cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))
        )
        now = shared.cut(small.distinct())


def near_dups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: (id, key, fp, component_id)."""
    rows = shared.store(docs.select(
        docs[id_col].alias("id"), shared.row_key(docs[id_col], docs[text_col]).alias("key"), fingerprint_of(docs[text_col]).alias("fp")
    ))
    fps = shared.cut(rows.groupBy("fp").agg(F.min("id").alias("id")))
    roots = shared.cut(components(links(fps, radius)))
    named = fps.join(roots, fps["fp"] == roots["node"]).groupBy("root").agg(F.min("id").alias("component_id"))
    moved = roots.join(named, "root").select(F.col("node").alias("fp"), "component_id")
    of = fps.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "id").alias("component_id"))
    return rows.join(of, "fp").select("id", "key", "fp", "component_id")


def op4(docs: DataFrame) -> DataFrame:
    return near_dups(docs).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def stage(docs: DataFrame) -> DataFrame:
    """One document of each component stays: the one with the smallest id. Rows without an id stay unless one with an id is near."""
    found = near_dups(docs).where(F.col("id").eqNullSafe(F.col("component_id")))
    return shared.keep_rows(docs, found.select(F.col("key").alias("__key")))
