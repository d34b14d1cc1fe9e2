"""Exact dedup with a minimal perfect hash over the digests of history.

History is grouped by digest; each shard of digests gets a minimal perfect hash whose slots hold the full
digest, the place of the winning row and the number of rows. A new digest is looked up in its shard: the
slot it lands on is compared byte by byte, a hit joins the group of history, anything else is a group of
its own. Rows of new data are grouped by digest before they are looked up, so a text with very many copies
is one lookup; every later step works on rows of a few dozen bytes.

Defined cases: a null text is the empty text; rows without an id come after all ids and can win only
among themselves; of rows that repeat an id and a text exactly one is kept; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listlens.llm import shared

#: Digests a shard of the index holds on average.
SHARD_ROWS = 2048
LEAST_SHARDS = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), shared.SPACE, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, digest, row): ``row`` tells repeated rows apart, so store the frame before it is read twice."""
    return docs.select(
        docs[id_col].alias("id"),
        shared.row_key(docs[id_col], docs[text_col]).alias("key"),
        F.unhex(F.sha2(normalised(docs[text_col]), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )


def _groups(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("first")
    return rows.groupBy("digest").agg(first, F.count("*").alias("size")).select(
        "digest", "first.no_id", "first.id", "first.row", "size"
    )


# --- the hash itself: levels of bits, as many as it takes until each key has a bit of its own ---


def _cells(words: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = words[:, level % 4] + words[:, (level // 4 + level + 1) % 4] * np.uint64(2 * level + 1)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


def _words(digest: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digest), dtype="<u8").reshape(-1, 4)


def build_hash(digest: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, the levels' bits, and the slot of each digest: 0..n-1, each used once."""
    words, left, at = _words(digest), np.arange(len(digest)), 0
    sizes: list[int] = []
    bits: list[np.ndarray] = []
    place = np.zeros(len(digest), dtype=np.int64)
    while len(left):
        size = 2 * len(left) + 1
        cells = _cells(words[left], len(sizes), size)
        alone = np.bincount(cells, minlength=size) == 1
        mine = alone[cells]
        place[left[mine]] = at + cells[mine]
        sizes.append(size)
        bits.append(alone)
        left, at = left[~mine], at + size
    flat = np.concatenate(bits) if bits else np.zeros(0, dtype=bool)
    return sizes, flat, (np.cumsum(flat) - 1)[place] if len(flat) else place


def look_up(sizes: list[int], bits: np.ndarray, digest: list[bytes]) -> np.ndarray:
    """The slot each digest would have, or -1. A digest that was not built in may get any slot."""
    slots = np.full(len(digest), -1, dtype=np.int64)
    if not len(bits) or not len(digest):
        return slots
    words, rank, left, at = _words(digest), np.cumsum(bits) - 1, np.arange(len(digest)), 0
    for level, size in enumerate(sizes):
        cells = at + _cells(words[left], level, size)
        hit = bits[cells]
        slots[left[hit]] = rank[cells[hit]]
        left, at = left[~hit], at + size
    return slots


def _index_type(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("shard", T.LongType()),
        T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("bits", T.BinaryType()),
        T.StructField("digests", T.ArrayType(T.BinaryType())),
        T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("rows", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
    ])


def _ids(column: pd.Series) -> list:
    return [None if v is None or v is pd.NA or v != v else v for v in column.tolist()]


def build_index(history: DataFrame, n_shards: int) -> DataFrame:
    """One row per shard: the hash, and in slot order digest, winner (id and row) and number of rows."""

    def build(key, g: pd.DataFrame) -> pd.DataFrame:
        found = [bytes(d) for d in g["digest"]]
        sizes, bits, slots = build_hash(found)
        order = np.argsort(slots)
        ids = _whole(_ids(g["id"]), g["no_id"])
        return pd.DataFrame({
            "shard": [key[0]], "sizes": [sizes], "bits": [np.packbits(bits).tobytes()],
            "digests": [[found[i] for i in order]], "ids": [[ids[i] for i in order]],
            "rows": [g["row"].to_numpy()[order]], "counts": [g["size"].to_numpy()[order]],
        })

    id_type = history.schema["id"].dataType
    return _sharded(_safe(history), n_shards).groupBy("shard").applyInPandas(build, _index_type(id_type))


def _safe(groups: DataFrame) -> DataFrame:
    """Null ids of a numeric type would turn a pandas column into floats; they travel as a zero and a flag."""
    kind = groups.schema["id"].dataType
    return groups.withColumn("id", F.coalesce("id", F.lit(0).cast(kind))) if isinstance(kind, T.NumericType) else groups


def _whole(ids: list, no_id: pd.Series) -> list:
    return [None if n else i for i, n in zip(ids, no_id, strict=True)]


def _sharded(groups: DataFrame, n_shards: int) -> DataFrame:
    return groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(n_shards)))


def merge(index: DataFrame, fresh: DataFrame, n_shards: int) -> DataFrame:
    """(digest, keep_id, keep_row, group_size) of all digests of the index and of the grouped new rows."""
    id_type = index.schema["ids"].dataType.elementType

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        new = [bytes(d) for d in right["digest"]]
        new_ids = _whole(_ids(right["id"]), right["no_id"]) if len(right) else []
        old, ids, rows, counts, slots = [], [], [], [], np.full(len(new), -1, dtype=np.int64)
        if len(left):
            x = left.iloc[0]
            old, ids, rows, counts = [bytes(d) for d in x["digests"]], list(x["ids"]), list(x["rows"]), list(x["counts"])
            bits = np.unpackbits(np.frombuffer(x["bits"], dtype=np.uint8))[: int(sum(x["sizes"]))].astype(bool)
            slots = look_up(list(x["sizes"]), bits, new)
        ids = [None if i is None or i != i else i for i in ids]
        for d, i, r, n, s in zip(new, new_ids, right["row"], right["size"], slots, strict=True):
            if s >= 0 and old[s] == d:  # byte-checked: a member of history
                counts[s] += n
                if ids[s] is None and i is not None or ids[s] is not None and i is not None and i < ids[s]:
                    ids[s], rows[s] = i, r
            else:
                old.append(d), ids.append(i), rows.append(r), counts.append(n)
        return pd.DataFrame({
            "digest": old, "keep_id": pd.Series(ids, dtype=object), "keep_row": pd.Series(rows, dtype="int64"),
            "group_size": pd.Series(counts, dtype="int64"),
        })

    out = T.StructType([
        T.StructField("digest", T.BinaryType()), T.StructField("keep_id", id_type),
        T.StructField("keep_row", T.LongType()), T.StructField("group_size", T.LongType()),
    ])
    return index.groupBy("shard").cogroup(_sharded(_safe(fresh), n_shards).groupBy("shard")).applyInPandas(probe, out)


def dedup(docs: DataFrame, is_history: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, key, digest, keep_id, group_size, kept).

    ``is_history``: a condition on ``id`` that says which rows were there before; a winner is the row with
    the smallest id wherever it lies.
    """
    rows = shared.store(digests(docs, id_col, text_col).withColumn("old", F.coalesce(is_history, F.lit(False))))
    history, fresh = _groups(rows.where("old")), _groups(rows.where("not old"))
    n_shards = max(LEAST_SHARDS, rows.where("old").count() // SHARD_ROWS)
    groups = merge(build_index(history, n_shards), fresh, n_shards)
    return rows.join(groups, "digest").select(
        "id", "key", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")
    )


def _earlier_half(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """Half of the range of ids stands for what an earlier crawl brought."""
    lo, hi = docs.agg(F.min(id_col), F.max(id_col)).first()
    return F.col("id") < F.lit(lo + (hi - lo) // 2 if lo is not None else 0)


def op1(docs: DataFrame) -> DataFrame:
    found = dedup(docs, _earlier_half(docs))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def stage(docs: DataFrame) -> DataFrame:
    """The documents that stay, all columns."""
    kept = dedup(docs, _earlier_half(docs)).where("kept").select(F.col("key").alias("__key"))
    return shared.keep_rows(docs, kept)


SQL_OP1 = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
