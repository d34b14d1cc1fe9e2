"""Session helpers: checkpoint folder, lineage cuts, one-row lookups."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; a private one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", ""):
        return
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="listlens-checkpoint-"))


def shared_folder(spark: SparkSession) -> str:
    """A new, still unused path below the checkpoint folder, reachable by every executor."""
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    return f"{base}/listlens-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and go on from there.

    Needed where one plan reads the same rows twice and the answer depends on both
    reads seeing the same physical layout.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_rows(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet below the checkpoint folder and read them back.

    For large tables whose layout does not matter: columns take the room that their values need, and a reader only reads its own.
    """
    path = shared_folder(df.sparkSession)
    named = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # names that differ in case only are one to the reader
    named.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(named.schema).parquet(path).toDF(*df.columns)


def broadcast_if_small(df: DataFrame, at_most: int = 10_000) -> DataFrame:
    """The rows as a broadcast local table if there are at most ``at_most``, else the frame as it is.

    For tables that are small in all likelihood (a row per class, per range): the size is counted,
    not assumed, and a larger one is joined by shuffle.
    """
    rows = df.limit(at_most + 1).collect()
    if len(rows) > at_most:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def with_totals(df: DataFrame, totals: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Attach per-group totals; ungrouped totals (one row) come in as scalar subqueries."""
    if not by:
        return df.select("*", *[totals.select(c).scalar().alias(c) for c in totals.columns])
    return null_safe_join(df, totals, by)


def null_safe_join(left: DataFrame, right: DataFrame, by: tuple[str, ...], how: str = "inner") -> DataFrame:
    """Equi-join on ``by`` that also matches null keys; key columns appear once."""
    renamed = right.select(
        *[F.col(b).alias(f"__{b}") for b in by],
        *[c for c in right.columns if c not in by],
    )
    cond: Column | None = None
    for b in by:
        part = left[b].eqNullSafe(renamed[f"__{b}"])
        cond = part if cond is None else cond & part
    return left.join(renamed, cond, how).drop(*[f"__{b}" for b in by])
