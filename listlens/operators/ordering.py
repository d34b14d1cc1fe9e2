"""Sorted views without a single-task global window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listlens.session import broadcast_if_small, cut_lineage, null_safe_join, store_rows

_SLICE = "__slice"


def running_total(
    df: DataFrame,
    sums: Mapping[str, str],
    order: Sequence[Column],
    by: tuple[str, ...] = (),
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running sums of ``sums`` (output name -> column) within ``by``, and group ``totals``.

    Rows are range-partitioned on the order, summed inside each range, and lifted by the total of
    the ranges before it, so no task ever sees more than one range. ``order`` must end in a column
    that makes rows distinct. The ranges are fixed by a checkpoint: both reads must agree on them.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(
        df.repartitionByRange(parts, *[F.col(b) for b in by], *order).withColumn(
            _SLICE, F.spark_partition_id()
        )
    )
    inside = Window.partitionBy(*by, _SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row per range and group: ``parts`` rows when ungrouped.
    before = Window.partitionBy(*by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    totals = totals or {}
    lifts = (
        ranged.groupBy(*by, _SLICE)
        .agg(
            *[F.sum(c).alias(f"__{out}") for out, c in sums.items()],
            *[F.sum(c).alias(f"__t_{out}") for out, c in totals.items()],
        )
        .select(
            *by,
            _SLICE,
            *[F.coalesce(F.sum(f"__{out}").over(before), F.lit(0)).alias(f"__lift_{out}") for out in sums],
            *[F.sum(f"__t_{out}").over(group).alias(out) for out in totals],
        )
    )
    local = ranged.select("*", *[F.sum(c).over(inside).alias(f"__in_{out}") for out, c in sums.items()])
    joined = null_safe_join(local, broadcast_if_small(lifts), (*by, _SLICE))
    return joined.select(
        *df.columns,
        *[(F.col(f"__in_{out}") + F.col(f"__lift_{out}")).alias(out) for out in sums],
        *totals,
    )


def running_rank(df: DataFrame, output: str, order: Sequence[Column], by: tuple[str, ...] = ()) -> DataFrame:
    """Add the 1-based place of every row in ``order`` within ``by``: ``running_total`` of ones for wide rows.

    Rows are numbered as their sorted range is written, so they are shuffled once and stored in columns. The lift of a range and group
    is the rows of the group before it, less the group's first number in the range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_by = [*[F.col(b) for b in by], *order]
    ranged = df.repartitionByRange(parts, *sorted_by).sortWithinPartitions(*sorted_by)
    numbered = store_rows(ranged.withColumns({_SLICE: F.spark_partition_id(), "__number": F.monotonically_increasing_id()}))
    before = Window.partitionBy(*by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy(*by, _SLICE).agg(F.count(F.lit(1)).alias("__rows"), F.min("__number").alias("__first"))
    lifts = sizes.select(*by, _SLICE, (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first") + 1).alias("__lift"))
    joined = null_safe_join(numbered, broadcast_if_small(lifts), (*by, _SLICE))
    return joined.select(*df.columns, (F.col("__number") + F.col("__lift")).alias(output))


def running_share(counts: DataFrame, value: str, order: Sequence[Column]) -> DataFrame:
    """``cum_share`` = running sum of ``value`` over its total, ``position`` = 1-based place."""
    ranked = running_total(
        counts.withColumn("__one", F.lit(1).cast("long")),
        {"__cum": value, "position": "__one"},
        order,
        totals={"__total": value},
    )
    share = F.try_divide(F.col("__cum").cast("double"), F.col("__total"))
    return ranked.withColumn("cum_share", share).drop("__one", "__cum", "__total")


def first_reaching(shares: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """For each threshold the first position whose running share reaches it (null if none does)."""
    aggs = [
        F.min(F.when(F.col("cum_share") >= F.lit(t), F.col("position"))).alias(f"__{i}")
        for i, t in enumerate(thresholds)
    ]
    rows = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(f"__{i}").alias("position"))
            for i, t in enumerate(thresholds)
        ]
    )
    return shares.agg(*aggs).select(F.inline(rows))


def top_k_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per group with their ``place``.

    Spark turns the filtered ``row_number`` into a group limit before the shuffle, so a group
    that holds most rows still sends only ``k`` rows per task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def rank_metrics(metrics: DataFrame, keys: Sequence[str], tie: str = "model") -> DataFrame:
    """Sort descending by each key, then by name."""
    return metrics.orderBy(*[F.desc(k) for k in keys], F.asc(tie))


def n_largest(df: DataFrame, column: str, k: int, tie: str | None = None) -> DataFrame:
    return df.orderBy(F.desc(column), *([F.asc(tie)] if tie else [])).limit(k)


def arg_best(df: DataFrame, column: str, how: str = "max", tie: str | None = None) -> DataFrame:
    """The one row with the largest (``max``) or smallest (``min``) value; ties go to the lowest ``tie``."""
    if how not in ("max", "min"):
        raise ValueError("how must be 'max' or 'min'")
    first = F.desc_nulls_last(column) if how == "max" else F.asc_nulls_last(column)
    return df.orderBy(first, *([F.asc(tie)] if tie else [])).limit(1)


def most_common(counts: DataFrame, key: str, k: int, count: str = "count", min_count: int = 0) -> DataFrame:
    """The ``k`` most frequent keys, and of these only the ones seen at least ``min_count`` times."""
    top = counts.orderBy(F.desc(count), F.asc(key)).limit(k)
    return top.where(F.col(count) >= min_count) if min_count > 0 else top


# Most rows one task sorts for a slice.
_TOP_ROWS = 1_000_000


def slice_rows(df: DataFrame, order: Sequence[Column], start: int, stop: int) -> DataFrame:
    """Rows ``start`` to ``stop`` (exclusive) of the given order, which must tell rows apart.

    A slice near the top is taken from each task's first rows; a deep one is counted off range by range.
    """
    if stop <= _TOP_ROWS:
        return df.orderBy(*order).offset(start).limit(stop - start)
    ranked = running_total(df.withColumn("__one", F.lit(1).cast("long")), {"__place": "__one"}, order)
    return ranked.where((F.col("__place") > start) & (F.col("__place") <= stop)).orderBy("__place").select(*df.columns)


def first_where(df: DataFrame, predicate: Column, order: Sequence[Column]) -> DataFrame:
    return df.where(predicate).orderBy(*order).limit(1)
