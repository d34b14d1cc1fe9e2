"""Exact quantiles, describe and histogram by selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listlens.operators import selection
from listlens.session import null_safe_join, with_totals


def _value_table(df: DataFrame, column: str, by: tuple[str, ...]) -> DataFrame:
    c = F.col(column).cast("double")
    return (
        df.select(*by, c.alias("value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*by, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles as columns ``q0, q1, ...``, one row per group.

    Found by radix selection; the built-in exact ``percentile`` would hold every distinct value of a group in one task.
    """
    return selection.quantiles(df, column, probs, by)


def describe_numeric(df: DataFrame, column: str, digits: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """mean, mode (lowest on ties), min, max, q1, q2, q3, rounded."""
    by = tuple(by)
    sums = _value_table(df, column, by).groupBy(*by).agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("mode"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    parts = selection.quantiles(df, column, [0.25, 0.5, 0.75], by)
    out = null_safe_join(sums, parts, by) if by else with_totals(sums, parts)
    names = {"mean": "mean", "mode": "mode", "min": "min", "max": "max", "q0": "q1", "q1": "q2", "q2": "q3"}
    return out.select(*by, *[F.round(c, digits).alias(n) for c, n in names.items()])


def histogram(df: DataFrame, column: str, bins: int = 50, upper_quantile: float = 0.99) -> DataFrame:
    """Equal-width bins (last one closed) of the values not above the quantile: bin, lower, upper, count."""
    limit = selection.quantiles(df, column, [upper_quantile]).scalar()
    value = F.col(column).cast("double")
    kept = df.select(value.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value") & (F.col("value") <= limit))
    edges = kept.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor(F.try_divide(F.col("value") - F.col("lo"), width)), F.lit(bins - 1))
    )
    return (
        with_totals(kept, edges)
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"), F.max("lo").alias("lo"), F.max("hi").alias("hi"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * width).alias("lower"),
            (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
            "count",
        )
    )
