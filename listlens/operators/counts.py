"""Frequency tables, pivots, class shares and column summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listlens.operators.ordering import running_total, top_k_per_group
from listlens.session import with_totals


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Occurrences per value, nulls left out, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .count()
        .orderBy(F.desc("count"), F.asc(column))
    )


def shares(df: DataFrame, column: str) -> DataFrame:
    """Value counts with ``share`` (0-1) and ``percent``."""
    known = df.where(F.col(column).isNotNull())
    total = known.agg(F.count(F.lit(1)).alias("__total"))
    share = F.try_divide(F.col("count").cast("double"), F.col("__total"))
    return (
        with_totals(known.groupBy(column).count(), total)
        .withColumn("share", share)
        .withColumn("percent", share * 100)
        .drop("__total")
    )


def cross_counts(df: DataFrame, rows: str, columns: str, values: Sequence | None = None) -> DataFrame:
    """Rows per (rows, columns) pair: one output column per given value, absent pairs 0.

    Without ``values`` the pairs come as a long table (rows, columns, count), however many values there are.
    """
    known = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    if values is None:
        return known.groupBy(rows, columns).count()
    out = known.groupBy(rows).pivot(columns, list(values)).count()
    return out.na.fill(0, [c for c in out.columns if c != rows])


def pivot_non_null(df: DataFrame, index: str, columns: str, counted: str, values: Sequence) -> DataFrame:
    """Non-null ``counted`` values per index and pivot value, absent pairs 0."""
    out = df.groupBy(index).pivot(columns, list(values)).agg(F.count(counted))
    return out.na.fill(0, [c for c in out.columns if c != index])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values; a null counts as one."""
    return df.select(column).distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``(column, distinct)`` per column, nulls not counted.

    Values go long first and are made distinct by a keyed aggregation, so a column with billions
    of values is spread over all tasks.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("distinct"))
    )


def code_table(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """(column, code): codes 0, 1, ... of the distinct non-null values in sorted order, for any number of values."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("__one", F.lit(1).cast("long"))
    return running_total(values, {code: "__one"}, [F.col(column)]).select(column, (F.col(code) - 1).alias(code))


def text_stats(df: DataFrame, text: str, cls: str) -> DataFrame:
    """Rows, mean/median/min/max length and mean/median words per class.

    The exact median keeps one counter per distinct length, and lengths are bounded by the
    longest text, so the state stays small however many rows there are.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_count(t, F.lit(r"(?U)\S+"))
    return (
        df.select(F.col(cls).alias("class"), F.length(t).alias("len"), words.alias("words"))
        .groupBy("class")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("len").alias("avg_length"),
            F.median("len").alias("median_length"),
            F.avg("words").alias("avg_words"),
            F.median("words").alias("median_words"),
            F.max("len").alias("max_length"),
            F.min("len").alias("min_length"),
        )
    )


def top_values_by_class(df: DataFrame, column: str, cls: str, k: int = 10) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(cls, column).count()
    return top_k_per_group(counts, [cls], [F.desc("count"), F.asc(column)], k)


def overview(df: DataFrame, column: str, cls: str, classes: Sequence[str]) -> DataFrame:
    """Rows, rows per class, and min/max/mean of one numeric column, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(cls) == c).alias(f"rows_{c}") for c in classes],
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
        F.avg(column).alias("mean_value"),
    )


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample variance per column, long form, smallest first."""
    row = df.agg(*[F.var_samp(c).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("variance")) for c in columns])
    return row.select(F.inline(pairs)).orderBy("variance", "feature")


def null_counts_by_class(df: DataFrame, column: str, cls: str) -> DataFrame:
    return df.groupBy(F.col(column).isNull().alias("is_null"), F.col(cls)).count()


def class_counts(df: DataFrame, key: str, cls: str, classes: Sequence[str]) -> DataFrame:
    """``n_<class>`` per key in one pass, absent classes 0."""
    return df.groupBy(key).agg(*[F.count_if(F.col(cls) == c).alias(f"n_{c}") for c in classes])


def with_share(counts: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Add ``total`` and the share of the first class; keys without rows are dropped."""
    total = reduce(Column.__add__, [F.col(f"n_{c}") for c in classes])
    first = classes[0]
    return (
        counts.withColumn("total", total)
        .where(F.col("total") > 0)
        .withColumn(f"ratio_{first}", F.col(f"n_{first}").cast("double") / F.col("total"))
    )


def class_share(df: DataFrame, key: str, cls: str, classes: Sequence[str] = ("new", "used")) -> DataFrame:
    return with_share(class_counts(df, key, cls, classes), classes)


def merge_counts(df: DataFrame, key: str, cls: str, classes: Sequence[str] = ("new", "used")) -> DataFrame:
    """Per-class frequencies of a key side by side: the outer merge of the class tables, as one aggregation."""
    return class_counts(df.where(F.col(key).isNotNull()), key, cls, classes)


def merge_count_tables(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer merge of two ``(key, count)`` tables, absent counts 0."""
    return (
        left.select(key, F.col("count").alias("left_count"))
        .join(right.select(key, F.col("count").alias("right_count")), key, "full")
        .na.fill(0, ["left_count", "right_count"])
    )
