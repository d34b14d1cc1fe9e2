"""Profiles of array and struct columns."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listlens.operators.ordering import top_k_per_group


def element_counts(df: DataFrame, array: str) -> DataFrame:
    """Occurrences of each element over all rows."""
    return df.select(F.explode(array).alias("element")).groupBy("element").count()


def empty_count(df: DataFrame, array: str) -> DataFrame:
    """Rows whose array is present and empty."""
    return df.agg(F.count_if(F.size(array) == 0).alias("empty_rows"))


def key_population(df: DataFrame, struct: str, examples: int = 5) -> DataFrame:
    """Per struct field: rows with content, and up to ``examples`` distinct contents as text.

    Content is a non-empty list, or a value that is neither null nor ''. The smallest contents in
    code-point order are shown. Each task counts its rows and keeps its ``examples`` smallest contents
    per field, so that many rows per field and task are shuffled, however many contents there are.
    """
    fields = df.schema[struct].dataType.fields
    contents = []
    for f in fields:
        value = F.col(struct).getField(f.name)
        if isinstance(f.dataType, T.ArrayType):
            filled, shown = F.size(value) > 0, F.to_json(value)
        else:
            shown = value.cast("string") if not isinstance(f.dataType, T.StructType) else F.to_json(value)
            filled = value.isNotNull() & (shown != "")
        contents.append(F.when(filled, shown))
    partial = df.select(*[v.alias(f"c{i}") for i, v in enumerate(contents)]).mapInPandas(
        _smallest([f.name for f in fields], examples), "key string, value string, n bigint"
    )
    # A null value carries the rows of its task.
    counts = partial.groupBy("key", "value").agg(F.sum("n").alias("n"))
    totals = counts.where(F.col("value").isNull()).select("key", F.col("n").alias("rows_with_content"))
    shown = top_k_per_group(counts.where(F.col("value").isNotNull()), ["key"], [F.asc("value")], examples)
    lists = shown.groupBy("key").agg(F.array_sort(F.collect_list("value")).alias("examples"))
    return totals.join(lists, "key", "left")


def _smallest(names: Sequence[str], k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per task and column: rows with a value, and the ``k`` smallest distinct values."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, least = [0] * len(names), [[] for _ in names]
        for pdf in batches:
            for i in range(len(names)):
                values = pdf.iloc[:, i].dropna()
                rows[i] += len(values)
                least[i] = heapq.nsmallest(k, {*least[i], *values.unique()})
        out = [(name, None, n) for name, n in zip(names, rows)]
        out += [(name, value, 0) for name, values in zip(names, least) for value in values]
        yield pd.DataFrame(out, columns=["key", "value", "n"])

    return task


def tuple_counts(df: DataFrame, array: str, fields: Sequence[str], k: int | None = 10) -> DataFrame:
    """Occurrences of each field combination in an array of structs, the ``k`` most frequent first."""
    items = df.select(F.explode(array).alias("x")).select(*[F.col("x").getField(f).alias(f) for f in fields])
    counts = items.groupBy(*fields).count()
    if k is None:
        return counts
    return counts.orderBy(F.desc("count"), *[F.asc(f) for f in fields]).limit(k)


def tuple_totals(df: DataFrame, array: str, fields: Sequence[str]) -> DataFrame:
    """Items over all rows and distinct field combinations."""
    return tuple_counts(df, array, fields, None).agg(
        F.sum("count").alias("items"), F.count(F.lit(1)).alias("distinct_items")
    )


def nonempty_by_class(df: DataFrame, array: str, cls: str) -> DataFrame:
    return df.where(F.size(array) > 0).groupBy(cls).count()


def element_stats(df: DataFrame, array: str, field: str, cls: str, value: str) -> DataFrame:
    """Items, mean, min, max of a struct field over the arrays of one class (missing fields left out)."""
    return (
        df.where(F.col(cls) == value)
        .select(F.explode(array).alias("x"))
        .select(F.col("x").getField(field).alias("v"))
        .agg(
            F.count("v").alias("items"),
            F.avg("v").alias("mean"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
        )
    )


def element_distribution(df: DataFrame, array: str, field: str, cls: str, value: str) -> DataFrame:
    """Occurrences of each value of a struct field over the arrays of one class."""
    return (
        df.where(F.col(cls) == value)
        .select(F.explode(array).alias("x"))
        .select(F.col("x").getField(field).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .count()
    )


def element_class_counts(df: DataFrame, array: str, cls: str) -> DataFrame:
    """Rows per (element, class); empty arrays count under a null element, null arrays nowhere."""
    return (
        df.where(F.col(array).isNotNull())
        .select(F.explode_outer(array).alias("element"), F.col(cls))
        .groupBy("element", cls)
        .count()
    )
