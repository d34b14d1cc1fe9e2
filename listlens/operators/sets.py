"""Set operations, row appends and key lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).union(b.select(key)).distinct()


def distinct_elements(df: DataFrame, array: str) -> DataFrame:
    """Distinct elements over all arrays of a column."""
    return df.select(F.explode(array).alias("element")).distinct()


def clean_distinct(df: DataFrame, column: str, sentinel: str) -> DataFrame:
    """Lower-cased distinct non-empty values without the placeholder value."""
    low = F.lower(F.col(column))
    return df.select(low.alias(column)).where((F.col(column) != "") & (F.col(column) != sentinel)).distinct()


def append_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both by column name; columns one side lacks become null."""
    return a.unionByName(b, allowMissingColumns=True)


def lookup_scores(left: DataFrame, right: DataFrame, on: str = "feature") -> DataFrame:
    return left.join(right, on, "inner")


def attach_label(features: DataFrame, labels: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Bring labels to their rows by key, never by position."""
    return features.join(labels, on, "inner")
