"""Column expressions turning categories and numbers into model inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one_hot(col: Column, vocabulary: Sequence[str]) -> dict[str, Column]:
    """One 0/1 column per listed value; unknown and null values are 0 everywhere."""
    return {v: col.eqNullSafe(F.lit(v)).cast("int") for v in vocabulary}


def dummies(col: Column, categories: Sequence[str], prefix: str) -> dict[str, Column]:
    """0/1 columns ``prefix_value`` for all but the first category in sorted order."""
    return {f"{prefix}_{v}": col.eqNullSafe(F.lit(v)).cast("int") for v in sorted(categories)[1:]}


def keep_or_other(col: Column, keep: Sequence[str], other: str = "Otros") -> Column:
    return F.when(col.isin(list(keep)), col).otherwise(F.lit(other))


def remap(col: Column, mapping: Mapping) -> Column:
    """Replace listed values; everything else stays as it is."""
    if not mapping:
        return col
    out = F
    for old, new in mapping.items():
        out = out.when(col == F.lit(old), F.lit(new))
    return out.otherwise(col)


def fit_label_codes(df: DataFrame, column: str) -> dict[str, int]:
    """Codes 0, 1, ... of a classifier's labels in sorted order; more than 1000 are refused (``code_table`` has no bound)."""
    values = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(1001).collect()]
    if len(values) > 1000:
        raise ValueError(f"{column} has more than 1000 distinct values")
    return {v: i for i, v in enumerate(sorted(values))}


def label_code(col: Column, codes: Mapping[str, int]) -> Column:
    """Number of a class name; other values are null."""
    out = F.lit(None).cast("int")
    for text, code in codes.items():
        out = F.when(col == F.lit(text), F.lit(code)).otherwise(out)
    return out


def label_name(col: Column, codes: Mapping[str, int]) -> Column:
    """Class name of a number; other values are null."""
    out = F.lit(None).cast("string")
    for text, code in codes.items():
        out = F.when(col == F.lit(code), F.lit(text)).otherwise(out)
    return out


def is_present(col: Column) -> Column:
    return col.isNotNull().cast("int")


def membership_pair(col: Column, members: Sequence[str]) -> tuple[Column, Column]:
    """(1 if listed, 1 if not listed); null counts as not listed."""
    listed = F.coalesce(col.isin(list(members)), F.lit(False))
    return listed.cast("int"), (~listed).cast("int")


def differs(col: Column, value) -> Column:
    """``col != value`` where a null differs from every value."""
    return col.isNull() | (col != F.lit(value))


def cut_right(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins, lowest edge included; values outside the edges are null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    out = F.when((col >= edges[0]) & (col <= edges[1]), F.lit(labels[0]))
    for lo, hi, label in zip(edges[1:-1], edges[2:], labels[1:]):
        out = out.when((col > lo) & (col <= hi), F.lit(label))
    return out


def bools_to_int(df: DataFrame) -> DataFrame:
    """Cast every boolean column to 0/1, nulls kept."""
    return df.select(
        *[
            F.col(f.name).cast("int").alias(f.name) if isinstance(f.dataType, T.BooleanType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def with_features(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Put new columns beside the existing ones of the same row."""
    return df.withColumns(dict(columns))


def finite(df: DataFrame, columns: Sequence[str], cap: float = 1e6) -> DataFrame:
    """NaN and null become 0, +/-infinity become +/-cap."""
    inf = F.lit(float("inf"))

    def clean(name: str) -> Column:
        c = F.col(name).cast("double")
        return (
            F.when(c.isNull() | F.isnan(c), F.lit(0.0))
            .when(c == inf, F.lit(cap))
            .when(c == -inf, F.lit(-cap))
            .otherwise(c)
        )

    return df.withColumns({c: clean(c) for c in columns})


def count_nonfinite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, nan, inf`` for the listed double columns, in one pass."""
    inf = float("inf")
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [
            F.count_if(F.isnan(v)).alias(f"nan{i}"),
            F.count_if((v == F.lit(inf)) | (v == F.lit(-inf))).alias(f"inf{i}"),
        ]
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col(f"nan{i}").alias("nan"), F.col(f"inf{i}").alias("inf"))
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
