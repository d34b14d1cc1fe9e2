"""Readers, writers, splits and input checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listlens.functions.encode import label_code
from listlens.operators.ordering import running_total
from listlens.session import broadcast_if_small, null_safe_join

# Most keys one task sorts for a hold-out.
_TOP_KEYS = 1_000_000
_TEXT, _TEXTS = T.StringType(), T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


LISTING_SCHEMA = _struct(
    id=_TEXT, title=_TEXT, condition=_TEXT, price=T.DoubleType(), base_price=T.DoubleType(),
    initial_quantity=T.LongType(), available_quantity=T.LongType(), sold_quantity=T.LongType(),
    listing_type_id=_TEXT, buying_mode=_TEXT, warranty=_TEXT, warranty_category=_TEXT,
    official_store_id=T.LongType(), automatic_relist=T.BooleanType(),
    tags=_TEXTS, sub_status=_TEXTS, deal_ids=_TEXTS,
    shipping=_struct(
        local_pick_up=T.BooleanType(), free_shipping=T.BooleanType(), mode=_TEXT, methods=_TEXTS,
        tags=_TEXTS, dimensions=_TEXT,
    ),
    non_mercado_pago_payment_methods=T.ArrayType(_struct(id=_TEXT, description=_TEXT, type=_TEXT)),
    variations=T.ArrayType(_struct(available_quantity=T.LongType(), price=T.DoubleType())),
    attributes=T.ArrayType(_struct(id=_TEXT, value_name=_TEXT)),
    seller_address=_struct(state=_struct(name=_TEXT)),
)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    """One JSON object per line, with a declared schema."""
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with header; the schema is inferred only when none is given.

    ``multi_line`` reads line breaks inside quotes, at the price of one task per file; without it files are split.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame, at_most: int = 32) -> DataFrame:
    """Deal the rows of a small scan out evenly before CPU-heavy work per row.

    Only a scan of at most ``at_most`` splits (4 GB at Spark's default split size) with fewer splits
    than half the cores is dealt out; any larger source stays as it is read. Call it on the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(cores) if splits <= at_most and splits * 2 <= cores else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_report(sections: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """One JSON-lines folder per report section."""
    for name, df in sections.items():
        df.write.mode(mode).json(f"{path}/{name}")


def write_results(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Per-model results, stamped with the run time, as JSON lines."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    metrics.withColumn("run_at", stamp).write.mode(mode).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("input has no rows")
    return df


def holdout_last(df: DataFrame, key: str, n: int = 10_000, ties: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Train = all but the last ``n`` rows in key order, test = these ``n``.

    For a test part that fits a task only the ``n`` largest keys meet in one place; a larger one is
    counted off range by range. Everything else is a filter on the scan. Rows without a key are train
    rows. ``ties`` name further columns that order rows of equal key; rows equal in all of them stay
    together, so give enough to tell rows apart.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    place = F.struct(key, *ties) if ties else F.col(key)
    keys = df.where(F.col(key).isNotNull()).select(place.alias("__key"))
    if n <= _TOP_KEYS:
        last = keys.orderBy(F.desc("__key")).limit(n)
    else:
        ranked = running_total(keys.withColumn("__one", F.lit(1).cast("long")), {"__place": "__one"}, [F.desc("__key")])
        last = ranked.where(F.col("__place") <= n)
    cut = last.agg(F.min("__key")).scalar()
    late = place >= cut
    return df.where(F.col(key).isNull() | F.coalesce(~late, F.lit(True))), df.where(F.col(key).isNotNull() & late)


def hide_target(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(features without the label, label column)."""
    return df.drop(label), df.select(label)


def stratified_split(
    df: DataFrame, cls: str, key: str, test_share: float = 0.2, draw: Column | None = None, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(share * n)`` rows of each class, the lowest draws first.

    ``draw`` is a whole number spread evenly over 0..2^60-1 (default: hash of the key). A class can
    hold most rows, so it is never ranked whole: draws fall into 4096 ordered cells, the counts tell
    which cell holds the cut, and only that cell is ranked to find the cutting row. The rows
    themselves are then marked by comparison, without a shuffle.
    """
    h = draw if draw is not None else F.xxhash64(F.lit(seed), F.col(key)).bitwiseAND(F.lit((1 << 60) - 1))
    marked = df.withColumn("__h", h).withColumn("__cell", F.shiftright("__h", 48))
    upto = Window.partitionBy(cls).orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    # At most 4096 rows per class.
    sizes = (
        marked.groupBy(cls, "__cell")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__upto", F.sum("__n").over(upto))
        .withColumn("__want", F.ceil(F.sum("__n").over(Window.partitionBy(cls)) * F.lit(test_share)))
    )
    at_cut = sizes.where((F.col("__upto") >= F.col("__want")) & (F.col("__upto") - F.col("__n") < F.col("__want")))
    at_cut = at_cut.select(cls, "__cell", (F.col("__want") - F.col("__upto") + F.col("__n")).alias("__take"))
    w = Window.partitionBy(cls).orderBy("__h", key)
    last = (
        null_safe_join(marked.select(cls, key, "__h", "__cell"), broadcast_if_small(at_cut), (cls, "__cell"))
        .withColumn("__place", F.row_number().over(w))
        .where(F.col("__place") == F.col("__take"))
        .select(cls, F.struct(F.col("__h"), F.col(key).alias("k")).alias("__last"))
    )
    mine = F.struct(F.col("__h"), F.col(key).alias("k"))
    return null_safe_join(marked, broadcast_if_small(last), (cls,)).select(*df.columns, (mine <= F.col("__last")).alias("is_test"))


def encode_label(df: DataFrame, column: str, codes: dict[str, int]) -> DataFrame:
    """Replace label text by its code; other values become null."""
    return df.withColumn(column, label_code(F.col(column), codes))


def load_train_test(
    train: DataFrame, test: DataFrame | None, label: str, codes: dict[str, int] | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Labelled training rows and, when given, test rows with the same feature columns."""
    require_columns(train, [label])
    out = encode_label(train, label, codes) if codes else train
    if test is None:
        return out, None
    features = [c for c in train.columns if c != label]
    require_columns(test, features)
    keep = features + ([label] if label in test.columns else [])
    held = test.select(*keep)
    return out, encode_label(held, label, codes) if codes and label in held.columns else held
