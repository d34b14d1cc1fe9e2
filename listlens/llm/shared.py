"""What the corpus operators share: tables, stored intermediate results, keys that survive nulls."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a Java and Python class; ``bytes.split()`` cuts at the same bytes.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new path below the cluster's checkpoint folder. Only a local master without one gets its own."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpus-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them back: compact, and safe when executors go."""
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """checkpoint() in the shared folder."""
    work_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def id_key(c: Column) -> Column:
    """A string key for an id of any type; null ids get a key that no id has."""
    return F.coalesce(F.concat(F.lit("i"), c.cast("string")), F.lit("n"))


def id_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def row_key(id_col: Column, text: Column) -> Column:
    """Names a row by its id and text, so that rows that share only the id stay apart."""
    return F.concat(id_key(id_col), F.lit(":"), F.xxhash64(F.coalesce(text, F.lit(""))).cast("string"))


def keep_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is in ``keys`` (one column ``__key``), repeated rows once.

    The join and the removal of repeats use one shuffle by a key that is all but unique. The rows travel as one struct,
    so their columns may have any names.
    """
    keyed = docs.select(row_key(docs[id_col], docs[text_col]).alias("__key"), F.struct("*").alias("row"))
    return keyed.join(keys, "__key", "left_semi").dropDuplicates(["__key"]).select("row.*")


def _crc_steps() -> str:
    """The CRC-32 of the 16 half bytes, as a list in SQL."""
    steps = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ 0xEDB88320 if c & 1 else c >> 1
        steps.append(f"{c}::UINTEGER")
    return f"[{', '.join(steps)}]"


def sql_crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of the UTF-8 of ``text``, whose characters lie below U+0100; half a byte a step, the low one first."""
    code = "unicode(x)::UINTEGER"
    halves = (
        f"flatten(list_transform(string_split({text}, ''), lambda x: CASE WHEN x = '' THEN [] WHEN unicode(x) < 128 THEN [{code} & 15, {code} >> 4] "
        f"ELSE [{code} >> 6, 12::UINTEGER, {code} & 15, 8 | (({code} >> 4) & 3)] END))"
    )
    return f"xor(list_reduce(list_prepend(4294967295::UINTEGER, {halves}), lambda c, b: xor({_crc_steps()}[(xor(c, b) & 15) + 1], c >> 4)), 4294967295::UINTEGER)"
