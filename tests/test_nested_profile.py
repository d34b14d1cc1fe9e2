"""Key population keeps few contents per task and agrees with a plain count."""

from __future__ import annotations

from pyspark.sql import functions as F

from listlens.operators import nested_profile as npf


def test_key_population_is_bounded_and_exact(spark):
    n = 20_000
    rows = spark.range(n, numPartitions=4).select(
        F.struct(
            F.concat(F.lit("v"), F.col("id").cast("string")).alias("many"),
            F.when(F.col("id") % 2 == 0, F.lit("é")).when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.lit("z")).alias("few"),
            F.when(F.col("id") == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array().cast("array<int>")).alias("list"),
            F.lit(None).cast("string").alias("none"),
            F.struct((F.col("id") % 3).alias("x")).alias("inner"),
        ).alias("s")
    )
    got = {r["key"]: (r["rows_with_content"], r["examples"]) for r in npf.key_population(rows, "s").collect()}
    blank = sum(1 for i in range(n) if i % 2 and i % 3 == 0)
    assert got == {
        "many": (n, sorted(f"v{i}" for i in range(n))[:5]), "few": (n - blank, ["z", "é"]), "list": (1, ["[1,2]"]),
        "none": (0, None), "inner": (n, ['{"x":0}', '{"x":1}', '{"x":2}']),
    }


def test_few_rows_leave_each_task(spark):
    import pandas as pd

    batches = [pd.DataFrame({"c0": [f"{i:04d}" for i in range(b, 3000, 3)], "c1": [None] * 1000}) for b in range(3)]
    (out,) = npf._smallest(["a", "b"], 5)(iter(batches))
    assert len(out) == 7 and out["n"].sum() == 3000
    assert [v for k, v in zip(out["key"], out["value"]) if k == "a" and v is not None] == [f"{i:04d}" for i in range(5)]


def test_empty_table_has_no_content(spark):
    rows = spark.createDataFrame([], "s struct<a:string,b:array<int>>")
    assert all(r["rows_with_content"] == 0 and r["examples"] is None for r in npf.key_population(rows, "s").collect())
