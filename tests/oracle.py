"""Compare registered queries with their SQL on DuckDB. Usage: python tests/oracle.py SF_DIR [name part ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    "int": "INTEGER",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return (2, "nan") if math.isnan(v) else (3, 0.0 if v == 0 else v)
    if isinstance(v, int):
        return (3, v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return (4, str(v))
    if isinstance(v, (list, tuple)):
        return (5, tuple(cell(x) for x in v))
    return (6, str(v))


def rows_of(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in at) for r in rows), key=repr)


def compare(spark, con, run, sql, sf_dir):
    """Problems found, as text; empty when both sides agree."""
    df = run(spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    res = con.sql(sql)
    names, types = list(res.columns), [str(t) for t in res.types]
    theirs = res.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for f in df.schema.fields:
        kind = types[names.index(f.name)]
        if KINDS.get(f.dataType.simpleString(), kind) != kind:
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} != {kind}")
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} != {len(theirs)}")
    a, b = rows_of(df.columns, mine), rows_of(names, theirs)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        problems.append(f"{len(bad)} rows differ, e.g. {bad[:2]}")
    if not mine:
        problems.append("empty")
    return problems


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = duck(sf_dir), e.oracle_sql(), 0
    for name, run in e.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        started = time.monotonic()
        try:
            if name in oracles:
                problems = compare(spark, con, run, oracles[name], sf_dir)
            else:
                problems = [] if run(spark, sf_dir).count() else ["empty"]
        except Exception as ex:  # noqa: BLE001
            problems = [f"{type(ex).__name__}: {str(ex)[:1500]}"]
        failed += bool(problems)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {time.monotonic() - started:6.2f}s {name}", *problems, sep="\n     " if problems else "", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
