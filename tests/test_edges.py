"""Rows and words that must not get lost: null and tied keys, white space, nulls in pairs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Estimator
from pyspark.sql import functions as F

from listlens.functions import text as tx
from listlens.operators import analysis, counts, models, ordering
from listlens.sources import files


def test_holdout_keeps_every_row(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (None, 3), (2, 4), (3, 5)], "k int, row int")
    for n, want in ((0, 0), (1, 1), (2, 2), (3, 3), (9, 4)):
        train, test = files.holdout_last(df, "k", n, ["row"])
        assert test.count() == want and train.count() == 5 - want
        assert train.where("k is null").count() == 1
    train, test = files.holdout_last(df, "k", 2)
    assert sorted(r.row for r in test.collect()) == [2, 4, 5] and train.count() == 2
    assert files.holdout_last(df.where("k < 0"), "k", 2)[0].count() == 0
    with pytest.raises(ValueError):
        files.holdout_last(df, "k", -1)


def test_white_space_at_the_ends(spark):
    df = spark.createDataFrame([("\n a b\n", "x"), ("\t", "x"), (None, "x")], "t string, c string")
    assert [r[0] for r in df.select(tx.clean(F.col("t"))).collect()] == ["a b", "", ""]
    assert [r[0] for r in df.select(tx.word_count(F.coalesce("t", F.lit("")))).collect()] == [2, 0, 0]
    assert counts.text_stats(df, "t", "c").first()["avg_words"] == pytest.approx(2 / 3)


def test_correlation_uses_complete_pairs(spark):
    r = np.random.default_rng(1)
    frame = pd.DataFrame(r.normal(size=(200, 3)) + 1e6, columns=["a", "b", "c"])
    frame["d"] = 3.0
    frame.loc[::7, "a"] = np.nan
    frame.loc[::5, "b"] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in x) for x in frame.to_numpy()]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    got = {(x.feature1, x.feature2): x.correlation for x in analysis.correlation_matrix(df, list("abcd")).collect()}
    want = frame.corr()
    for (i, j), v in got.items():
        assert np.isnan(v) if "d" in (i, j) else v == pytest.approx(want.loc[i, j], abs=1e-6)


def test_codes_and_pairs_without_a_bound(spark):
    df = spark.range(3000).select(F.concat(F.lit("v"), (F.col("id") % 1500).cast("string")).alias("v"), (F.col("id") % 2).alias("w"))
    codes = {r.v: r.code for r in counts.code_table(df, "v").collect()}
    assert codes == {v: i for i, v in enumerate(sorted(codes))} and len(codes) == 1500
    assert counts.cross_counts(df, "w", "v").agg(F.count("*"), F.sum("count")).first() == (1500, 3000)


def test_deep_slice(spark, monkeypatch):
    monkeypatch.setattr(ordering, "_TOP_ROWS", 10)
    got = ordering.slice_rows(spark.range(100), [F.desc("id")], 50, 53).collect()
    assert [r.id for r in got] == [49, 48, 47]


class Mean(Estimator):
    def _fit(self, dataset):
        return dataset.count()


def test_balancing_runs_once_for_all_parameter_sets(spark):
    runs = []
    fit = models.BalancedFit(Mean(), lambda d: runs.append(1) or d.limit(3))
    got = dict(fit.fitMultiple(spark.range(10), [{}, {}, {}]))
    assert got == {0: 3, 1: 3, 2: 3} and len(runs) == 1


def test_penalty_follows_the_rows():
    lr = models.grids(True, rows=5000)["LogisticRegression"][1]
    assert sorted(next(iter(m.values())) for m in lr) == pytest.approx([1 / 50_000, 1 / 5_000])
