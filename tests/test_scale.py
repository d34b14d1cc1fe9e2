"""Operators that must hold under skew, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from listlens.operators import balance, distribution, evaluate, ordering, selection
from listlens.sources import files

c = F.col


def skewed(spark, n=3000, seed=0):
    """A third of all rows share one value and one class holds most rows."""
    rng = np.random.default_rng(seed)
    v = np.where(rng.random(n) < 1 / 3, 7.0, np.round(rng.normal(50, 20, n), 1))
    k = np.where(rng.random(n) < 0.9, "big", "small")
    rows = [(i, str(a), float(b)) for i, (a, b) in enumerate(zip(k, v))]
    return spark.createDataFrame(rows, "id bigint, k string, v double").repartition(7), rows


def test_running_total_with_hot_value(spark):
    df, rows = skewed(spark)
    got = ordering.running_total(df, {"cum": "v"}, [F.desc("v"), F.asc("id")], totals={"all": "v"}).collect()
    want, total = {}, 0.0
    for i, _, v in sorted(rows, key=lambda r: (-r[2], r[0])):
        total += v
        want[i] = total
    assert {r["id"]: pytest.approx(r["cum"]) for r in got} == want
    assert {round(r["all"], 4) for r in got} == {round(total, 4)}


def test_running_total_by_group_with_null_group(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 1), ("a", 3, 2)], "g string, o int, n int")
    got = {(r["g"], r["o"]): r["s"] for r in ordering.running_total(df, {"s": "n"}, [c("o")], ("g",)).collect()}
    assert got == {(None, 1): 5, (None, 2): 11, ("a", 1): 1, ("a", 3): 3}


def test_quantiles_match_numpy(spark):
    df, rows = skewed(spark)
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {r["k"]: list(r)[1:] for r in distribution.exact_quantiles(df, "v", probs, ["k"]).collect()}
    for k in ("big", "small"):
        assert got[k] == pytest.approx(list(np.quantile([v for _, kk, v in rows if kk == k], probs)))


def test_histogram_keeps_all_rows_up_to_the_quantile(spark):
    df, rows = skewed(spark)
    v = np.array([r[2] for r in rows])
    kept = v[v <= np.quantile(v, 0.99)]
    want, _ = np.histogram(kept, bins=50)
    got = {r["bin"]: r["count"] for r in distribution.histogram(df, "v").collect()}
    assert sum(got.values()) == len(kept)
    assert sum(abs(got.get(i, 0) - n) for i, n in enumerate(want)) <= 4  # values on an edge may fall either way


def test_auc_matches_pairs(spark):
    df, rows = skewed(spark, 600)
    pos = np.array([v for _, k, v in rows if k == "small"])
    neg = np.array([v for _, k, v in rows if k != "small"])
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert evaluate.auc(df, "k", "v", "small").head()["auc"] == pytest.approx(want)


def test_stratified_split_is_exact_and_repeatable(spark):
    df, rows = skewed(spark)
    split = files.stratified_split(df, "k", "id", 0.2)
    got = split.collect()
    assert len(got) == len(rows)
    for k in ("big", "small"):
        n = sum(r[1] == k for r in rows)
        assert sum(r["is_test"] for r in got if r["k"] == k) == int(np.ceil(n * 0.2))
    again = {r["id"] for r in files.stratified_split(df.repartition(3), "k", "id", 0.2).where("is_test").collect()}
    assert again == {r["id"] for r in got if r["is_test"]}


def test_holdout_last(spark):
    df, _ = skewed(spark)
    train, test = files.holdout_last(df, "id", 100)
    assert sorted(r["id"] for r in test.collect()) == list(range(2900, 3000)) and train.count() == 2900


def test_large_holdout_is_counted_off(spark, monkeypatch):
    monkeypatch.setattr(files, "_TOP_KEYS", 10)
    df, _ = skewed(spark)
    train, test = files.holdout_last(df, "id", 1200)
    assert sorted(r["id"] for r in test.collect()) == list(range(1800, 3000)) and train.count() == 1800


def test_oversample_equalises(spark):
    df, rows = skewed(spark)
    sizes = {r["k"]: r["count"] for r in balance.oversample(df, "k", "id").groupBy("k").count().collect()}
    assert sizes["big"] == sizes["small"] == sum(r[1] == "big" for r in rows)


def test_expand_spreads_very_many_copies(spark, monkeypatch):
    monkeypatch.setattr(balance, "_COPIES_PER_ROW", 10)
    df = spark.createDataFrame([(1, 47), (2, 0), (3, 10)], "id int, n bigint")
    got = balance._expand(df, "n", "id", 47).select("id", "__copy").collect()
    assert sorted((r["id"], r["__copy"]) for r in got) == [(1, i) for i in range(47)] + [(3, i) for i in range(10)]


def test_even_copies_add_up(spark):
    df = spark.range(1, 18).select(c("id").alias("r"))
    for want in (0, 5, 17, 100):
        got = df.select(balance._even_copies("r", F.lit(want), F.lit(17)).alias("n")).agg(F.sum("n")).head()[0]
        assert got == want


def mixed(spark, n=400, minority=60, copies=20, seed=1):
    """Small class whose rows are to a third copies of one row."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rows.append((i, 0, float(rng.normal()), float(rng.normal()), int(rng.integers(2)), str(rng.integers(2))))
    for i in range(minority):
        at = (1.5, -0.5, 1, "1") if i < copies else (float(rng.normal(2)), float(rng.normal()), int(rng.integers(2)), str(rng.integers(2)))
        rows.append((n + i, 1, *at))
    return spark.createDataFrame(rows, "id bigint, y int, a double, b double, f int, s string"), rows


def nearest(spark, df, rows, **kw):
    small = [r for r in rows if r[1] == 1]
    return balance.nearest_in_class(
        df.where("y = 1"), "y", "id", ["a", "b"], ["f", "s"], F.lit(0.7), {1: len(small)}, 5, 42, **kw
    ), small


def distance(p, q, penalty=0.7):
    return (p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2 + penalty**2 * ((p[4] != q[4]) + (p[5] != q[5]))


@pytest.mark.parametrize("cell_rows", [4096, 40])
def test_neighbours_match_brute_force(spark, cell_rows):
    df, rows = mixed(spark)
    hits, small = nearest(spark, df, rows, cell_rows=cell_rows)
    got = {r["key"]: [(round(x["d"], 9), x["key"]) for x in r["near"]] for r in hits.collect()}
    assert len(got) == len(small)
    for p in small:
        want = sorted((round(distance(p, q), 9), q[0]) for q in small if q[0] != p[0])[:5]
        assert got[p[0]] == want


def test_a_class_beyond_one_cell_is_exact(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(5000, 3)).round(3)
    df = spark.createDataFrame([(i, 1, *map(float, v)) for i, v in enumerate(x)], "id bigint, y int, a double, b double, c double")
    hits = balance.nearest_in_class(df, "y", "id", ["a", "b", "c"], [], F.lit(1.0), {1: 5000})
    got = {h["key"]: round(h["near"][4]["d"], 9) for h in hits.select("key", "near").collect()}
    for i in range(0, 5000, 50):
        assert got[i] == round(float(np.sort(((x - x[i]) ** 2).sum(1))[5]), 9)
    assert len(got) == 5000


def clustered(n=9000, copies=2000, seed=3):
    """Rows of two classes around 30 centres; in class 1 many copies of one row."""
    r = np.random.default_rng(seed)
    centres = r.normal(scale=20, size=(30, 3))
    x = ((centres[r.integers(30, size=n)] + r.normal(size=(n, 3))) * 16).round() / 16  # sums of squares are exact, so ties are
    x[:copies] = x[0]
    return [(i, 1 if i < copies or i % 3 else 2, *map(float, v), str(int(v[0]) % 3) if i >= copies else "1") for i, v in enumerate(x)]


def test_clustered_rows_are_exact_and_visit_few_cells(spark):
    rows = clustered()
    df = spark.createDataFrame(rows, "id bigint, y int, a double, b double, c double, s string").repartition(7)
    sizes = {y: sum(r[1] == y for r in rows) for y in (1, 2)}
    args = (df, "y", "id", ["a", "b", "c"], ["s"], F.lit(0.5), sizes)
    got = {h["key"]: [(round(x["d"], 9), x["key"]) for x in h["near"]] for h in balance.nearest_in_class(*args).select("key", "near").collect()}
    assert len(got) == len(rows)
    for y in (1, 2):
        some = [r for r in rows if r[1] == y]
        x, s = np.array([r[2:5] for r in some]), np.array([r[5] for r in some])
        ids = np.array([r[0] for r in some])
        for i in range(0, len(some), 7):
            d = (((x - x[i]) ** 2).sum(1) + 0.25 * (s != s[i])).round(9)
            d[i] = np.inf
            assert got[ids[i]] == [(float(d[j]), int(ids[j])) for j in np.lexsort((ids, d))[:5]]
    _, search = balance.cell_search(*args, cell_rows=64)
    cells = {r["y"]: r["count"] for r in search.boxes[0].groupBy("y").count().collect()}
    every = sum(n * n for n in cells.values())
    assert len(search.boxes) == 3
    assert 0 < search.visitors.select("y", "a", "b").distinct().count() < search.pairs.count() < every / 2.5
    # Points are sent to a tenth of the cells at most.
    assert search.visitors.count() < 0.1 * sum(cells[r["y"]] * r["count"] for r in search.points.groupBy("y").count().collect())
    # Copies of one row are one point: they visit nothing of their own.
    assert search.points.where("y = 1").count() < sizes[1] - 1900


def test_neighbours_in_cells_are_near_and_none_is_lost(spark):
    df, rows = mixed(spark, minority=300, copies=100)
    hits, small = nearest(spark, df, rows, cell_rows=64, exact=False)
    got = {r["key"]: [x["d"] for x in r["near"]] for r in hits.collect()}
    assert len(got) == len(small) and all(len(v) == 5 for v in got.values())
    best = {p[0]: sorted(distance(p, q) for q in small if q[0] != p[0])[4] for p in small}
    assert np.mean([got[i][4] <= best[i] * 4 + 0.3 for i in got]) > 0.8


@pytest.mark.parametrize("cell_rows", [4096, 32])
def test_smote_nc_invariants(spark, cell_rows):
    df, rows = mixed(spark)
    out = balance.smote_nc(df, "y", ["a", "b"], ["f", "s"], "id", cell_rows=cell_rows).collect()
    assert sum(r["y"] == 1 for r in out) == sum(r["y"] == 0 for r in out) == 400
    old = {(r["id"], r["y"], r["a"], r["b"], r["f"], r["s"]) for r in out if not r["is_synthetic"]}
    assert old == set(rows)
    small = [r for r in rows if r[1] == 1]
    lo, hi = np.min([r[2:4] for r in small], 0), np.max([r[2:4] for r in small], 0)
    for r in out:
        if r["is_synthetic"]:
            assert r["id"] is None and r["f"] in (0, 1) and r["s"] in ("0", "1")
            assert (lo <= [r["a"], r["b"]]).all() and ([r["a"], r["b"]] <= hi).all()


def test_categoricals_take_the_neighbours_majority(spark):
    rows = [(i, 0, float(i), "p", "x") for i in range(12)]
    rows += [(100 + i, 1, i / 10, "q" if i < 5 else "p", "y") for i in range(6)]
    df = spark.createDataFrame(rows, "id bigint, y int, a double, s string, t string")
    new = balance.smote_nc(df, "y", ["a"], ["s", "t"], "id").where("is_synthetic").collect()
    # All five others are neighbours: at most one of them is 'p'.
    assert len(new) == 6 and {(r["s"], r["t"]) for r in new} == {("q", "y")}


def test_cells_in_which_nobody_asks(spark):
    df, rows = mixed(spark, minority=300)
    hits, small = nearest(spark, df, rows, cell_rows=20, wanted=F.lit(3))
    got = {r["key"]: [(round(x["d"], 9), x["key"]) for x in r["near"]] for r in hits.collect()}
    assert len(got) == 3
    for p in small:
        if p[0] in got:
            assert got[p[0]] == sorted((round(distance(p, q), 9), q[0]) for q in small if q[0] != p[0])[:5]


def test_smote_nc_is_repeatable_and_checks_input(spark):
    df, _ = mixed(spark)
    runs = [
        sorted(tuple(r) for r in balance.smote_nc(d, "y", ["a", "b"], ["f", "s"], "id").where("is_synthetic").drop("id").collect())
        for d in (df, df.repartition(5))
    ]
    assert runs[0] == runs[1]
    with pytest.raises(ValueError):
        balance.smote_nc(df.where("y = 1"), "y", ["a"], ["f"], "id")


def test_binary_columns(spark):
    df = spark.createDataFrame([(0, "a", 1, 5), (1, "b", 1, 6), (1, None, 1, 7)], "x int, s string, k int, v int")
    assert balance.binary_columns(df, ["x", "s", "k", "v"]) == ["x", "s"]


def test_broadcast_if_small_falls_back(spark):
    from listlens.session import broadcast_if_small

    df = spark.range(20)
    assert broadcast_if_small(df, 10) is df
    assert broadcast_if_small(df, 20).count() == 20


def test_top_k_limits_groups_before_the_shuffle(spark):
    df, _ = skewed(spark)
    plan = ordering.top_k_per_group(df, ["k"], [F.desc("v"), F.asc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_selection_is_exact_on_hard_values(spark, monkeypatch):
    monkeypatch.setattr(selection, "FEW_ROWS", 40)
    r = np.random.default_rng(11)
    groups = {
        "spread": r.normal(size=3000), "outlier": np.append(r.random(2000), [1e300, -1e300]), "copies": np.repeat(r.normal(size=30), 100),
        "one": np.array([4.0]), "same": np.full(900, -0.25), "powers": 10.0 ** r.uniform(-300, 300, 2000), None: np.arange(500.0),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("spread", None), ("spread", float("nan")), ("void", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.013, 0.25, 0.5, 0.99, 1.0]
    got = {x["g"]: list(x)[1:] for x in selection.quantiles(df, "v", probs, ["g"]).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx(list(np.quantile(vs, probs)), rel=1e-12)
    ends = spark.createDataFrame([(x,) for x in [float("inf")] * 60 + [float("-inf")] * 60 + [float(i) for i in range(100)]], "v double")
    assert list(selection.quantiles(ends, "v", [0.1, 0.5, 0.9]).head()) == [float("-inf"), 49.5, float("inf")]
    assert list(selection.quantiles(ends.limit(0), "v", [0.5]).head()) == [None]


def test_order_statistics_store_and_sort_nothing(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("stored")

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", refuse)
    monkeypatch.setattr(selection, "FEW_ROWS", 100)
    df = spark.range(20_000).select((c("id") * 7919 % 20_011).alias("v"), (c("id") % 3 == 0).cast("int").alias("y"))
    assert distribution.describe_numeric(df, "v").head()["q2"] == round(float(np.median([i * 7919 % 20_011 for i in range(20_000)])), 2)
    assert distribution.histogram(df, "v", 10).agg(F.sum("count")).head()[0] == 19_800
    plan = selection.quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    y, v = (np.array([r[k] for r in df.collect()]) for k in ("y", "v"))
    pos, neg = v[y == 1], np.sort(v[y == 0])
    assert evaluate.auc(df, "y", "v").head()[0] == pytest.approx(np.searchsorted(neg, pos).sum() / len(pos) / len(neg), rel=1e-12)
    numbers = df.select(c("v").cast("double").alias("v"))
    many = selection.with_range(numbers, "v", "r", selection.range_bounds(numbers, "v", 1000))
    sizes = [x["count"] for x in many.groupBy("r").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 2500
    odd = spark.createDataFrame([(None,), (float("nan"),), (1.0,), (5.0,)], "v double")
    assert [x["r"] for x in selection.with_range(odd, "v", "r", [2.0]).collect()] == [-1.0, float("inf"), 0.0, 1.0]


def test_auc_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(evaluate, "range_bounds", lambda df, column: selection.range_bounds(df, column, 300))
    r = np.random.default_rng(2)
    y, v = r.integers(2, size=4000), r.integers(700, size=4000).astype(float)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, v)], "y int, v double")
    pos, neg = v[y == 1], v[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / len(pos) / len(neg)
    assert evaluate.auc(df, "y", "v").head()[0] == pytest.approx(want, rel=1e-12)


def test_running_rank_equals_running_total_of_ones(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 11 > 0, F.col("id") * 37 % 101).alias("v"), "id", F.lit(1).cast("long").alias("A b"))
    for by in ((), ("g",)):
        order = [F.col("v"), F.col("id")]
        got = ordering.running_rank(rows, "place", order, by)
        want = ordering.running_total(rows, {"place": "A b"}, order, by)
        assert got.columns == want.columns and sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)
    odd = spark.createDataFrame([(None, 1), (None, 2), ("x", 1)], "g string, id int")
    assert sorted(r["place"] for r in ordering.running_rank(odd, "place", [F.col("id")], ("g",)).collect()) == [1, 1, 2]
    assert ordering.running_rank(odd.limit(0), "place", [F.col("id")]).count() == 0


def test_wide_rows_are_ranked_in_one_shuffle_and_stored_in_columns(spark):
    rows = spark.range(4000).select("id", (F.col("id") % 2).alias("label"), (F.col("id") * 7 % 13).cast("double").alias("x"), (F.col("id") % 4).alias("c"))
    ranked, _ = balance.cell_search(rows, "label", "id", ["x"], ["c"], F.lit(1.0), {0: 2000, 1: 2000})
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "parquet" in plan and ranked.count() == 4000
    from listlens.session import store_rows

    same = store_rows(spark.createDataFrame([(1, 2, [0.5])], "Maestro int, maestro int, `a b` array<double>"))
    assert same.columns == ["Maestro", "maestro", "a b"] and list(same.head()) == [1, 2, [0.5]]
