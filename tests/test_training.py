"""Readers and writers, analysis, training and the composed plans."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from listlens import fixed_values as fv
from listlens.operators import analysis as an
from listlens.operators import evaluate, models, tfidf
from listlens.plans.feature_selection import analyse_features
from listlens.plans.warranty import classify_warranty, with_warranty_flags
from listlens.plans.listing_features import balanced, listing_features, test_features as features_for_test, training_features
from listlens.plans.model_selection import select_model
from listlens.plans.title_model import demo_scores, hybrid_stages, score_titles, train_title_model
from listlens.plans.title_report import title_report, title_sections
from listlens.sources import files

c = F.col


def listing(i, **kw):
    row = {
        "id": str(i), "title": f"Kit nuevo {1990 + i % 30} original" if i % 3 else f"Libro usado {1950 + i % 40} antiguo",
        "condition": "new" if i % 3 else "used", "price": 10.0 + i, "base_price": 10.0 + i, "initial_quantity": i % 5,
        "available_quantity": 1, "sold_quantity": i % 4, "listing_type_id": ["bronze", "gold", "odd", None][i % 4],
        "buying_mode": "auction" if i % 2 else "buy_it_now", "warranty": None, "warranty_category": ["Sin garantía", None][i % 2],
        "official_store_id": i if i % 5 == 0 else None, "automatic_relist": i % 2 == 0, "tags": [["free_relist"], [], None][i % 3],
        "sub_status": [], "deal_ids": [], "attributes": [],
        "shipping": {"local_pick_up": i % 2 == 0, "free_shipping": i % 4 == 0, "mode": "me1", "methods": [], "tags": [], "dimensions": None},
        "non_mercado_pago_payment_methods": [{"id": "1", "description": "Visa", "type": "C"}] if i % 2 else [],
        "variations": [{"available_quantity": 4, "price": 1.0}, {"available_quantity": None, "price": 2.0}] if i % 4 == 0 else [],
        "seller_address": {"state": {"name": ["Mendoza", "Salta", None][i % 3]}},
    }
    row.update(kw)
    return row


@pytest.fixture(scope="module")
def listings(spark):
    return spark.createDataFrame([listing(i) for i in range(90)], files.LISTING_SCHEMA).repartition(3).cache()


def test_json_lines_csv_parquet_round_trip(spark, listings, tmp_path):
    listings.write.json(str(tmp_path / "j"))
    back = files.read_json_lines(spark, str(tmp_path / "j"))
    assert back.schema == files.LISTING_SCHEMA and back.where("shipping.mode = 'me1'").count() == 90
    odd = spark.createDataFrame([(1, 'a "q", b\nnext'), (2, None)], "n int, t string")
    files.write_csv(odd, str(tmp_path / "c"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "c"), "n int, t string").collect())) == [(1, 'a "q", b\nnext'), (2, None)]
    assert dict(files.read_csv(spark, str(tmp_path / "c")).dtypes)["n"] == "int"
    files.write_parquet(listings, str(tmp_path / "p"))
    assert files.read_parquet(spark, str(tmp_path / "p")).count() == 90
    files.write_report({"a": odd}, str(tmp_path / "r"))
    files.write_results(odd, str(tmp_path / "m"))
    assert "run_at" in spark.read.json(str(tmp_path / "m")).columns


def test_guards(spark, listings):
    with pytest.raises(ValueError, match="missing required columns"):
        files.require_columns(listings, ["absent"])
    with pytest.raises(ValueError):
        files.require_rows(listings.limit(0))
    with pytest.raises(ValueError):
        listing_features(listings, "other")
    assert files.load_train_test(listings, None, "condition", fv.LABEL_CODES)[1] is None


def test_training_and_test_features_agree(spark, listings):
    train = listing_features(listings, " Training", keep=["id"])
    test = features_for_test(listings.drop("condition"), keep=["id"])
    assert [x for x in train.columns if x not in ("condition", "title")] == test.columns
    r = {x["id"]: x for x in train.collect()}
    assert r["0"]["condition"] == 1 and r["1"]["condition"] == 0
    assert r["0"]["items_variation"] == 2 and r["0"]["available_quantity_variation"] == 2.0 and r["1"]["items_variation"] == 0
    assert r["1"]["Visa"] == 1 and r["0"]["Visa"] == 0 and r["0"]["free_relist"] == 1
    assert r["1"]["sin_tag"] == 1 and r["2"]["sin_tag"] == 1 and r["0"]["sin_tag"] == 0
    assert r["0"]["sin_garantia"] == 1 and r["1"]["garantia_especifica"] == 1
    assert r["0"]["state_grouped_Mendoza"] == 1 and r["1"]["state_grouped_Otros"] == 1 and r["2"]["state_grouped_Otros"] == 1
    assert "state_grouped_Buenos Aires" not in train.columns
    assert r["0"]["bronze"] == 1 and r["2"]["bronze"] == 0 and r["0"]["me1"] == 1


def test_nested_text_columns_give_the_same_features(spark, listings):
    as_text = listings.withColumns({
        k: F.to_json(k) for k in ("shipping", "non_mercado_pago_payment_methods", "variations", "seller_address")
    })
    a, b = listing_features(listings, keep=["id"]), listing_features(as_text, keep=["id"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_features_are_one_narrow_stage(spark, listings):
    plan = listing_features(listings)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryTableScan")[0] and "Python" not in plan


def test_training_features_never_score_a_row_with_its_own_model(spark, listings):
    seen = []

    def fit(part):
        seen.append({r["id"] for r in part.select("id").collect()})
        return Pipeline(stages=[*hybrid_stages("title", 20), *models._scaled(LogisticRegression(labelCol="label", maxIter=5))]).fit(part)

    table = training_features(listings, "id", fit, balance=False)
    got = table.collect()
    assert len(got) == 90 and all(abs(r["probabilidad_new"] + r["probabilidad_used"] - 1) < 1e-9 for r in got)
    everyone = {str(i) for i in range(90)}
    held = [everyone - s for s in seen]
    assert set().union(*held) == everyone and sum(map(len, held)) == 90


def test_title_failure_is_raised(spark, listings):
    def broken(part):
        raise RuntimeError("no model")

    with pytest.raises(RuntimeError):
        training_features(listings, "id", broken)


def test_balanced_training_table(spark, listings):
    out = balanced(listing_features(listings, keep=["id"]).drop("title"), "id")
    sizes = {(r["condition"], r["is_synthetic"]): r["count"] for r in out.groupBy("condition", "is_synthetic").count().collect()}
    assert sizes == {(0, False): 60, (1, False): 30, (1, True): 30}
    binary = out.agg(*[F.count_if(~c(x).isin(0, 1)).alias(x) for x in ("Visa", "free_relist", "sin_tag", "bronze")]).head()
    assert list(binary) == [0, 0, 0, 0]


def test_tfidf_by_hand(spark):
    rows = spark.createDataFrame([(0, "rojo rojo azul"), (1, "rojo verde"), (2, "negro negro"), (3, "azul")], "i int, t string")
    terms = {r["term"]: (r["tf"], r["df"]) for r in tfidf.term_table(rows, "t").collect()}
    assert terms["rojo"] == (3, 2) and terms["rojo rojo azul"] == (1, 1) and terms["negro negro"] == (1, 1)
    model = tfidf.TextTfidf(inputCol="t", minDF=2, maxDF=0.95).fit(rows)
    assert model.getOrDefault("vocabulary") == ["azul", "rojo"]
    got = [list(r["v"]) for r in model.transform(rows).orderBy("i").select(vector_to_array("tfidf").alias("v")).collect()]
    idf = math.log(5 / 3) + 1
    raw = np.array([idf, (1 + math.log(2)) * idf])
    assert got[0] == pytest.approx(list(raw / np.linalg.norm(raw))) and got[1] == pytest.approx([0, 1]) and got[2] == [0, 0]


def test_title_model_end_to_end(spark, listings, tmp_path):
    found = train_title_model(listings, names=["LogisticRegression", "RandomForest"], max_features=30)
    assert found.name in ("LogisticRegression", "RandomForest") and not found.failures
    assert found.metrics.count() == 2 and found.metrics.agg(F.max("auc")).head()[0] > 0.95
    files.save_model(found.model, str(tmp_path / "m"))
    again = files.load_model(str(tmp_path / "m"))
    a = score_titles(listings.select("id", "title"), found.model).orderBy("id").collect()
    b = score_titles(listings.select("id", "title"), again).orderBy("id").collect()
    assert a == b and {r["categoria_predicha"] for r in a} == {"new", "used"}
    assert demo_scores(spark, again).count() == 5


def test_failed_candidate_does_not_stop_the_others(spark):
    rows = spark.createDataFrame([(float(i % 2), [float(i % 2), float(i)]) for i in range(40)], "label double, v array<double>")
    from pyspark.ml.functions import array_to_vector

    rows = rows.select("label", array_to_vector("v").alias("features"))
    found = models.train_candidates(rows, rows, {
        "bad": Pipeline(stages=[LogisticRegression(labelCol="absent")]),
        "ok": Pipeline(stages=[LogisticRegression(labelCol="label", maxIter=5)]),
    })
    assert found.name == "ok" and "bad" in found.failures


def numbers(spark, n=200):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, n)
    rows = [
        (i, float(k + rng.normal(0, 0.5)), float(rng.normal()), float(5 * k + rng.normal()), 1.0, int(k)) for i, k in enumerate(y)
    ]
    return spark.createDataFrame(rows, "id bigint, a double, b double, d double, k double, y int").cache(), rows


def test_scaler_and_pca(spark):
    df, rows = numbers(spark)
    s = an.Scaler.fit(df, ["a", "k"])
    r = s.apply(df).agg(F.avg("a"), F.stddev_pop("a"), F.max("k")).head()
    assert r[0] == pytest.approx(0, abs=1e-9) and r[1] == pytest.approx(1) and r[2] == 0
    state = an.fit_pca(df, ["a", "b", "d", "k"], 0.95)
    assert state.dropped == ("k",) and sum(state.ratios) == pytest.approx(1)
    x = np.array([r[1:4] for r in rows])
    want = np.linalg.eigvalsh(np.corrcoef(x.T))[::-1] / 3
    assert list(state.ratios) == pytest.approx(list(want))
    pcs = np.array([list(r) for r in an.apply_pca(df, an.fit_pca(df, ["a", "b", "d"], 0.999)).collect()])
    assert pcs.mean(0) == pytest.approx(np.zeros(pcs.shape[1]), abs=1e-9)
    assert abs(np.corrcoef(pcs.T) - np.eye(pcs.shape[1])).max() < 1e-6


def test_selection_is_monotone_and_keeps_one(spark):
    scores = spark.createDataFrame([("a", 0.99), ("b", 0.006), ("c", 0.004), ("d", 0.0)], "feature string, combined_score double")
    sizes = [an.select_by_share(scores, t).count() for t in (0.1, 0.5, 0.95, 0.995, 1.0)]
    assert sizes == sorted(sizes) and sizes[0] == 1 and sizes[-1] >= 3


def test_analysis_plan(spark, tmp_path):
    df, _ = numbers(spark)
    out = analyse_features(df.drop("id"), "y", test=df.drop("id", "y"), threshold=0.5, output=str(tmp_path), trees=10)
    assert [(r["feature1"], r["feature2"]) for r in out.correlated.collect()] == [("a", "d")]
    assert out.selected[0] == "d" and out.summary.head()["original_features"] == 4
    assert spark.read.parquet(str(tmp_path / "test_pca")).count() == 200
    assert [r["feature"] for r in an.redundant_features(out.correlated).collect()] == ["d"]


def test_grid_search_balances_only_training_parts(spark):
    df, _ = numbers(spark)
    sizes = []

    def balance(rows):
        sizes.append(rows.count())
        return rows

    train, test = df.where("id < 150"), df.where("id >= 150")
    lr = LogisticRegression(labelCol="label", maxIter=10)
    rf = RandomForestClassifier(labelCol="label", numTrees=5, seed=1)
    spec = {
        "LogisticRegression": (lr, ParamGridBuilder().addGrid(lr.regParam, [0.01, 10.0]).build()),
        "RandomForest": (rf, ParamGridBuilder().addGrid(rf.maxDepth, [2]).build()),
    }
    found = select_model(train, test, ["a", "b", "d"], "y", "id", grids=spec, balance=balance)
    assert max(sizes) == 150 and min(sizes) < 150 and len(sizes) == 3 + 1 + 3 + 1
    assert found.metrics.count() == 2 and found.best.cv_score > 0.9
    assert [r.fits for r in found.results] == [6, 3]
    assert models.top_configs(spark, found.results[0]).count() == 2
    assert found.comparison.where("is_best").count() == 1


def test_grids_have_the_stated_sizes(spark):
    assert {k: models.fits(g) for k, (_, g) in models.grids(False).items()} == {"RandomForest": 72, "GradientBoosting": 72, "LightGBM": 1296}
    assert {k: models.fits(g) for k, (_, g) in models.grids(True).items()} == {
        "RandomForest": 6, "LogisticRegression": 6, "GradientBoosting": 24, "LightGBM": 48, "XGBoost": 3,
    }


def test_class_report_and_recall(spark):
    df = spark.createDataFrame([(0, 0)] * 8 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] * 7, "y int, p int")
    r = evaluate.accuracy_recall(df, "y", "p").head()
    assert r["accuracy"] == pytest.approx(0.55) == r["weighted_recall"] and r["macro_recall"] == pytest.approx(0.55)
    rep = {x["class"]: x for x in evaluate.class_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == pytest.approx(0.6) and rep["1"]["recall"] == pytest.approx(0.3) and rep["macro avg"]["support"] == 20


def test_report_sections(spark, listings):
    assert set(title_sections(listings)) == {
        "basic_stats", "top_words", "distinctive_words", "numeric_patterns", "years", "top_years",
        "brand_candidates", "brand_distribution", "category_stats", "special_patterns",
    }
    rows = title_report(listings).collect()
    assert {(r["name"], r["class"]): r["value"] for r in rows if r["section"] == "basic_stats"}[("count", "new")] == 60
    assert any(r["section"] == "regex_patterns" for r in rows)


def test_warranty_text_to_flags(spark, listings):
    texts = [(1, "6 meses de garantía"), (2, None), (3, " \t"), (4, "Sin garantia"), (5, "reputacion del vendedor"), (6, "???")]
    df = spark.createDataFrame(texts, "id int, warranty string")
    got = {r["id"]: (r["warranty"], r["warranty_category"], r["sin_garantia"], r["garantia_especifica"]) for r in with_warranty_flags(df).collect()}
    none, time, seller = fv.WARRANTY_LABELS[8], fv.WARRANTY_LABELS[2], fv.WARRANTY_LABELS[5]
    assert got == {
        1: ("6 meses de garantía", time, 0, 1), 2: ("", none, 1, 0), 3: (" \t", none, 1, 0), 4: ("Sin garantia", none, 1, 0),
        5: ("reputacion del vendedor", seller, 1, 0), 6: ("???", none, 1, 0),
    }
    asked = classify_warranty(df, scorer=lambda batch: [time if "garant" in t else "made up" for t in batch])
    assert {r["id"]: r["warranty_category"] for r in asked.collect()} == {1: time, 2: none, 3: none, 4: time, 5: none, 6: none}
    raw = listings.limit(5).withColumn("warranty", F.lit("12 meses")).drop("warranty_category")
    assert {(r["sin_garantia"], r["garantia_especifica"]) for r in listing_features(raw, "test").collect()} == {(0, 1)}
