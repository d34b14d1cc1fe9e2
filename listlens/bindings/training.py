"""Feature analysis, balancing, training and evaluation over the driver tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Window
from pyspark.sql import functions as F

from listlens import fixed_values as fv
from listlens.bindings.registry import query
from listlens.bindings.tables import DOC_LABELS, DOC_OUTER, LISTINGS, TITLES, doc_labels, doc_outer, listings, table, title_rows
from listlens.functions import encode
from listlens.functions.text import TITLE_FEATURES
from listlens.operators import analysis as an
from listlens.operators import balance, counts, evaluate, models, ordering, sets, stored_pca
from listlens.plans.feature_selection import analyse_features
from listlens.plans.listing_features import balanced, listing_features
from listlens.plans.model_selection import select_model
from listlens.plans.stored_listings import fit_listings
from listlens.plans.title_model import fold_title_scores, hybrid_stages, read_titles, train_title_model
from listlens.session import cut_lineage, shared_folder, store_rows
from listlens.sources.files import holdout_last, load_model, save_model, stratified_split

c = F.col
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
REVENUE = "(select *, l_extendedprice * (1 - l_discount) as revenue, 1.0::double as constant from lineitem)"


def _lines(spark, d):
    return table(spark, d, "lineitem").withColumns(
        {"revenue": c("l_extendedprice") * (1 - c("l_discount")), "constant": F.lit(1.0)}
    )


# ---- feature analysis ----
def _corr_sql(columns, source: str) -> str:
    return " union all ".join(
        f"select {i}::bigint as i, {j}::bigint as j, '{a}' as feature1, '{b}' as feature2, round(corr({a}, {b}), 6) as correlation from {source}"
        for i, a in enumerate(columns) for j, b in enumerate(columns)
    )


@query("f1_correlation_matrix", _corr_sql(NUMERIC, "lineitem"))
def _(spark, d):
    return an.correlation_matrix(table(spark, d, "lineitem"), NUMERIC)


@query("f1_correlation_nulls", _corr_sql(["n_chars", "quality"], DOC_OUTER))
def _(spark, d):
    return an.correlation_matrix(doc_outer(spark, d), ["n_chars", "quality"])


@query("f2_correlated_pairs", f"select feature1, feature2, correlation from ({_corr_sql([*NUMERIC, 'revenue'], REVENUE)}) where i < j and abs(correlation) > 0.8")
def _(spark, d):
    return an.correlated_pairs(an.correlation_matrix(_lines(spark, d), [*NUMERIC, "revenue", "constant"]))


def _anova_sql(columns, label: str, source: str) -> str:
    return " union all ".join(
        f"""select '{f}' as feature, (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) as f_score from
 (select *, sum(n * m) over () / sum(n) over () as g from (select count({f})::double as n, avg({f}) as m, var_pop({f}) as v from {source} group by {label}))"""
        for f in columns
    )


@query("f4_anova_f", f"select feature, round(f_score, 6) as f_score from ({_anova_sql([*NUMERIC, 'revenue'], 'l_returnflag', REVENUE)})")
def _(spark, d):
    return an.anova_f(_lines(spark, d), [*NUMERIC, "revenue"], "l_returnflag")


SCORES = f"""(select feature, f_score, variance from ({_anova_sql([*NUMERIC, 'revenue'], 'l_returnflag', REVENUE)}) join
 (select unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'revenue']) as feature, unnest([var_samp(l_quantity), var_samp(l_extendedprice),
  var_samp(l_discount), var_samp(l_tax), var_samp(revenue)]) as variance from {REVENUE}) using (feature))"""


def _scores(spark, d):
    rows = _lines(spark, d)
    return sets.lookup_scores(an.anova_f(rows, [*NUMERIC, "revenue"], "l_returnflag"), counts.variances(rows, [*NUMERIC, "revenue"]))


@query("j2_lookup_scores", f"select feature, round(f_score, 6) as f_score, round(sqrt(variance), 4) as deviation from {SCORES}")
def _(spark, d):
    return _scores(spark, d).select("feature", "f_score", F.round(F.sqrt("variance"), 4).alias("deviation"))


COMBINED = f"""(select feature, (f_score - min(f_score) over ()) / (max(f_score) over () - min(f_score) over ()) as f_score_normalized,
 (variance - min(variance) over ()) / (max(variance) over () - min(variance) over ()) as variance_normalized from {SCORES})"""


@query("f5_combine_scores", f"""
select feature, round(f_score_normalized, 6) as f_score_normalized, round(variance_normalized, 6) as variance_normalized,
 round((f_score_normalized + variance_normalized) / 2, 6) as combined_score from {COMBINED}""")
def _(spark, d):
    return an.combine_scores(_scores(spark, d), "f_score", "variance").drop("f_score", "variance")


@query("f6_select_by_share", f"""
with s as (select feature, (f_score_normalized + variance_normalized) / 2 as score from {COMBINED}),
 r as (select feature, sum(score) over (order by score desc, feature) / sum(score) over () as share, row_number() over (order by score desc, feature) as place from s)
select feature, round(share, 6) as cumulative_importance, place::bigint as position from r
where share <= 0.95 or coalesce((select max(share) from r x where x.place = r.place - 1), 0) < 0.95""")
def _(spark, d):
    scores = an.combine_scores(_scores(spark, d), "f_score", "variance")
    return an.select_by_share(scores, 0.95).select("feature", "cumulative_importance", "position")


@query("f7_constant_features", """
select unnest(['l_quantity', 'l_tax', 'constant']) as feature, unnest([var_samp(l_quantity) > 0, var_samp(l_tax) > 0, false]) as kept from lineitem""")
def _(spark, d):
    columns = ["l_quantity", "l_tax", "constant"]
    dropped = an.constant_features(_lines(spark, d), columns)
    return counts.variances(_lines(spark, d), columns).select("feature", (~c("feature").isin(dropped)).alias("kept") if dropped else F.lit(True).alias("kept"))


@query("f8_standardise", """
select l_orderkey, round((l_quantity - avg(l_quantity) over ()) / stddev_pop(l_quantity) over (), 6) as l_quantity,
 round((l_tax - avg(l_tax) over ()) / stddev_pop(l_tax) over (), 6) as l_tax from lineitem""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_tax")
    return an.Scaler.fit(rows, ["l_quantity", "l_tax"]).apply(rows)


def _vectors(spark, d):
    """Embeddings as plain columns; vectors of another length are an error, never cut."""
    rows = table(spark, d, "embeddings")
    if (odd := rows.where(F.size("embedding") != len(VECTOR)).count()) > 0:
        raise ValueError(f"{odd} embeddings do not have {len(VECTOR)} values")
    return rows.select("vec_id", "label", *[c("embedding")[i].cast("double").alias(v) for i, v in enumerate(VECTOR)])


VECTOR = [f"v{i}" for i in range(64)]


@query("f9_explained_variance", digits=5)
def _(spark, d):
    rows = _vectors(spark, d)
    return an.explained_variance(rows, an.fit_pca(rows, VECTOR))


@query("f10_project")
def _(spark, d):
    rows = _vectors(spark, d)
    return an.apply_pca(rows, an.fit_pca(rows, VECTOR), ["vec_id", "label"])


@query("f11_components_for")
def _(spark, d):
    rows = _vectors(spark, d)
    return an.components_for(rows, an.fit_pca(rows, VECTOR))


@query("f12_top_loadings")
def _(spark, d):
    rows = _vectors(spark, d)
    return an.top_loadings(rows, an.fit_pca(rows, VECTOR))


@query("s12_stored_pca", f"""
select i::bigint as position, true as share, true as descending, true as uncorrelated, true as unit, {len(VECTOR)}::bigint as components,
 (select count(*) from embeddings)::bigint as rows from range(1, {len(VECTOR) + 1}) t(i)""")
def _(spark, d):
    # Every component is kept, stored, loaded and applied again; the checks are of the loaded model.
    rows, path = _vectors(spark, d), shared_folder(spark)
    stored_pca.save_pca(an.fit_pca(rows, VECTOR, n_components=len(VECTOR)), rows, path)
    model, ratios, facts = stored_pca.load_pca(spark, path)
    applied = model.transform(rows).agg(F.count("PC1").alias("rows"))
    checks = stored_pca.pca_checks(rows, model, ratios)
    return checks.select("*", facts.select("components").scalar().alias("components"), applied.select("rows").scalar().alias("rows"))


def _doc_features(spark, d):
    """Numeric features and 0/1 label of the labelled documents, stored: splits, folds and models read them many times, the texts once."""
    text = c("text")
    return cut_lineage(doc_labels(spark, d).select(
        "doc_id", c("n_chars").cast("double").alias("n_chars"), F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
        F.regexp_count(text, F.lit("[0-9]")).cast("double").alias("n_digits"), F.regexp_count(text, F.lit("!")).cast("double").alias("n_marks"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"), (c("lang") == "en").cast("int").alias("is_en"),
        c("toxic").cast("int").alias("toxic"), c("quality").cast("int").alias("quality"), c("quality").cast("double").alias("label"),
    ))


DOC_FEATURES = ["n_chars", "n_words", "n_digits", "n_marks", "n_lines", "is_en", "toxic"]
DOC_CONT, DOC_CAT = DOC_FEATURES[:5], DOC_FEATURES[5:]


@query("f3_rf_importance")
def _(spark, d):
    return an.rf_importance(_doc_features(spark, d), DOC_FEATURES, "label")


@query("f13_selected_dataset")
def _(spark, d):
    rows = _doc_features(spark, d)
    found = analyse_features(rows, "quality", DOC_FEATURES, pca=False)
    return found.train_selected


@query("f14_summary")
def _(spark, d):
    rows = _doc_features(spark, d)
    return analyse_features(rows, "quality", DOC_FEATURES, rows.drop("quality")).summary


# ---- balancing ----
@query("b1_smote_nc_sizes", f"""
select quality::bigint as quality, is_synthetic, rows from (
 select quality, false as is_synthetic, count(*)::bigint as rows from {DOC_LABELS} group by 1 union all
 select quality, true, (max(count(*)) over () - count(*))::bigint from {DOC_LABELS} group by 1) where rows > 0""")
def _(spark, d):
    rows = balance.smote_nc(_doc_features(spark, d), "quality", DOC_CONT, DOC_CAT, "doc_id")
    return rows.groupBy("quality", "is_synthetic").agg(F.count(F.lit(1)).alias("rows"))


@query("b1_nearest", """
select c_custkey, neighbour, round(sqrt(d), 4) as distance from (
 select a.c_custkey, b.c_custkey as neighbour,
  (a.c_acctbal - b.c_acctbal) ** 2 + case when a.c_nationkey = b.c_nationkey then 0 else 10000 end as d,
  row_number() over (partition by a.c_custkey order by d, b.c_custkey) as place
 from customer a join customer b on a.c_mktsegment = b.c_mktsegment and a.c_custkey <> b.c_custkey) where place <= 5""", 4)
def _(spark, d):
    rows = table(spark, d, "customer")
    near = balance.nearest_in_class(
        rows, "c_mktsegment", "c_custkey", ["c_acctbal"], ["c_nationkey"], F.lit(100.0), balance.class_sizes(rows, "c_mktsegment")
    )
    return near.select(c("key").alias("c_custkey"), F.explode("near").alias("x")).select("c_custkey", c("x.key").alias("neighbour"), F.sqrt("x.d").alias("distance"))


@query("b1_smote_nc", digits=4)
def _(spark, d):
    return balance.smote_nc(_doc_features(spark, d), "quality", DOC_CONT, DOC_CAT, "doc_id").where("is_synthetic").drop("doc_id")


def _flags(spark, d):
    return table(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", (c("l_discount") > 0.05).cast("int").alias("discounted"), F.lit(1).alias("constant")
    )


@query("b2_binary_columns", """
select feature from (select unnest(['l_returnflag', 'l_linestatus', 'l_quantity', 'discounted', 'constant']) as feature,
 unnest([count(distinct l_returnflag), count(distinct l_linestatus), count(distinct l_quantity), count(distinct l_discount > 0.05), 1]) as n from lineitem) where n = 2""")
def _(spark, d):
    rows = _flags(spark, d)
    binary = balance.binary_columns(rows, rows.columns)
    names = rows.agg(*[F.count(x).alias(x) for x in rows.columns])
    pairs = F.array(*[F.struct(F.lit(x).alias("feature")) for x in rows.columns])
    return names.select(F.inline(pairs)).where(c("feature").isin(binary))


@query("b3_oversample", f"select quality::bigint as quality, (select max(n) from (select count(*) as n from {DOC_LABELS} group by quality))::bigint as rows from {DOC_LABELS} group by quality")
def _(spark, d):
    rows = balance.oversample(doc_labels(spark, d).select("doc_id", "quality"), "quality", "doc_id")
    return rows.groupBy("quality").agg(F.count(F.lit(1)).alias("rows"))


# ---- evaluation ----
RULE = f"(select *, case when n_chars > 800 then 1 else 0 end as pred from {DOC_LABELS})"


def _rule(spark, d):
    return doc_labels(spark, d).select("doc_id", "quality", "n_chars", (c("n_chars") > 800).cast("int").alias("pred"))


@query("m2_class_weights", f"""
select quality::bigint as label, round((select count(*) from {DOC_LABELS})::double / ((select count(distinct quality) from {DOC_LABELS}) * count(*)), 6) as weight
from {DOC_LABELS} group by quality""")
def _(spark, d):
    return models.class_weights(doc_labels(spark, d).select(c("quality").alias("label")), "label")


@query("m9_folds", f"""
select condition, fold, count(*)::bigint as rows, min(doc_id)::bigint as first_id, max(doc_id)::bigint as last_id from (
 select condition, doc_id, ((row_number() over (partition by condition order by ('0x' || substr(md5(cast(doc_id as varchar)), 1, 15))::bigint, doc_id) - 1) % 3)::bigint as fold
 from {DOC_LABELS}) group by 1, 2""")
def _(spark, d):
    draw = F.conv(F.substring(F.md5(c("doc_id").cast("string")), 1, 15), 16, 10).cast("bigint")
    rows = models.stratified_folds(doc_labels(spark, d).select("doc_id", "condition"), "condition", "doc_id", draw=draw)
    return rows.groupBy("condition", "fold").agg(
        F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )


@query("m11_accuracy_recall", f"""
with k as (select quality, avg((pred = quality)::int) as r, count(*) as n from {RULE} group by 1)
select round((select avg((pred = quality)::int) from {RULE}), 6) as accuracy, round(sum(r * n) / sum(n), 6) as weighted_recall,
 round(avg(r), 6) as macro_recall, sum(n)::bigint as rows from k""")
def _(spark, d):
    return evaluate.accuracy_recall(_rule(spark, d), "quality", "pred")


def _auc_sql(score: str, source: str, label: str) -> str:
    return f"""select round(sum(pos * (below + 0.5::double * neg)) / (sum(pos) * sum(neg)), 6) as auc from (
 select pos::double as pos, neg::double as neg, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0)::double as below from (
  select {score} as s, count_if({label}) as pos, count_if(not ({label})) as neg from {source} group by 1))"""


@query("m12_auc", _auc_sql("n_chars % 97", DOC_LABELS, "quality = 1"))
def _(spark, d):
    return evaluate.auc(doc_labels(spark, d).withColumn("s", c("n_chars") % 97), "quality", "s")


@query("m12_auc_lines", _auc_sql("l_extendedprice", "lineitem", "l_linestatus = 'O'"))
def _(spark, d):
    return evaluate.auc(table(spark, d, "lineitem"), "l_linestatus", "l_extendedprice", "O")


REPORT_CLASSES = f"""(select k.label::varchar as class, coalesce(hits::double / nullif(called, 0), 0) as precision, coalesce(hits::double / nullif(support, 0), 0) as recall, support from
 (select quality as label, count(*) as support, count_if(pred = quality) as hits from {RULE} group by 1) k left join
 (select pred as label, count(*) as called from {RULE} group by 1) p on k.label = p.label)"""


@query("m13_class_report", f"""
with r as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1 from {REPORT_CLASSES})
select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support::bigint as support from (
 select class, precision, recall, f1, support from r union all
 select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from r union all
 select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) from r)""")
def _(spark, d):
    return evaluate.class_report(_rule(spark, d), "quality", "pred")


# Rules over the labelled documents standing in for trained models, measured on the tables.
RULES = {
    "RandomForest": "n_chars > 500", "GradientBoosting": "lang = 'en'", "XGBoost": "n_chars > 2000",
    "LogisticRegression": "toxic = 0", "MLP": "lang = 'de' or n_chars > 1000", "Baseline": "doc_id >= 0",
}
RULE_METRICS = "(" + " union all ".join(
    f"""select '{n}' as model, avg((({r}) = (quality = 1))::int) filter (lang = 'en') as cv_score,
 avg((({r}) = (quality = 1))::int) filter (lang <> 'en') as test_accuracy, avg(n_chars) filter ({r}) as training_seconds from {DOC_LABELS}"""
    for n, r in RULES.items()
) + ")"


def _rule_metrics(spark, d):
    hits = F.array(*[
        F.struct(F.lit(n).alias("model"), F.expr(r).alias("pred")) for n, r in RULES.items()
    ])
    long = doc_labels(spark, d).select("lang", "n_chars", "quality", F.inline(hits))
    hit = (c("pred") == (c("quality") == 1)).cast("int")
    return long.groupBy("model").agg(
        F.avg(F.when(c("lang") == "en", hit)).alias("cv_score"), F.avg(F.when(c("lang") != "en", hit)).alias("test_accuracy"),
        F.avg(F.when(c("pred"), c("n_chars"))).alias("training_seconds"),
    )


@query("m17_compare", f"""
with m as (select *, cv_score - test_accuracy as gap, case when model in ('RandomForest', 'GradientBoosting', 'XGBoost') then 'tree'
  when model in ('LogisticRegression', 'MLP') then 'linear' end as family from {RULE_METRICS})
select model, round(cv_score, 6) as cv_score, round(test_accuracy, 6) as test_accuracy, round(training_seconds, 6) as training_seconds, round(gap, 6) as gap, family,
 row_number() over (order by test_accuracy desc, model)::bigint as accuracy_place, row_number() over (order by test_accuracy desc, model) = 1 as is_best,
 row_number() over (order by test_accuracy desc, model) <= 3 as in_top3, row_number() over (order by training_seconds, model) = 1 as is_fastest,
 family is not null and row_number() over (partition by family order by test_accuracy desc, model) = 1 as is_family_best,
 family is not null and row_number() over (partition by family order by training_seconds, model) = 1 as is_family_fastest,
 case when gap > 0.05 then 'over-fit' when gap < -0.02 then 'under-fit' else 'ok' end as fit_flag from m""")
def _(spark, d):
    return evaluate.compare(_rule_metrics(spark, d))


@query("m14_m15_rank_and_best", f"""
select model, round(test_accuracy, 6) as test_accuracy, round(cv_score - test_accuracy, 6) as gap,
 row_number() over (order by test_accuracy desc, cv_score desc, model)::bigint as place, row_number() over (order by cv_score desc, model) = 1 as is_best from {RULE_METRICS}""")
def _(spark, d):
    # A row per rule, as searches would give them; the CV score stands in for the recall.
    found = [
        models.SearchResult(r["model"], None, r["cv_score"], {}, [], 0.0, 1, r["test_accuracy"], r["cv_score"])
        for r in _rule_metrics(spark, d).orderBy("model").collect()
    ]
    best = models.best_model(found).name
    place = F.row_number().over(Window.orderBy(F.desc("test_accuracy"), F.desc("test_recall"), F.desc("test_macro_recall"), "model"))
    ranked = models.metrics_table(spark, found)
    return ranked.select("model", "test_accuracy", "gap", place.alias("place"), (c("model") == best).alias("is_best"))


INJECTED = """(select l_orderkey, case when l_linenumber = 1 then 'nan'::double when l_linenumber = 2 then 'infinity'::double
 when l_linenumber = 3 then '-infinity'::double when l_linenumber = 4 then null else l_quantity end as v, l_tax as w from lineitem)"""


def _injected(spark, d):
    n = c("l_linenumber")
    v = (
        F.when(n == 1, F.lit(float("nan"))).when(n == 2, F.lit(float("inf"))).when(n == 3, F.lit(float("-inf")))
        .when(n == 4, F.try_divide(c("l_quantity"), F.lit(0.0))).otherwise(c("l_quantity"))
    )
    return table(spark, d, "lineitem").select("l_orderkey", v.alias("v"), c("l_tax").alias("w"))


@query("m19_finite", f"select l_orderkey, w, case when v is null or isnan(v) then 0 when isinf(v) then sign(v) * 1e6 else v end as v from {INJECTED}")
def _(spark, d):
    return encode.finite(_injected(spark, d), ["v", "w"])


@query("m20_count_nonfinite", f"""
select 'v' as feature, count_if(isnan(v))::bigint as nan, count_if(isinf(v))::bigint as inf from {INJECTED} union all
select 'w', count_if(isnan(w))::bigint, count_if(isinf(w))::bigint from {INJECTED}""")
def _(spark, d):
    return encode.count_nonfinite(_injected(spark, d), ["v", "w"])


@query("m22_active_features", f"""
select l_orderkey, array_to_string(list_filter([case when len(title) > 0 then 'longitud' end, case when contains(title, 'oferta') then 'oferta' end,
  case when contains(title, '$') then 'precio' end], lambda x: x is not null), ',') as active,
 array_to_string(list_filter([case when contains(title, 'ring') then 'anillo' end, case when contains(title, 'bolt') then 'tornillo' end], lambda x: x is not null), ',') as categories
from {TITLES}""")
def _(spark, d):
    t = c("title")
    rows = title_rows(spark, d).select(
        "l_orderkey", F.length(t).alias("longitud"), t.contains("oferta").cast("int").alias("oferta"), t.contains("$").cast("int").alias("precio"),
        t.contains("ring").cast("int").alias("es_anillo"), t.contains("bolt").cast("int").alias("es_tornillo"), t.contains("ring").cast("int").alias("count_anillo"),
    )
    out = evaluate.active_features(rows, ["longitud", "oferta", "precio", "es_anillo", "es_tornillo", "count_anillo"])
    return out.select("l_orderkey", F.array_join("active", ",").alias("active"), F.array_join("categories", ",").alias("categories"))


# ---- training ----
def _split(spark, d):
    rows = stratified_split(_doc_features(spark, d), "quality", "doc_id", 0.2)
    return rows.where("not is_test"), rows.where("is_test")


def _vectorised(rows):
    return an.assemble(rows, DOC_FEATURES).select("doc_id", "label", "quality", "features")


@query("m1_to_m4_candidates")
def _(spark, d):
    train, test = _split(spark, d)
    rows = models.with_class_weights(_vectorised(train), "label")
    candidates = models.title_models(len(DOC_FEATURES), rows.count())
    found = models.train_candidates(rows, _vectorised(test), candidates)
    return found.metrics.select("model", (c("accuracy") >= 0).alias("scored"), (c("model") == found.name).alias("chosen"))


def _small_grids():
    rf = RandomForestClassifier(labelCol="label", seed=42)
    lr = LogisticRegression(labelCol="label", maxIter=50)
    return {
        "RandomForest": (rf, ParamGridBuilder().addGrid(rf.numTrees, [10]).addGrid(rf.maxDepth, [3, 5]).build()),
        "LogisticRegression": (
            Pipeline(stages=models._scaled(lr)), ParamGridBuilder().addGrid(lr.regParam, [0.001, 0.01]).build()
        ),
    }


@query("m6_to_m8_boosting")
def _(spark, d):
    rows = _vectorised(_doc_features(spark, d))
    folded = models.stratified_folds(rows, "quality", "doc_id").select("label", "features", "fold")
    gbt = GBTClassifier(labelCol="label", seed=42)
    grid = ParamGridBuilder().addGrid(gbt.maxIter, [5]).addGrid(gbt.maxDepth, [2]).addGrid(gbt.stepSize, [0.1, 0.2]).build()
    return models.top_configs(spark, models.grid_search(folded, gbt, grid, name="GradientBoosting"))


@query("m9_m16_grid_search")
def _(spark, d):
    rows = _vectorised(_doc_features(spark, d))
    folded = models.stratified_folds(rows, "quality", "doc_id").select("label", "features", "fold")
    est, grid = _small_grids()["RandomForest"]
    return models.top_configs(spark, models.grid_search(folded, est, grid, name="RandomForest"))


@query("m24_select_model")
def _(spark, d):
    train, test = _split(spark, d)
    found = select_model(train.drop("is_test"), test.drop("is_test"), DOC_FEATURES, "label", "doc_id", grids=_small_grids())
    return found.comparison.drop("trained_at", "training_seconds", "is_fastest", "is_family_fastest")


@query("m18_score_titles")
def _(spark, d):
    # Training and scoring take the same read of the texts.
    rows = read_titles(doc_labels(spark, d).select(c("doc_id").alias("id"), c("text").alias("title"), "condition"))
    found = train_title_model(rows)
    scored = models.score(rows.select("id", "title"), found.model)
    return scored.select("id", "categoria_predicha", "probabilidad_new", "probabilidad_used")


@query("m21_importances")
def _(spark, d):
    rows = _vectorised(_doc_features(spark, d))
    model = RandomForestClassifier(labelCol="label", numTrees=100, seed=42).fit(rows)
    return models.importances(spark, model, DOC_FEATURES)


@query("m23_train_title_model")
def _(spark, d):
    rows = doc_labels(spark, d).select(c("doc_id").alias("id"), c("text").alias("title"), "condition")
    found = train_title_model(rows)
    return found.metrics.select("model", "accuracy", "recall", "auc")


@query("t14_hybrid_matrix")
def _(spark, d):
    rows = doc_labels(spark, d).select("doc_id", c("text").alias("title"))
    model = Pipeline(stages=hybrid_stages("title", 500)).fit(rows)
    values = vector_to_array("features")
    return model.transform(rows).select(
        "doc_id", F.size(values).alias("width"), F.aggregate(values, F.lit(0.0), lambda s, v: s + v).alias("total")
    )


@query("e9_title_scores")
def _(spark, d):
    rows = doc_labels(spark, d).select("doc_id", c("text").alias("title"), "condition")
    labelled = rows.withColumn("label", encode.label_code(c("condition"), fv.LABEL_CODES).cast("double"))
    # The texts are read once for all folds.
    folded = read_titles(models.stratified_folds(labelled, "condition", "doc_id"), store=store_rows)

    def fit(part):
        text = Pipeline(stages=hybrid_stages("title")).fit(part)
        width = len(text.stages[0].getOrDefault("vocabulary")) + len(TITLE_FEATURES)
        vectors = text.transform(models.with_class_weights(part, "label")).select("label", "weight", "features")
        with models.held(vectors) as rows:
            linear = models.title_models(width, rows.count())["LogisticRegression"].fit(rows)
        return PipelineModel(stages=[*text.stages, *linear.stages])

    scored = models.out_of_fold_scores(folded, fit, "fold", 3)
    return scored.select("doc_id", "probabilidad_new", "probabilidad_used")


@query("e9_fold_scores", f"""
select doc_id, ((row_number() over (partition by condition order by ('0x' || substr(md5(cast(doc_id as varchar)), 1, 15))::bigint, doc_id) - 1) % 3)::bigint as fold,
 1.0::double as total, true as inside from {DOC_LABELS}""")
def _(spark, d):
    draw = F.conv(F.substring(F.md5(c("doc_id").cast("string")), 1, 15), 16, 10).cast("bigint")
    rows = doc_labels(spark, d).select("doc_id", c("text").alias("title"), "condition")
    labelled = rows.withColumn("label", encode.label_code(c("condition"), fv.LABEL_CODES).cast("double"))
    scored = fold_title_scores(models.stratified_folds(labelled, "condition", "doc_id", draw=draw))
    new, used = c("probabilidad_new"), c("probabilidad_used")
    return scored.select("doc_id", "fold", (new + used).alias("total"), (new.between(0, 1) & used.between(0, 1)).alias("inside"))


LATE = f"(select *, rank() over (order by l_orderkey desc, l_linenumber desc) <= 1000 as late from {LISTINGS})"


@query("e10_e11_stored_pipeline", f"""
with n as (select late, case condition when 'new' then 0 else 1 end as condition, count(*) as rows from {LATE} group by 1, 2)
select 'training' as part, condition::bigint as condition, (select max(rows) from n where not late)::bigint as rows,
 ((select max(rows) from n where not late) - rows)::bigint as synthetic, (select max(rows) from n where not late)::bigint as scored, true as same_columns from n where not late
union all select 'test', null, sum(rows)::bigint, 0::bigint, sum(rows)::bigint, true from n where late""")
def _(spark, d):
    # The last rows are held out; the fitted transform is stored and loaded before it meets them.
    train, test = holdout_last(listings(spark, d), "l_orderkey", 1000, ["l_linenumber"])
    lines = table(spark, d, "lineitem").columns
    fitted = fit_listings(train.withColumn("id", F.xxhash64(*lines)), "id")
    path = shared_folder(spark)
    save_model(fitted.model, path)
    held = load_model(path).transform(test)
    same = [x for x in fitted.table.columns if x not in ("id", "condition", "is_synthetic")] == held.columns
    new, used = c("probabilidad_new"), c("probabilidad_used")
    # Synthetic rows lie between their neighbours, so their scores stay inside, too.
    scored = F.count_if(new.between(0, 1) & used.between(0, 1) & (F.abs(new + used - 1) < 1e-6)).alias("scored")
    both = (F.lit(same)).alias("same_columns")
    mine = fitted.table.groupBy("condition").agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_synthetic").alias("synthetic"), scored)
    theirs = held.agg(F.count(F.lit(1)).alias("rows"), scored)
    return mine.select(F.lit("training").alias("part"), c("condition").cast("bigint").alias("condition"), "rows", "synthetic", "scored", both).unionByName(
        theirs.select(
            F.lit("test").alias("part"), F.lit(None).cast("bigint").alias("condition"), "rows", F.lit(0).cast("bigint").alias("synthetic"), "scored", both
        )
    )


@query("e10_balanced_training", f"""
select condition::bigint as condition, rows from (
 select case condition when 'new' then 0 else 1 end as condition, (select max(n) from (select count(*) as n from {LISTINGS} group by condition))::bigint as rows from {LISTINGS} group by 1)""")
def _(spark, d):
    # A row number is no part of the record: rows get a key from their content.
    rows = listings(spark, d)
    lines = table(spark, d, "lineitem").columns
    keyed = rows.withColumn("id", F.xxhash64(*lines))
    return balanced(listing_features(keyed, "training", keep=["id"]).drop("title"), "id").groupBy("condition").agg(
        F.count(F.lit(1)).alias("rows")
    )
