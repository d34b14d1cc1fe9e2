"""Nested, encoding and text expressions on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from listlens import fixed_values as fv
from listlens.functions import encode, nested
from listlens.functions import text as tx
from listlens.functions.scoring import score_text
from listlens.operators import text_profile as tp
from listlens.operators.nested_profile import element_class_counts, key_population

c = F.col


def one(df, column=0):
    return [r[column] for r in df.collect()]


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").orderBy("i")


def test_parse_nested_accepts_json_python_and_garbage(spark):
    rows = texts(
        spark, '{"mode": "me1", "free": true}', "{'mode': 'None of it', 'free': True, 'x': None}", "garbage", None,
        "{'mode': \"it's\", 'free': False}",
    )
    got = rows.select(nested.parse_nested(c("t"), "struct<mode:string,free:boolean>").alias("p")).select("p.mode", "p.free").collect()
    assert [tuple(r) for r in got] == [("me1", True), ("None of it", True), (None, None), (None, None), ("it's", False)]


def test_variation_mean_counts_missing_field_as_zero(spark):
    rows = texts(spark, "[{'available_quantity': 3}, {'price': 2.0}]", "[]", "bad", None)
    v = nested.parse_nested(c("t"), "array<struct<available_quantity:bigint,price:double>>")
    got = rows.select(v.alias("v")).select(nested.size_or_zero(c("v")), nested.mean_of_field(c("v"), "available_quantity")).collect()
    assert [tuple(r) for r in got] == [(2, 1.5), (0, 0.0), (0, 0.0), (0, 0.0)]


def test_tags_unknown_only_is_all_zero_without_flag(spark):
    rows = spark.createDataFrame([(["odd"],), ([],), (None,), (["free_relist", "odd"],)], "t array<string>")
    got = rows.select(*nested.multi_hot(c("t"), ["free_relist"]).values(), nested.no_elements(c("t"))).collect()
    assert [tuple(r) for r in got] == [(0, 0), (0, 1), (0, 1), (1, 0)]


def test_encodings(spark):
    rows = spark.createDataFrame([("a", 1), ("z", None), (None, 0)], "s string, n int")
    hot = rows.select(*[x.alias(k) for k, x in encode.one_hot(c("s"), ["a", "b"]).items()]).collect()
    assert [tuple(r) for r in hot] == [(1, 0), (0, 0), (0, 0)]
    assert one(rows.select(encode.keep_or_other(c("s"), ["a"]))) == ["a", "Otros", "Otros"]
    assert one(rows.select(encode.differs(c("n"), 0))) == [True, True, False]
    assert [tuple(r) for r in rows.select(*encode.membership_pair(c("s"), ["a"])).collect()] == [(1, 0), (0, 1), (0, 1)]
    assert list(encode.dummies(c("s"), ["c", "a", "b"], "g")) == ["g_b", "g_c"]
    assert one(rows.select(encode.label_code(c("s"), {"a": 0}))) == [0, None, None]
    assert one(rows.select(encode.remap(c("s"), {"z": "y"}))) == ["a", "y", None]


def test_cut_right_is_right_closed(spark):
    rows = spark.createDataFrame([(float(x),) for x in (0, 1, 1.5, 2, 3)], "x double")
    assert one(rows.select(encode.cut_right(c("x"), [0, 1, 2], ["lo", "hi"]))) == ["lo", "lo", "hi", "hi", None]
    with pytest.raises(ValueError):
        encode.cut_right(c("x"), [0, 1], ["a", "b"])


def test_normalise_and_tokens_keep_accents(spark):
    rows = texts(spark, "  Año 1967, NIÑO (v2)! -x- ", "", None)
    assert one(rows.select(tx.normalise(c("t")))) == ["año 1967 niño (v2) -x-", "", ""]
    assert one(rows.select(tx.tokens(c("t")))) == [["año", "1967", "niño"], [], []]


def test_whole_word_option(spark):
    rows = texts(spark, "autos", "un auto azul", "piñata")
    assert one(rows.select(tx.lexicon_any(c("t"), ["auto"]))) == [True, True, False]
    assert one(rows.select(tx.lexicon_any(c("t"), ["auto"], whole_word=True))) == [False, True, False]


def test_title_features(spark):
    assert len(tx.TITLE_FEATURES) == len(set(tx.TITLE_FEATURES)) == 57
    rows = texts(spark, "Libro Historia Argentina Antiguo 1967 Excelente Estado", "Samsung 256GB CORE i5 y 2021 - $30 (v2) 20 cm!", "", None)
    a, b, empty, null = [r.asDict() for r in tx.with_title_features(rows, "t").orderBy("i").collect()]
    assert a["año_mas_reciente"] == 1967 and a["antiguedad"] == fv.REFERENCE_YEAR - 1967
    assert a["es_año_muy_antiguo"] and a["es_libro"] and a["es_libro_antiguo"] and a["tiene_estado_explicito"]
    assert a["score_palabras_used"] == 5 and a["score_palabras_new"] == 0 and a["ratio_new_used"] == 0.0
    assert a["count_libro"] == 2 and a["score_categoria_weighted"] == pytest.approx(2 * 0.66)
    assert b["specs_gb"] == 1 and b["specs_core"] == 1 and b["versiones"] == 1 and b["dimensiones"] == 1
    assert b["tiene_precio"] and b["tiene_exclamacion"] and b["tiene_parentesis"] and b["num_guiones"] == 1
    assert b["es_año_reciente"] and b["palabras_mayusculas"] == 1 and b["es_electronico"] and b["es_marca_principal"]
    for blank in (empty, null):
        assert blank["año_mas_reciente"] == fv.REFERENCE_YEAR and blank["antiguedad"] == 0 and blank["longitud_titulo"] == 0


def test_flags_agree_with_counts(spark):
    rows = texts(spark, *fv.SAMPLE_TITLES, "Mesa y silla de cocina", "nada")
    for r in tx.with_title_features(rows, "t").collect():
        for name in fv.TITLE_CATEGORIES:
            assert r[f"es_{name}"] == (r[f"count_{name}"] > 0)
        assert r["tiene_año_completo"] == (r["num_años_completos"] > 0)
        assert r["balance_indicadores"] == r["indicadores_nuevo"] - r["indicadores_usado"]


def test_warranty_category(spark):
    rows = texts(spark, "6 meses de garantia", " ", None, "reputacion intachable", "qwerty")
    got = one(tx.with_warranty_category(rows, "t").orderBy("i").select("warranty_category"))
    assert got == [fv.WARRANTY_LABELS[2], fv.WARRANTY_LABELS[8], fv.WARRANTY_LABELS[8], fv.WARRANTY_LABELS[5], fv.WARRANTY_LABELS[8]]


def test_parse_reply(spark):
    rows = texts(spark, '{"a": 1}', 'ok:\n{"a":\n2} bye', "{bad", "none", None)
    assert one(rows.select(tx.parse_reply(c("t"), "struct<a:int>").getField("a"))) == [1, 2, None, None, None]


def test_render(spark):
    rows = texts(spark, "x", None)
    assert one(rows.select(tx.render("<{t}> {json} {t}", {"t": c("t")}))) == ["<x> {json} x", "<> {json} "]


def test_score_text_batches_and_default(spark):
    rows = texts(spark, *["a"] * 70, "", None)

    def fn(batch):
        return [str(len(batch))] * len(batch)

    got = one(score_text(rows.coalesce(1), "t", fn, "o", batch_size=32, default="blank").orderBy("i").select("o"))
    assert got[-2:] == ["blank", "blank"] and set(got[:64]) == {"32"} and set(got[64:70]) == {"6"}


def test_years_are_whole_matches(spark):
    rows = spark.createDataFrame([("new", "1998 y 2003"), ("new", "mod 19981"), ("used", "nada")], "k string, t string")
    got = tp.year_stats(rows, "t", "k").collect()
    assert [(r["class"], r["count"], r["min"], r["max"]) for r in got] == [("new", 2, 1998, 2003)]


def test_brand_words_do_not_split_inside_accents(spark):
    rows = texts(spark, "SONY Sony niñO FORD-Ka Éa", "sony")
    assert {r["brand"]: r["count"] for r in tp.brand_counts(rows, "t").collect()} == {"sony": 2, "ford": 1, "ka": 1}


def test_consolidate_counts_before_distinct(spark):
    rows = spark.createDataFrame([(["A", "b"], "X"), (["a", "desconocido"], "")], "k array<string>, b string")
    assert {r["value"]: r["count"] for r in tp.consolidate(rows, "k").collect()} == {"a": 2, "b": 1}
    assert {r["value"]: r["count"] for r in tp.consolidate(rows, "b").collect()} == {"x": 1}


def test_key_population_ignores_empty(spark):
    rows = spark.createDataFrame([(("", ["x"]),), (("m", []),), ((None, None),), (None,)], "s struct<a:string,b:array<string>>")
    got = {r["key"]: (r["rows_with_content"], r["examples"]) for r in key_population(rows, "s").collect()}
    assert got == {"a": (1, ["m"]), "b": (1, ['["x"]'])}


def test_element_class_counts_null_array_is_not_empty(spark):
    rows = spark.createDataFrame([([], "n"), (None, "n"), (["x"], "u")], "t array<string>, k string")
    assert {(r["element"], r["k"]): r["count"] for r in element_class_counts(rows, "t", "k").collect()} == {(None, "n"): 1, ("x", "u"): 1}


def test_a_slice_of_the_title_features_equals_the_whole(spark):
    from listlens.functions.text import TITLE_FEATURES, with_title_features

    rows = spark.createDataFrame([(t,) for t in (
        "Celular Samsung nuevo", "Libro de 1967", "Libro usado", "Freno kit para Ford", "Freno", "celular", "", None, "libro 2020 ¡AÑO!",
    )], "t string")
    some = ["es_electronico_nuevo", "es_libro_antiguo", "es_automotriz_nuevo", "balance_indicadores", "num_guiones"]
    whole, part = with_title_features(rows, "t"), with_title_features(rows, "t", columns=some)
    assert part.columns == ["t", *some] and whole.columns == ["t", *TITLE_FEATURES]
    assert sorted(part.collect(), key=str) == sorted(whole.select("t", *some).collect(), key=str)
    assert {r["t"] for r in part.collect() if any(r[c] for c in some[:3])} == {
        "Celular Samsung nuevo", "Libro de 1967", "Libro usado", "Freno kit para Ford", "libro 2020 ¡AÑO!",
    }
