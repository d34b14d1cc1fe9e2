"""Text profiling, text features and reply handling over the driver tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from listlens import fixed_values as fv
from listlens.bindings.registry import query
from listlens.bindings.tables import DOC_LABELS, TITLES, doc_labels, table, title_rows, words_sql
from listlens.functions import text as tx
from listlens.functions.scoring import score_text
from listlens.operators import text_profile as tp
from listlens.operators import tfidf
from listlens.plans.title_report import title_report
from listlens.plans.warranty import with_warranty_flags
from listlens.session import shared_folder
from listlens.sources.files import write_parquet

c = F.col
LEXICON = {
    "fasteners": ["bolt", "nut", "screw"], "rings": ["ring"], "gadgets": ["widget", "gear", "gizmo"],
    "colours": ["red", "blue", "green"], "brand_like": ["brand#1", "brand#2"], "nothing": ["zzzz"],
}
LANGUAGES = {
    "en": [" the ", " and ", " of "], "de": [" der ", " und ", " die "], "fr": [" le ", " les ", " que "],
    "es": [" el ", " los ", " una "],
}
REPLY = "keywords array<string>, category string, brand string, product_type string"


def q(text: str) -> str:
    return text.replace("'", "''")


@query("t1_clean", "select doc_id, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') as text from documents")
def _(spark, d):
    return table(spark, d, "documents", True).select("doc_id", tx.clean(c("text")).alias("text"))


def norm_sql(col: str) -> str:
    return (
        rf"trim(regexp_replace(regexp_replace(lower({col}), '[^\p{{L}}\p{{N}}_\s\-.()]', ' ', 'g'), '\s+', ' ', 'g'))"
    )


@query("t2_normalise", f"select doc_id, {norm_sql('text')} as text from documents")
def _(spark, d):
    return table(spark, d, "documents", True).select("doc_id", tx.normalise(c("text")).alias("text"))


DOC_WORDS = words_sql(DOC_LABELS, "text")


@query("t3_word_counts", f"select condition as class, word, count(*)::bigint as count from {DOC_WORDS} group by 1, 2")
def _(spark, d):
    return tp.word_counts(doc_labels(spark, d), "text", "condition")


def top_words_sql(words: str) -> str:
    return f"""select class, word, count, place from (select condition as class, word, count(*)::bigint as count,
 row_number() over (partition by condition order by count(*) desc, word)::bigint as place from {words} group by 1, 2) where place <= 20"""


@query("t3_top_words", top_words_sql(DOC_WORDS))
def _(spark, d):
    return tp.top_words(doc_labels(spark, d), "text", "condition")


def distinctive_sql(words: str) -> str:
    return f"""select case when rn > 2 and a >= 2 then 'new' else 'used' end as class, word,
  case when rn > 2 and a >= 2 then a else b end as freq, case when rn > 2 and a >= 2 then b else a end as other_freq,
  case when rn > 2 and a >= 2 then rn else ru end as ratio
 from (select word, a, b, a::double / (b + 1) as rn, b::double / (a + 1) as ru from (
  select word, count_if(condition = 'new')::bigint as a, count_if(condition = 'used')::bigint as b from {words} group by 1) where a + b >= 2)
 where (rn > 2 and a >= 2) or (ru > 2 and b >= 2)"""


def top_distinctive_sql(words: str, k: int) -> str:
    return f"""select class, word, freq, other_freq, round(ratio, 6) as ratio, place from (select *,
 row_number() over (partition by class order by ratio desc, freq desc, word)::bigint as place from ({distinctive_sql(words)})) where place <= {k}"""


@query("t4_distinctive_words_all", f"select class, word, freq, other_freq, round(ratio, 6) as ratio from ({distinctive_sql(DOC_WORDS)})")
def _(spark, d):
    return tp.distinctive_words(doc_labels(spark, d), "text", "condition", k=None)


@query("t4_distinctive_words", top_distinctive_sql(DOC_WORDS, 20))
def _(spark, d):
    return tp.distinctive_words(doc_labels(spark, d), "text", "condition")


def numeric_sql(source: str) -> str:
    return " union all ".join(
        f"select '{n}' as pattern, condition as class, sum(len(regexp_extract_all(lower(title), '{q(p)}')))::bigint as matches from {source} group by 2"
        for n, p in fv.NUMERIC_PATTERNS.items()
    )


@query("t5_numeric_patterns", f"with lt as {TITLES} {numeric_sql('lt')}")
def _(spark, d):
    return tp.numeric_patterns(title_rows(spark, d), "title", "condition")


@query("t5_pattern_matches", f"with lt as {TITLES}, m as (" + " union all ".join(
    f"select '{n}' as pattern, condition as class, unnest(regexp_extract_all(lower(title), '{q(p)}')) as match from lt"
    for n, p in fv.NUMERIC_PATTERNS.items()
) + ") select pattern, class, match, count(*)::bigint as count from m group by 1, 2, 3")
def _(spark, d):
    rows = tp.pattern_matches(title_rows(spark, d), "title", "condition")
    return rows.groupBy("pattern", "class", "match").count()


YEARS = r"(select condition as class, unnest(regexp_extract_all(title, '\b(?:19|20)\d{2}\b'))::int as year from " + TITLES + ")"
YEAR_STATS = "select class, count(*)::bigint as count, round(avg(year), 6) as mean, median(year) as median, min(year)::bigint as min, max(year)::bigint as max from {} group by 1"
TOP_YEARS = """select class, y as year, count, place from (select class, year::bigint as y, count(*)::bigint as count,
 row_number() over (partition by class order by count(*) desc, year::bigint)::bigint as place from {} group by class, year::bigint) where place <= 5"""


@query("t6_year_stats", YEAR_STATS.format(YEARS))
def _(spark, d):
    return tp.year_stats(title_rows(spark, d), "title", "condition")


@query("t6_top_years", TOP_YEARS.format(YEARS))
def _(spark, d):
    return tp.top_years(title_rows(spark, d), "title", "condition")


def brands_sql(source: str, text: str) -> str:
    return rf"""(select lower(w) as brand, count(*)::bigint as count from
 (select unnest(string_split_regex({text}, '[^\p{{L}}\p{{N}}_]+')) as w from {source})
 where regexp_full_match(w, '[A-Z][A-Z]+|[A-Z][a-z]+') group by 1)"""


@query("t7_brand_counts", f"select brand, count from {brands_sql('documents', 'text')}")
def _(spark, d):
    return tp.brand_counts(table(spark, d, "documents", True), "text")


@query("t7_brand_candidates", f"select brand, count from (select * from {brands_sql('documents', 'text')} order by count desc, brand limit 50) where count >= 3")
def _(spark, d):
    return tp.brand_candidates(table(spark, d, "documents", True), "text")


def top_brands_sql(source: str) -> str:
    return f"(select brand, count from (select * from {brands_sql(source, 'title')} order by count desc, brand limit 50) where count >= 3 order by count desc, brand limit 20)"


def share_sql(key: str, source: str) -> str:
    return f"""select {key}, count_if(condition = 'new')::bigint as n_new, count_if(condition = 'used')::bigint as n_used, count(*)::bigint as total,
 round(count_if(condition = 'new')::double / count(*), 6) as ratio_new from {source} group by 1"""


def _stored_titles(spark, d):
    """Title and condition of every line, joined once and kept in columns: a fraction of what the joins shuffle."""
    path = shared_folder(spark)
    write_parquet(title_rows(spark, d).select("title", "condition"), path)
    return spark.read.parquet(path)


@query("t8_brand_distribution", f"with lt as {TITLES} " + share_sql("brand", f"{top_brands_sql('lt')} join lt on contains(lower(title), brand)"))
def _(spark, d):
    # Two sections read the titles; their joins are done once.
    return tp.brand_distribution(_stored_titles(spark, d), "title", "condition")


def category_sql(source: str) -> str:
    rows = " union all ".join(
        f"select '{name}' as category, condition from {source} where " + " or ".join(f"contains(lower(title), '{w}')" for w in words)
        for name, words in LEXICON.items()
    )
    return share_sql("category", f"({rows})")


@query("t9_category_stats", f"with lt as {TITLES} {category_sql('lt')}")
def _(spark, d):
    return tp.category_stats(title_rows(spark, d), "title", "condition", LEXICON)


def special_sql(source: str) -> str:
    return " union all ".join(
        f"select '{n}' as pattern, condition as class, count_if(regexp_matches(title, '(?i){q(p)}'))::bigint as rows from {source} group by 2"
        for n, p in fv.SPECIAL_PATTERNS.items()
    )


@query("t10_special_patterns", f"with lt as {TITLES} {special_sql('lt')}")
def _(spark, d):
    return tp.special_patterns(title_rows(spark, d), "title", "condition")


def _report_sql() -> str:
    words = words_sql("lt", "title")
    stats = """select condition as class, count(*)::double as count, avg(length(title)) as avg_length, median(length(title)) as median_length,
 avg(len(regexp_extract_all(title, '\\S+'))) as avg_words, median(len(regexp_extract_all(title, '\\S+'))) as median_words,
 max(length(title))::double as max_length, min(length(title))::double as min_length from lt group by 1"""
    years = YEARS.replace(TITLES, "lt")
    parts = [
        f"select 'basic_stats' as section, name, class, value from (unpivot ({stats}) on count, avg_length, median_length, avg_words, median_words, max_length, min_length into name name value value)",
        f"select 'top_words', word, class, count::double from ({top_words_sql(words)})",
        f"select 'distinctive_words', word, class, ratio from ({top_distinctive_sql(words, 15)})",
        f"select 'numeric_patterns', pattern, class, matches::double from ({numeric_sql('lt')})",
        f"select 'years', name, class, value from (unpivot (select class, mean, median, min::double as min, max::double as max from ({YEAR_STATS.format(years)})) on mean, median, min, max into name name value value)",
        f"select 'top_years', year::varchar, class, count::double from ({TOP_YEARS.format(years)})",
        f"select 'brand_candidates', brand, 'all', count::double from {top_brands_sql('lt')}",
        f"select 'special_patterns', pattern, class, rows::double from ({special_sql('lt')})",
    ]
    for section, key, sql in (
        ("brand_distribution", "brand", share_sql("brand", f"{top_brands_sql('lt')} join lt on contains(lower(title), brand)")),
        ("category_stats", "category", category_sql("lt")),
    ):
        for cls, value in (("new", "n_new"), ("used", "n_used"), ("ratio_new", "ratio_new")):
            parts.append(f"select '{section}', {key}, '{cls}', {value}::double from ({sql})")
    for n, p in fv.REPORT_PATTERNS.items():
        parts.append(f"select 'regex_patterns', '{n}', '{q(p)}', null::double")
    return f"with lt as materialized {TITLES} select section, name, class, round(value, 6) as value from (" + " union all ".join(parts) + ")"


@query("t11_title_report", _report_sql())
def _(spark, d):
    # Nine sections read the titles; their join is done once.
    return title_report(_stored_titles(spark, d), "title", "condition", LEXICON)


# ---- the 57 title features, in three slices ----
def _lex(words, text: str = "norm") -> str:
    return "(" + " + ".join(f"contains({text}, '{w}')::int" for w in words) + ")"


def _title_sql(columns: dict[str, str]) -> str:
    r = lambda s: f"round({s[1:]}, 6)" if s.startswith("~") else (f"({s[1:]})" if s.startswith("?") else f"({s})::bigint")
    body = ", ".join(f'{r(s)} as "{n}"' for n, s in columns.items())
    return f"""with lt as (select title, {norm_sql('title')} as norm, list_transform(regexp_extract_all(title, '\\b(?:19[5-9]\\d|20[0-2]\\d)\\b'), lambda y: y::int) as years from {TITLES})
select title, {body} from lt"""


def _hits(pattern: str, fold: bool = False) -> str:
    return f"len(regexp_extract_all(title, '{'(?i)' if fold else ''}{q(pattern)}'))"


_NEW, _USED = _lex(fv.WORDS_NEW), _lex(fv.WORDS_USED)
_CAT = {n: _lex(w) for n, w in fv.TITLE_CATEGORIES.items()}
_OLD = "coalesce(list_max(years) < 2000, false)"
T12_SHAPE = {
    "longitud_titulo": "length(title)", "num_palabras": "case when norm = '' then 0 else len(string_split_regex(norm, '\\s+')) end",
    "densidad_texto": "~length(replace(title, ' ', ''))::double / greatest(length(title), 1)",
    "tiene_año_completo": "?len(years) > 0", "num_años_completos": "len(years)",
    "tiene_año_corto": f"?regexp_matches(title, '{fv.BARE_CENTURY}')",
    "año_mas_reciente": "coalesce(list_max(years), 2024)", "antiguedad": "coalesce(2024 - list_max(years), 0)",
    "es_año_muy_antiguo": "?coalesce(list_max(years) < 1990, false)", "es_año_antiguo": f"?{_OLD}",
    "es_año_reciente": "?coalesce(list_max(years) >= 2020, false)",
    "specs_gb": _hits(fv.SPEC_GB, True), "specs_mb": _hits(fv.SPEC_MB, True), "specs_core": _hits(fv.SPEC_CORE, True),
    "tiene_specs_tecnicas": f"?{_hits(fv.SPEC_GB, True)} + {_hits(fv.SPEC_MB, True)} + {_hits(fv.SPEC_CORE, True)} > 0",
    "modelos_numericos": _hits(fv.NUMERIC_MODELS), "versiones": _hits(fv.VERSIONS, True), "dimensiones": _hits(fv.DIMENSIONS, True),
}
T12_WORDS = {
    "score_palabras_new": _NEW, "score_palabras_used": _USED, "ratio_new_used": f"~{_NEW}::double / greatest({_USED}::double, 0.1::double)",
    "dominancia_new": f"?{_NEW} > {_USED}", "dominancia_used": f"?{_USED} > {_NEW}",
    "score_categoria_weighted": "~" + " + ".join(f"{sql} * {max(fv.CATEGORY_SHARE_NEW[n], 1 - fv.CATEGORY_SHARE_NEW[n])}::double" for n, sql in _CAT.items()),
    **{f"es_{n}": f"?{sql} > 0" for n, sql in _CAT.items()}, **{f"count_{n}": sql for n, sql in _CAT.items()},
    "es_marca_principal": f"?{_lex(fv.BRANDS)} > 0", "count_marcas": _lex(fv.BRANDS),
}
T12_SIGNS = {
    "tiene_exclamacion": "?contains(title, '!')", "tiene_parentesis": "?contains(title, '(') or contains(title, ')')",
    "tiene_guiones": "?contains(title, '-')", "num_guiones": "length(title) - length(replace(title, '-', ''))",
    "palabras_mayusculas": _hits(fv.CAPITAL_WORDS), "tiene_urgencia": f"?regexp_matches(title, '(?i){fv.URGENCY}')",
    "tiene_estado_explicito": f"?regexp_matches(title, '(?i){fv.STATED_CONDITION}')", "tiene_precio": f"?regexp_matches(title, '{fv.PRICES}')",
    "tiene_color": f"?regexp_matches(title, '(?i){fv.COLORS}')",
    "es_electronico_nuevo": f"?{_CAT['electronico']} > 0 and {_NEW} > 0", "es_libro_antiguo": f"?{_CAT['libro']} > 0 and ({_OLD} or {_USED} > 0)",
    "es_automotriz_nuevo": f"?{_CAT['automotriz']} > 0 and {_NEW} > 0",
    "indicadores_nuevo": _lex(fv.SIGNS_NEW), "indicadores_usado": _lex(fv.SIGNS_USED),
    "balance_indicadores": f"{_lex(fv.SIGNS_NEW)} - {_lex(fv.SIGNS_USED)}",
}


def _title_slice(columns):
    def run(spark, d):
        return tx.with_title_features(title_rows(spark, d).select("title"), "title", columns=list(columns))

    return run


query("t12_a_to_e_shape", _title_sql(T12_SHAPE))(_title_slice(T12_SHAPE))
query("t12_f_to_h_lexicons", _title_sql(T12_WORDS))(_title_slice(T12_WORDS))
query("t12_i_to_j_signs", _title_sql(T12_SIGNS))(_title_slice(T12_SIGNS))


# ---- TF-IDF ----
GRAMS = f"""(select id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
 list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as term from
 (select row_number() over () as id, regexp_extract_all({norm_sql('title')}, '[\\p{{L}}\\p{{N}}_]{{2,}}') as w from {TITLES}))"""
TERMS = f"(select term, sum(n)::bigint as tf, count(*)::bigint as df from (select id, term, count(*) as n from {GRAMS} group by 1, 2) group by 1)"


@query("t13_term_table", f"select term, tf, df from {TERMS}")
def _(spark, d):
    return tfidf.term_table(title_rows(spark, d), "title")


@query("t13_vocabulary_weights", f"""
with n as (select count(*) as n from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey)
select term, round(ln((1 + n)::double / (1 + df)) + 1, 6) as weight from (
 select term, tf, df, n from {TERMS}, n where df >= 2 and df <= 0.95::double * n order by tf desc, term limit 500)""")
def _(spark, d):
    model = tfidf.TextTfidf(inputCol="title").fit(title_rows(spark, d))
    rows = zip(model.getOrDefault("vocabulary"), model.getOrDefault("weights"))
    return spark.createDataFrame([(t, float(w)) for t, w in rows], "term string, weight double")


DOC_GRAMS = GRAMS.replace(TITLES, DOC_LABELS).replace("row_number() over () as id", "doc_id as id").replace(norm_sql("title"), norm_sql("text"))


@query("t13_tfidf_vectors", f"""
with g as (select id, term, count(*) as n from {DOC_GRAMS} group by 1, 2),
 d as (select count(*) as docs from {DOC_LABELS}),
 v as (select term, ln((1 + docs)::double / (1 + df)) + 1 as w from (select term, sum(n) as tf, count(*) as df from g group by 1), d
  where df >= 2 and df <= 0.95::double * docs order by tf desc, term limit 500),
 s as (select id, count(*) as terms, sum((1 + ln(n)) * w) as total, sqrt(sum(((1 + ln(n)) * w) * ((1 + ln(n)) * w))) as norm from g join v using (term) group by 1)
select doc_id, coalesce(terms, 0)::bigint as terms, round(coalesce(total / norm, 0), 6) as total from {DOC_LABELS} left join s on doc_id = id""")
def _(spark, d):
    rows = doc_labels(spark, d).select("doc_id", "text")
    model = tfidf.TextTfidf(inputCol="text").fit(rows)
    values = vector_to_array(c("tfidf"))
    return model.transform(rows).select(
        "doc_id", F.size(F.filter(values, lambda v: v > 0)).alias("terms"),
        F.aggregate(values, F.lit(0.0), lambda s, v: s + v).alias("total"),
    )


# ---- categories, prompts, replies ----
def _categorise_sql() -> str:
    score = {n: "(" + " + ".join(f"contains(low, '{w}')::int" for w in ws) + ")" for n, ws in LANGUAGES.items()}
    best = f"greatest({', '.join(score.values())})"
    cases = " ".join(f"when {s} = {best} then '{n}'" for n, s in score.items())
    return f"select doc_id, case when trim(low) = '' or {best} = 0 then 'unknown' {cases} end as guess from (select doc_id, lower(text) as low from documents)"


@query("t15_categorise", _categorise_sql())
def _(spark, d):
    rows = table(spark, d, "documents", True).select("doc_id", "text")
    return tx.with_category(rows, "text", "guess", LANGUAGES, "unknown").drop("text")


def _warranty_sql() -> str:
    score = {n: "(" + " + ".join(f"contains(low, '{w}')::int" for w in ws) + ")" for n, ws in fv.WARRANTY_WORDS.items()}
    best = f"greatest({', '.join(score.values())})"
    cases = " ".join(f"when {s} = {best} then '{n}'" for n, s in score.items())
    none, listed = fv.WARRANTY_LABELS[-1], ", ".join(f"'{v}'" for v in fv.NO_WARRANTY_LABELS)
    return f"""select doc_id, warranty_category, (warranty_category in ({listed}))::bigint as sin_garantia, (warranty_category not in ({listed}))::bigint as garantia_especifica
from (select doc_id, case when {best} = 0 then '{none}' {cases} end as warranty_category from (select doc_id, lower(coalesce(text, '')) as low from documents))"""


@query("t15_warranty_flags", _warranty_sql())
def _(spark, d):
    rows = table(spark, d, "documents", True).select("doc_id", c("text").alias("warranty"))
    return with_warranty_flags(rows).drop("warranty")


@query("t16_render", "select doc_id, 'Title: \"' || text || '\" in ' || lang || ' {json}' as prompt from documents")
def _(spark, d):
    return table(spark, d, "documents", True).select(
        "doc_id", tx.render('Title: "{text}" in {lang} {json}', {"text": c("text"), "lang": c("lang")}).alias("prompt")
    )


@query("t17_parse_reply", "select event_id, case when event_type <> 'error' then (props->>'k')::bigint end as k from events")
def _(spark, d):
    reply = (
        F.when(c("event_type") == "error", F.concat(F.lit("no object: "), F.substring("props", 2, 6)))
        .when(c("event_type").isin("view", "click"), F.concat(F.lit("Sure, here it is:\n"), c("props"), F.lit("\nAnything else?")))
        .otherwise(c("props"))
    )
    return table(spark, d, "events").select("event_id", tx.parse_reply(reply, "struct<k:bigint>").getField("k").alias("k"))


@query("t18_consolidate", """
select field, value, count(*)::bigint as count from (
 select 'keywords' as field, lower(unnest(string_split(p_name, ' '))) as value from part union all
 select 'category', lower(p_type) from part union all
 select 'brand', lower(case when p_size > 40 then 'Desconocido' else p_brand end) from part)
where value <> '' and value <> 'desconocido' group by 1, 2""")
def _(spark, d):
    replies = table(spark, d, "part").select(
        F.split("p_name", " ").alias("keywords"), c("p_type").alias("category"),
        F.when(c("p_size") > 40, "Desconocido").otherwise(c("p_brand")).alias("brand"),
    )
    parts = [tp.consolidate(replies, f).select(F.lit(f).alias("field"), "*") for f in ("keywords", "category", "brand")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("u1_score_text", "select doc_id, case when trim(text) = '' then 'blank' when length(text) > 1000 then 'long' else 'short' end as label from documents")
def _(spark, d):
    def by_length(texts):
        return ["long" if len(t) > 1000 else "short" for t in texts]

    return score_text(table(spark, d, "documents", True).select("doc_id", "text"), "text", by_length, "label", default="blank").drop("text")
