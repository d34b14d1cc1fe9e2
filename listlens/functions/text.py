"""Column expressions over text. Word characters are letters, digits and '_' of any script."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listlens import fixed_values as fv

WORD = r"\p{L}\p{N}_"


def unicode_pattern(pattern: str, ignore_case: bool = False) -> str:
    r"""The pattern with \\b, \\w, \\d, \\s reading all scripts."""
    return ("(?iU)" if ignore_case else "(?U)") + pattern


def count_matches(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    return F.regexp_count(text, F.lit(unicode_pattern(pattern, ignore_case)))


def has_match(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    return text.rlike(unicode_pattern(pattern, ignore_case))


def all_matches(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    """Whole matches, whatever groups the pattern has."""
    return F.regexp_extract_all(text, F.lit(unicode_pattern(pattern, ignore_case)), F.lit(0))


def clean(text: Column) -> Column:
    """The text without white space at its ends, line breaks and tabs included."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")


def normalise(text: Column) -> Column:
    """Lower case; every run of anything but word characters and ``-.()`` becomes one space."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.trim(F.regexp_replace(low, rf"[^{WORD}\-.()]+", " "))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def tokens(text: Column, min_length: int = 3) -> Column:
    """Lower-cased runs of word characters, of at least ``min_length``."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"[{WORD}]{{{min_length},}}"), F.lit(0))


def contains_word(text: Column, word: Column, whole_word: bool = False) -> Column:
    """Substring test; with ``whole_word`` the hit must not touch other word characters."""
    if not whole_word:
        return F.contains(text, word)
    return F.rlike(text, F.concat(F.lit(rf"(?<![{WORD}])\Q"), word, F.lit(rf"\E(?![{WORD}])")))


def lexicon_count(text: Column, words: Sequence[str], whole_word: bool = False) -> Column:
    """How many of the words occur in the text.

    A filter over a constant array: one small expression per word list instead of one per word,
    which keeps wide projections inside what the JIT compiles. ``text`` should be a plain column.
    """
    return F.size(F.filter(_constant(words), lambda w: contains_word(text, w, whole_word)))


def lexicon_any(text: Column, words: Sequence[str], whole_word: bool = False) -> Column:
    return F.exists(_constant(words), lambda w: contains_word(text, w, whole_word))


def _constant(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def categorise(text: Column, lexicon: Mapping[str, Sequence[str]], default: str) -> Column:
    """Label with the most matching words, ties to the first listed; blank or unmatched text -> default.

    ``text`` should be a plain lower-case column; ``with_category`` prepares one.
    """
    scored = F.array(
        *[
            F.struct(lexicon_count(text, words).alias("score"), F.lit(-i).alias("rank"), F.lit(label).alias("label"))
            for i, (label, words) in enumerate(lexicon.items())
        ]
    )
    best = F.array_max(scored)
    return F.when(best.getField("score") > 0, best.getField("label")).otherwise(F.lit(default))


def with_category(df: DataFrame, text: str, output: str, lexicon: Mapping[str, Sequence[str]], default: str) -> DataFrame:
    """Add the rule-based category of a free text."""
    low = df.withColumn("__low", F.lower(F.coalesce(F.col(text), F.lit(""))))
    return low.withColumn(output, categorise(F.col("__low"), lexicon, default)).drop("__low")


def with_warranty_category(df: DataFrame, text: str = "warranty", output: str = "warranty_category") -> DataFrame:
    """One of the nine warranty labels; blank text has no warranty."""
    return with_category(df, text, output, fv.WARRANTY_WORDS, fv.WARRANTY_LABELS[-1])


def render(template: str, columns: Mapping[str, Column]) -> Column:
    """Fill ``{name}`` places with columns; nulls become empty text."""
    parts, rest = [], template
    while rest:
        spots = [(rest.find("{" + n + "}"), n) for n in columns if "{" + n + "}" in rest]
        if not spots:
            parts.append(F.lit(rest))
            break
        at, name = min(spots)
        parts += [F.lit(rest[:at]), F.coalesce(columns[name].cast("string"), F.lit(""))]
        rest = rest[at + len(name) + 2:]
    return F.concat(*parts)


def parse_reply(reply: Column, schema: str) -> Column:
    """JSON reply as a struct; if the whole text is no JSON object, its outermost ``{...}`` block; else null."""
    block = F.regexp_extract(reply, r"(?s)\{.*\}", 0)

    def parsed(text: Column) -> Column:
        # from_json alone turns a broken text into a struct of nulls.
        valid = F.trim(text).startswith("{") & F.try_parse_json(text).isNotNull()
        return F.when(valid, F.from_json(text, schema))

    return F.coalesce(parsed(reply), parsed(block))


def _base_features(raw: Column, norm: Column, years: Column) -> dict[str, Column]:
    """Features read straight off the text."""
    f = {
        "longitud_titulo": F.length(raw),
        "num_palabras": word_count(norm),
        "densidad_texto": F.length(F.replace(raw, F.lit(" "), F.lit(""))).cast("double")
        / F.greatest(F.length(raw), F.lit(1)),
        "num_años_completos": F.size(years),
        "tiene_año_corto": has_match(raw, fv.BARE_CENTURY),
        "__latest": F.array_max(years),
        "specs_gb": count_matches(raw, fv.SPEC_GB, True),
        "specs_mb": count_matches(raw, fv.SPEC_MB, True),
        "specs_core": count_matches(raw, fv.SPEC_CORE, True),
        "modelos_numericos": count_matches(raw, fv.NUMERIC_MODELS),
        "versiones": count_matches(raw, fv.VERSIONS, True),
        "dimensiones": count_matches(raw, fv.DIMENSIONS, True),
        "score_palabras_new": lexicon_count(norm, fv.WORDS_NEW),
        "score_palabras_used": lexicon_count(norm, fv.WORDS_USED),
        "count_marcas": lexicon_count(norm, fv.BRANDS),
        "tiene_exclamacion": raw.contains("!"),
        "tiene_parentesis": raw.contains("(") | raw.contains(")"),
        "tiene_guiones": raw.contains("-"),
        "num_guiones": F.regexp_count(raw, F.lit("-")),
        "palabras_mayusculas": count_matches(raw, fv.CAPITAL_WORDS),
        "tiene_urgencia": has_match(raw, fv.URGENCY, True),
        "tiene_estado_explicito": has_match(raw, fv.STATED_CONDITION, True),
        "tiene_precio": has_match(raw, fv.PRICES),
        "tiene_color": has_match(raw, fv.COLORS, True),
        "indicadores_nuevo": lexicon_count(norm, fv.SIGNS_NEW),
        "indicadores_usado": lexicon_count(norm, fv.SIGNS_USED),
    }
    f.update({f"count_{name}": lexicon_count(norm, words) for name, words in fv.TITLE_CATEGORIES.items()})
    return f


def _derived_features(reference_year: int, counted: Sequence[str]) -> dict[str, Column]:
    """Features combining the base ones; where a count is not among ``counted``, only whether any word occurs is looked for."""
    c = F.col

    def some(name: str, words: Sequence[str]) -> Column:
        return c(name) > 0 if name in counted else lexicon_any(c("__norm"), words)

    def of_category(name: str) -> Column:
        return some(f"count_{name}", fv.TITLE_CATEGORIES[name])

    any_new, any_used = some("score_palabras_new", fv.WORDS_NEW), some("score_palabras_used", fv.WORDS_USED)
    latest = c("__latest")
    new, used = c("score_palabras_new"), c("score_palabras_used")
    old_year = F.coalesce(latest < 2000, F.lit(False))
    weighted = F.lit(0.0)
    for name, share in fv.CATEGORY_SHARE_NEW.items():
        weighted = weighted + c(f"count_{name}") * F.lit(share if share > 0.5 else 1 - share)
    f = {
        "tiene_año_completo": c("num_años_completos") > 0,
        "año_mas_reciente": F.coalesce(latest, F.lit(reference_year)),
        "antiguedad": F.coalesce(F.lit(reference_year) - latest, F.lit(0)),
        "es_año_muy_antiguo": F.coalesce(latest < 1990, F.lit(False)),
        "es_año_antiguo": old_year,
        "es_año_reciente": F.coalesce(latest >= 2020, F.lit(False)),
        "tiene_specs_tecnicas": (c("specs_gb") + c("specs_mb") + c("specs_core")) > 0,
        "ratio_new_used": new.cast("double") / F.greatest(used.cast("double"), F.lit(0.1)),
        "dominancia_new": new > used,
        "dominancia_used": used > new,
        "score_categoria_weighted": weighted,
        "es_marca_principal": c("count_marcas") > 0,
        "es_electronico_nuevo": of_category("electronico") & any_new,
        "es_libro_antiguo": of_category("libro") & (old_year | any_used),
        "es_automotriz_nuevo": of_category("automotriz") & any_new,
        "balance_indicadores": c("indicadores_nuevo") - c("indicadores_usado"),
    }
    f.update({f"es_{name}": c(f"count_{name}") > 0 for name in fv.TITLE_CATEGORIES})
    return f


TITLE_FEATURES = [
    "longitud_titulo", "num_palabras", "densidad_texto",
    "tiene_año_completo", "num_años_completos", "tiene_año_corto",
    "año_mas_reciente", "antiguedad", "es_año_muy_antiguo", "es_año_antiguo", "es_año_reciente",
    "specs_gb", "specs_mb", "specs_core", "tiene_specs_tecnicas",
    "modelos_numericos", "versiones", "dimensiones",
    "score_palabras_new", "score_palabras_used", "ratio_new_used", "dominancia_new", "dominancia_used",
    "score_categoria_weighted",
    *[f"{kind}_{name}" for name in fv.TITLE_CATEGORIES for kind in ("es", "count")],
    "es_marca_principal", "count_marcas",
    "tiene_exclamacion", "tiene_parentesis", "tiene_guiones", "num_guiones",
    "palabras_mayusculas", "tiene_urgencia", "tiene_estado_explicito", "tiene_precio", "tiene_color",
    "es_electronico_nuevo", "es_libro_antiguo", "es_automotriz_nuevo",
    "indicadores_nuevo", "indicadores_usado", "balance_indicadores",
]


def with_title_features(
    df: DataFrame, title: str, reference_year: int = fv.REFERENCE_YEAR, columns: Sequence[str] = tuple(TITLE_FEATURES)
) -> DataFrame:
    """Append the 57 title features, or those of ``columns``.

    Three stacked projections, so normalised text, years and counts are computed once per row.
    Lexicons look at the normalised title, patterns and punctuation at the raw one.
    """
    text = df.withColumns(
        {
            "__raw": F.coalesce(F.col(title), F.lit("")),
            "__norm": normalise(F.col(title)),
            "__years": F.transform(
                all_matches(F.coalesce(F.col(title), F.lit("")), fv.FULL_YEARS), lambda y: y.cast("int")
            ),
        }
    )
    base = text.withColumns(_base_features(F.col("__raw"), F.col("__norm"), F.col("__years")))
    return base.withColumns(_derived_features(reference_year, columns)).select(*df.columns, *columns)
