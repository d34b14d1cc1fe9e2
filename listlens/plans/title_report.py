"""The combined report on a title column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listlens import fixed_values as fv
from listlens.operators import text_profile as tp
from listlens.operators.counts import text_stats
from listlens.sources.files import require_columns


def title_sections(
    df: DataFrame, text: str = "title", cls: str = "condition",
    lexicon: Mapping[str, Sequence[str]] = fv.PROFILE_CATEGORIES,
) -> dict[str, DataFrame]:
    """Every section of the report as its own table; rows of other classes are left out."""
    require_columns(df, [text, cls])
    rows = df.select(F.coalesce(text, F.lit("")).alias(text), F.coalesce(cls, F.lit("")).alias(cls)).where(
        F.col(cls).isin(list(tp.CLASSES))
    )
    together = tp.one_pass_profile(rows, text, cls, lexicon, tp.top_brands(rows, text))

    def section(name: str, key: str, value: str) -> DataFrame:
        return together.where(F.col("section") == name).select(
            F.col("name").alias(key), "class", F.col("value").alias(value)
        )

    return {
        "basic_stats": text_stats(rows, text, cls),
        "top_words": tp.top_words(rows, text, cls),
        "distinctive_words": tp.distinctive_words(rows, text, cls, k=15),
        "numeric_patterns": section("numeric_patterns", "pattern", "matches"),
        "years": tp.year_stats(rows, text, cls),
        "top_years": tp.top_years(rows, text, cls),
        "brand_candidates": tp.brand_candidates(rows, text),
        "brand_distribution": tp.class_rows_with_share(section("brand_distribution", "brand", "rows"), "brand"),
        "category_stats": tp.class_rows_with_share(section("category_stats", "category", "rows"), "category"),
        "special_patterns": section("special_patterns", "pattern", "rows"),
    }


def title_report(
    df: DataFrame, text: str = "title", cls: str = "condition",
    lexicon: Mapping[str, Sequence[str]] = fv.PROFILE_CATEGORIES,
) -> DataFrame:
    """All sections in one long table ``section, name, class, value``.

    The pattern texts themselves are a section too (``value`` null, pattern in ``class``).
    """
    s = title_sections(df, text, cls, lexicon)

    def long(section: str, t: DataFrame, name, klass, values: Sequence[str] | None = None, value=None) -> DataFrame:
        if values is not None:
            pairs = F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("value")) for v in values])
            t = t.select(klass.alias("class"), F.inline(pairs))
            return t.select(F.lit(section).alias("section"), "name", "class", "value")
        return t.select(F.lit(section).alias("section"), name.alias("name"), klass.alias("class"), value.cast("double").alias("value"))

    c, both = F.col, F.lit("all")
    stats = ["count", "avg_length", "median_length", "avg_words", "median_words", "max_length", "min_length"]
    parts = [
        long("basic_stats", s["basic_stats"], None, c("class"), stats),
        long("top_words", s["top_words"], c("word"), c("class"), value=c("count")),
        long("distinctive_words", s["distinctive_words"], c("word"), c("class"), value=c("ratio")),
        long("numeric_patterns", s["numeric_patterns"], c("pattern"), c("class"), value=c("matches")),
        long("years", s["years"], None, c("class"), ["mean", "median", "min", "max"]),
        long("top_years", s["top_years"], c("year").cast("string"), c("class"), value=c("count")),
        long("brand_candidates", s["brand_candidates"].orderBy(F.desc("count"), "brand").limit(20), c("brand"), both, value=c("count")),
        long("special_patterns", s["special_patterns"], c("pattern"), c("class"), value=c("rows")),
    ]
    for section, key in (("brand_distribution", "brand"), ("category_stats", "category")):
        parts += [
            long(section, s[section], c(key), F.lit(k), value=c(f"n_{k}")) for k in tp.CLASSES
        ]
        parts.append(long(section, s[section], c(key), F.lit("ratio_new"), value=c("ratio_new")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    listed = df.sparkSession.createDataFrame(
        [("regex_patterns", n, p, None) for n, p in fv.REPORT_PATTERNS.items()],
        "section string, name string, class string, value double",
    )
    return out.unionByName(listed)
