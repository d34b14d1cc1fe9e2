"""Per-class profiles of a text column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listlens import fixed_values as fv
from listlens.functions import text as tx
from listlens.operators.counts import class_counts, with_share
from listlens.operators.ordering import most_common, top_k_per_group

CLASSES = ("new", "used")


def word_counts(df: DataFrame, text: str, cls: str) -> DataFrame:
    """``class, word, count`` for words longer than two characters."""
    return (
        df.select(F.col(cls).alias("class"), F.explode(tx.tokens(F.col(text))).alias("word"))
        .groupBy("class", "word")
        .count()
    )


def top_words(df: DataFrame, text: str, cls: str, k: int = 20) -> DataFrame:
    return top_k_per_group(word_counts(df, text, cls), ["class"], [F.desc("count"), F.asc("word")], k)


def distinctive_words(
    df: DataFrame, text: str, cls: str, classes: Sequence[str] = CLASSES, k: int | None = 20
) -> DataFrame:
    """Words far more frequent in one class: ``class, word, freq, other_freq, ratio``.

    A word needs two hits in all, ``ratio = freq / (other + 1) > 2`` and ``freq >= 2``; the first
    class is tried first. ``k=None`` keeps every such word.
    """
    a, b = classes
    words = df.select(F.col(cls).alias("class"), F.explode(tx.tokens(F.col(text))).alias("word"))
    both = class_counts(words, "word", "class", classes)
    fa, fb = F.col(f"n_{a}"), F.col(f"n_{b}")
    ra, rb = fa / (fb + 1), fb / (fa + 1)
    pick = F.when((ra > 2) & (fa >= 2), F.struct(F.lit(a).alias("class"), fa.alias("freq"), fb.alias("other_freq"), ra.alias("ratio"))).when(
        (rb > 2) & (fb >= 2), F.struct(F.lit(b).alias("class"), fb.alias("freq"), fa.alias("other_freq"), rb.alias("ratio"))
    )
    found = (
        both.where(fa + fb >= 2).select("word", pick.alias("p")).where(F.col("p").isNotNull()).select("p.class", "word", "p.freq", "p.other_freq", "p.ratio")
    )
    if k is None:
        return found
    return top_k_per_group(found, ["class"], [F.desc("ratio"), F.desc("freq"), F.asc("word")], k)


def _per_class_sums(df: DataFrame, cls: str, columns: Mapping[str, Column], key: str, value: str) -> DataFrame:
    """Sum every column per class in one pass, then go long: ``key, class, value``."""
    named = {f"__{i}": (name, col) for i, (name, col) in enumerate(columns.items())}
    wide = (
        df.select(F.col(cls).alias("class"), *[c.cast("long").alias(k) for k, (_, c) in named.items()])
        .groupBy("class")
        .agg(*[F.sum(k).alias(k) for k in named])
    )
    pairs = F.array(*[F.struct(F.lit(n).alias(key), F.col(k).alias(value)) for k, (n, _) in named.items()])
    return wide.select("class", F.inline(pairs)).select(key, "class", value)


def numeric_patterns(
    df: DataFrame, text: str, cls: str, patterns: Mapping[str, str] = fv.NUMERIC_PATTERNS
) -> DataFrame:
    """Matches per pattern and class on lower-cased text, all patterns in one scan."""
    base = df.select(cls, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("__t"))
    cols = {name: tx.count_matches(F.col("__t"), p) for name, p in patterns.items()}
    return _per_class_sums(base, cls, cols, "pattern", "matches")


def pattern_matches(df: DataFrame, text: str, cls: str, patterns: Mapping[str, str] = fv.NUMERIC_PATTERNS) -> DataFrame:
    """Every match as a row: ``pattern, class, match``."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    lists = F.array(
        *[F.struct(F.lit(n).alias("pattern"), tx.all_matches(low, p).alias("m")) for n, p in patterns.items()]
    )
    return df.select(F.col(cls).alias("class"), F.inline(lists)).select(
        "pattern", "class", F.explode("m").alias("match")
    )


def _years(df: DataFrame, text: str, cls: str) -> DataFrame:
    found = tx.all_matches(F.coalesce(F.col(text), F.lit("")), fv.NUMERIC_PATTERNS["years"])
    return df.select(F.col(cls).alias("class"), F.explode(F.transform(found, lambda y: y.cast("int"))).alias("year"))


def year_stats(df: DataFrame, text: str, cls: str) -> DataFrame:
    """Mean, median, min, max of the years named per class.

    At most 200 different years exist, so the exact median is a small state.
    """
    return (
        _years(df, text, cls)
        .groupBy("class")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("year").alias("mean"),
            F.median("year").alias("median"),
            F.min("year").alias("min"),
            F.max("year").alias("max"),
        )
    )


def top_years(df: DataFrame, text: str, cls: str, k: int = 5) -> DataFrame:
    counts = _years(df, text, cls).groupBy("class", "year").count()
    return top_k_per_group(counts, ["class"], [F.desc("count"), F.asc("year")], k)


def brand_counts(df: DataFrame, text: str) -> DataFrame:
    """``brand, count`` of ALL-CAPS and Capitalised ASCII words, lower-cased.

    Words are cut at any non-word character of any script first, then matched whole.
    """
    words = F.split(F.coalesce(F.col(text), F.lit("")), rf"[^{tx.WORD}]+")
    return (
        df.select(F.explode(words).alias("w"))
        .where(F.col("w").rlike("^([A-Z][A-Z]+|[A-Z][a-z]+)$"))
        .groupBy(F.lower("w").alias("brand"))
        .count()
    )


def brand_candidates(df: DataFrame, text: str, k: int = 50, min_count: int = 3) -> DataFrame:
    """The ``k`` most frequent candidates, of these the ones seen ``min_count`` times."""
    return most_common(brand_counts(df, text), "brand", k, "count", min_count)


def lexicon_rows(
    df: DataFrame, text: str, cls: str, lexicon: Mapping[str, Sequence[str]], key: str, whole_word: bool = False
) -> DataFrame:
    """Rows per class whose lower-cased text holds any word of each entry, with the first class's share."""
    base = df.select(cls, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("__t"))
    cols = {name: tx.lexicon_any(F.col("__t"), words, whole_word) for name, words in lexicon.items()}
    long = _per_class_sums(base, cls, cols, key, "rows")
    return class_rows_with_share(long, key)


def top_brands(df: DataFrame, text: str, k: int = 20) -> list[str]:
    """Names of the ``k`` most frequent brand candidates: at most ``k`` short strings."""
    found = brand_candidates(df, text).orderBy(F.desc("count"), "brand").limit(k)
    return [r["brand"] for r in found.collect()]


def brand_distribution(df: DataFrame, text: str, cls: str, brands: Sequence[str] | None = None, k: int = 20) -> DataFrame:
    """Per-class rows containing each of the top ``k`` brands (as a substring)."""
    brands = top_brands(df, text, k) if brands is None else brands
    if not brands:
        return df.sparkSession.createDataFrame([], "brand string, n_new bigint, n_used bigint, total bigint, ratio_new double")
    return lexicon_rows(df, text, cls, {b: [b] for b in brands}, "brand")


def category_stats(
    df: DataFrame, text: str, cls: str, lexicon: Mapping[str, Sequence[str]] = fv.PROFILE_CATEGORIES, whole_word: bool = False
) -> DataFrame:
    return lexicon_rows(df, text, cls, lexicon, "category", whole_word)


def special_patterns(
    df: DataFrame, text: str, cls: str, patterns: Mapping[str, str] = fv.SPECIAL_PATTERNS
) -> DataFrame:
    """Rows per class matching each pattern, case ignored."""
    base = df.select(cls, F.coalesce(F.col(text), F.lit("")).alias("__t"))
    cols = {name: tx.has_match(F.col("__t"), p, True) for name, p in patterns.items()}
    return _per_class_sums(base, cls, cols, "pattern", "rows")


def one_pass_profile(
    df: DataFrame, text: str, cls: str, lexicon: Mapping[str, Sequence[str]], brands: Sequence[str]
) -> DataFrame:
    """Numeric patterns, special patterns, categories and brands together: ``section, name, class, value``.

    One scan for what the single operators would each read the text for.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    base = df.select(cls, raw.alias("__t"), F.lower(raw).alias("__low"))
    low = F.col("__low")
    sections = {
        "numeric_patterns": {n: tx.count_matches(low, p) for n, p in fv.NUMERIC_PATTERNS.items()},
        "special_patterns": {n: tx.has_match(F.col("__t"), p, True) for n, p in fv.SPECIAL_PATTERNS.items()},
        "category_stats": {n: tx.lexicon_any(low, words) for n, words in lexicon.items()},
        "brand_distribution": {b: low.contains(b) for b in brands},
    }
    flat = {f"{section}|{n}": col for section, cols in sections.items() for n, col in cols.items()}
    long = _per_class_sums(base, cls, flat, "key", "value")
    # Brand names hold no '|'; section names neither.
    parts = F.split("key", r"\|", 2)
    return long.select(parts[0].alias("section"), parts[1].alias("name"), "class", "value")


def class_rows_with_share(long: DataFrame, key: str) -> DataFrame:
    """Long per-class rows of one section as ``n_<class>``, total and share."""
    wide = long.groupBy(key).agg(
        *[F.sum(F.when(F.col("class") == c, F.col("rows")).otherwise(0)).alias(f"n_{c}") for c in CLASSES]
    )
    return with_share(wide, CLASSES)


def consolidate(replies: DataFrame, field: str, sentinel: str = fv.UNKNOWN_REPLY) -> DataFrame:
    """Frequency of a reply field (text or list of text), lower-cased, without blanks and the sentinel."""
    is_list = replies.schema[field].dataType.typeName() == "array"
    values = replies.select((F.explode(field) if is_list else F.col(field)).alias("v"))
    return (
        values.select(F.lower("v").alias("value"))
        .where((F.col("value") != "") & (F.col("value") != sentinel))
        .groupBy("value")
        .count()
    )
