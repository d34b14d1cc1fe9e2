"""Small tables with the odd cases every operator must bear."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """Rows (id, text) or (id, text, lang, source) as a documents table."""
    full = [(r[0], r[1], *(r[2:] or ("en", "src1")), len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def clashing(df):
    """The table with further columns that have the names of columns operators make."""
    from pyspark.sql import functions as F

    names = ("id", "key", "row", "digest", "kept", "keep_id", "fp", "component_id", "score", "draw", "copies", "text_sha256", "next", "shard",
        "__key", "__copies", "__again", "__digest", "__n", "__w", "__id", "revisit", "refers_to", "body", "address", "page", "of", "size", "word", "n", "lost")
    return df.withColumns({n: F.lit("x") for n in names})


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = ["".join(r.choice(("th", "er", "on", "an", "re", "he", "in", "ed")) for _ in range(r.randint(1, 4))) for _ in range(300)]
    return " ".join(r.choice(words) for _ in range(n))


ODD = [
    (1, "a b c"), (2, None), (3, ""), (4, "a\tb\nc"), (5, "a b c"), (None, "a b c"), (None, None), (7, " "), (8, "x"), (8, "x"), (8, "y"),
    (9, prose(1, 40_000)), (10, prose(2, 300)), (11, prose(2, 300) + " end"), (12, "▁ Ünï Çode 日本 😀"),
]
