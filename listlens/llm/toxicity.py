"""A toxicity classifier that is indifferent to which group a sentence names.

The model is a logistic regression over the words a text has. It is fitted on a bounded sample of labelled
rows (``FIT_ROWS``). Each labelled sentence that holds identity terms gets a counterfactual: the same sentence
with each term replaced by another one of its set. The loss adds the squared change of the score (as logit)
between the two, so weights of terms of a set are pulled together; and since a term that is used neutrally
is held by non-toxic rows too, mentions alone do not raise the score. Without the penalty the same code
fits the plain classifier.

Features are the words of a text and their beginnings (``PREFIXES`` letters), which stand for a word's inflected
forms. They count by presence, so that length alone says nothing. One is kept if it occurs in at least
``LEAST_DOCS`` rows of the sample and leans to one side more than chance would; an L1 penalty removes the rest.

Defined cases: a null text is the empty text and gets the score of a text without known words; labels that are
null or belong to no document are not used; of several labels of a document the largest counts; without labels
of both kinds every score is the smoothed share of toxic rows (0.5 without any); rows without an id are
scored, and count as not held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listlens.llm import shared

#: The most labelled rows a fit reads, the least rows that must hold a feature, and the most features of a model.
FIT_ROWS = 12_000
LEAST_DOCS = 6
MOST_WORDS = 4_096
#: Lengths of the word beginnings that are features.
PREFIXES = (3, 4, 5)
THRESHOLD = 0.7
#: Weight of the counterfactual penalty, the L1 penalty per row, and rounds of the fit.
COUNTERFACTUAL = 5.0
L1 = 0.0002
ROUNDS = 400

# Terms that name groups of people, in sets whose members can stand for one another.
IDENTITY_SETS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "arab", "african", "european", "native"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("disabled", "deaf", "blind", "autistic"),
    ("muslimisch", "christlich", "jüdisch"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
    ("musulman", "chrétien", "juif"),
    ("musulmán", "cristiano", "judío"),
)

_WORDS = re.compile(r"[^\W\d_]+")
_SENTENCES = re.compile(r"[^.!?\n]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORDS.findall((text or "").lower()))


def features_of(words: Iterable[str]) -> set[str]:
    """Words, and their beginnings with a star."""
    out = set(words)
    for n in PREFIXES:
        out |= {w[:n] + "*" for w in words if len(w) >= n}
    return out


def swaps(sets: Iterable[tuple[str, ...]]) -> dict[str, str]:
    """Each term's replacement: the next one of its set."""
    return {t: s[(i + 1) % len(s)] for s in sets for i, t in enumerate(s)}


def counterfactuals(text: str, swap: dict[str, str]) -> list[tuple[set[str], set[str]]]:
    """The words of each sentence that names a group, and of the same sentence with the terms swapped."""
    found = words_of(text)
    if found.isdisjoint(swap):
        return []
    out = []
    for s in _SENTENCES.findall(text.lower()):
        words = words_of(s)
        if not words.isdisjoint(swap):
            out.append((words, {swap.get(w, w) for w in words}))
    return out


class Rows:
    """Sparse 0/1 rows with weights: products with a vector and its transpose."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.n = len(rows)
        self.of = np.repeat(np.arange(self.n), [len(i) for i, _ in rows])
        self.at = np.concatenate([i for i, _ in rows]) if rows else np.zeros(0, dtype=np.int64)
        self.value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, self.value * w[self.at], minlength=self.n)

    def back(self, r: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.at, self.value * r[self.of], minlength=width)


def fit(rows: Rows, labels: np.ndarray, changes: Rows, width: int, penalty: float = COUNTERFACTUAL) -> tuple[np.ndarray, float]:
    """Weights and intercept: logistic loss + penalty * mean squared score change + L1, by accelerated proximal steps.

    Step sizes are set per weight from how many rows hold the word.
    """
    n, m = max(1, rows.n), max(1, changes.n)
    hold = np.bincount(rows.at, minlength=width) / n
    # A diagonal bound of the curvature: rows hold at most ``most`` features.
    most = max(1, np.bincount(rows.of, minlength=1).max(initial=1))
    moved = np.bincount(changes.at, changes.value**2, minlength=width) / m
    most_moved = max(1, np.bincount(changes.of, minlength=1).max(initial=1))
    step = 1.0 / (0.25 * most * hold + 2 * penalty * most_moved * moved + 1e-3)
    w, b = np.zeros(width), 0.0
    v, c, t = w.copy(), b, 1.0
    for _ in range(ROUNDS):
        r = 1 / (1 + np.exp(-np.clip(rows.times(v) + c, -30, 30))) - labels
        grad = rows.back(r, width) / n + 2 * penalty * changes.back(changes.times(v), width) / m
        new = v - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
        new_b = c - 4 * r.mean() / most
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    return w, b


def sample(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """(id, text, toxic) of at most ``most`` labelled rows that are not held out, chosen by a hash of their id.

    The ids are chosen in ``labels`` first; at most ``most`` of them are sent to the scan of the texts.
    """
    ids = (
        labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(ids.withColumnRenamed("doc_id", "__id")), F.col("doc_id") == F.col("__id")).select(
        F.col("doc_id").alias("id"), "text", F.col("toxic").cast("int").alias("toxic")
    )


def held_out(id_col: Column) -> Column:
    return F.crc32(shared.id_text(id_col)) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, identity_sets: Iterable[tuple[str, ...]] = IDENTITY_SETS, penalty: float = COUNTERFACTUAL) -> tuple[dict[str, float], float]:
    """Weight of each feature and the intercept."""
    identity_sets = [tuple(s) for s in identity_sets]
    swap, rows = swaps(identity_sets), shared.cut(sample(docs, labels))

    def features(batches):
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"], "words": [sorted(features_of(words_of(t))) for t in pdf["text"]]})

    counted = rows.select("toxic", "text").mapInPandas(features, "toxic int, words array<string>").select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("n_toxic")
    )
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n, n_toxic = sum(totals.values()), totals.get(1, 0)
    if not n_toxic or n_toxic == n:
        share = (n_toxic + 0.5) / (n + 1)
        return {}, float(np.log(share / (1 - share)))
    expected = F.col("n") * (n_toxic / n)
    lean = (F.col("n_toxic") - expected) / F.sqrt(expected * (1 - n_toxic / n))
    chosen = counted.where(F.col("n") >= LEAST_DOCS).where(F.abs(lean) >= 3).orderBy(F.abs(lean).desc(), "word").limit(MOST_WORDS)
    terms = {t for s in identity_sets for t in s}
    vocabulary = sorted({r["word"] for r in chosen.select("word").collect()} | terms)
    place = {w: i for i, w in enumerate(vocabulary)}

    def encode(batches):
        for pdf in batches:
            out = []
            for i, toxic, text in zip(pdf["id"], pdf["toxic"], pdf["text"]):
                out.append((i, 0, toxic, [place[w] for w in features_of(words_of(text)) if w in place], []))
                for a, b in ((features_of(x), features_of(y)) for x, y in counterfactuals(text or "", swap)):
                    out.append((i, 1, toxic, [place[w] for w in a - b if w in place], [place[w] for w in b - a if w in place]))
            yield pd.DataFrame(out, columns=["id", "kind", "toxic", "has", "gets"])

    # Bounded: FIT_ROWS rows of at most MOST_WORDS places; of the swapped sentences at most as many again.
    coded = rows.mapInPandas(encode, "id long, kind int, toxic int, has array<int>, gets array<int>")
    got = coded.where("kind = 0").orderBy("id", "toxic").collect()
    pairs = coded.where("kind = 1").orderBy(F.xxhash64("id"), "id", "has", "gets").limit(FIT_ROWS).collect()
    x = Rows([(np.array(sorted(r["has"]), dtype=np.int64), np.ones(len(r["has"]))) for r in got])
    d = Rows([(np.array(r["has"] + r["gets"], dtype=np.int64), np.r_[np.ones(len(r["has"])), -np.ones(len(r["gets"]))]) for r in pairs])
    w, b = fit(x, np.array([r["toxic"] for r in got], dtype=float), d, len(vocabulary), penalty)
    return {t: float(w[i]) for t, i in place.items() if w[i]}, float(b)


def scorer(weights: dict[str, float], intercept: float):
    """Column function text -> score."""

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        known = weights.keys()
        logits = [intercept + sum(sorted(weights[w] for w in features_of(words_of(t)) & known)) for t in text]
        return pd.Series(1 / (1 + np.exp(-np.clip(logits, -30, 30))) if logits else [], dtype="float64")

    return score


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    score = scorer(*train(docs, shared.table(spark, sf_dir, "labels")))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted toxic, all columns."""
    score = scorer(*train(docs, shared.table(spark, sf_dir, "labels")))
    return docs.where(score(docs["text"]) < THRESHOLD)
