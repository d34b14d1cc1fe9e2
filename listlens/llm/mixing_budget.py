"""Mixing sources to target weights by a budget that flows down a tree of domain, language and source.

The total is divided among the domains by weight, each domain's share among its languages, each language's among
its sources. A node can use at most what its leaves hold times ``max_epochs``. What a node cannot use goes to
its siblings by weight, and only what the siblings cannot use either reaches the parent's siblings: the parent's
own share was bounded by what all its leaves can use. Within a node this is water-filling, solved by one
window over the children sorted by capacity per weight.

A leaf with budget Q and T tokens gives every document Q div T times, and a prefix of a seeded order for the
rest: each epoch has an order of its own, drawn from (seed, epoch, id). The prefix's end is found in cells of
the order: token sums of 4096 cells tell the cell that holds it, those of 4096 cells inside it the next, and
only rows of that last cell are ranked. So a leaf with a third of all rows is never sorted.

Everything is DataFrame operations. Shares are rounded down to whole tokens.

Defined cases: a null text has no tokens; null domain, language or source count as "unknown"; weights that are
not given are 1, weights must be 1 or more; rows without an id share one place in the order, as do rows that
repeat an id, and such rows are chosen together or not at all; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listlens.llm import shared
from listlens.session import broadcast_if_small

LEAF = ["domain", "lang", "source"]
CELL_BITS = 12
DRAW_BITS = 60
SEED = 7
MAX_EPOCHS = 2

# Target weights of the corpus at hand.
DOMAIN_WEIGHTS = {"web": 40, "books": 30, "code": 20, "wiki": 10}
LANG_WEIGHTS = {"en": 40, "de": 30, "fr": 20, "es": 10}


def domain_of(source: Column) -> Column:
    """Which domain a source of the documents table belongs to: by the number it ends with."""
    n = F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d{1,9})$", 1)
    kinds = F.array(*[F.lit(d) for d in DOMAIN_WEIGHTS])
    return F.when(n != "", F.get(kinds, n.cast("int") % len(DOMAIN_WEIGHTS))).otherwise(F.lit("unknown"))


def _weight(c: Column, weights: Mapping[str, int]) -> Column:
    if not weights:
        return F.lit(1).cast("bigint")
    pairs = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    return F.coalesce(F.element_at(pairs, c), F.lit(1)).cast("bigint")


def share_out(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Adds ``budget`` to rows (parent..., child, cap, weight, parent_budget).

    Sorted by capacity per weight, children are full as long as their capacity is at most their share of what
    the ones before leave; the rest divide what remains by weight.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ordered = by.orderBy(F.col("cap") / F.col("weight"), child)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("parent_budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.sum("weight").over(by) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    with_left = children.withColumns({"_left": left, "_weights": weights})
    open_ = F.col("cap") * F.col("_weights") > F.col("weight") * F.col("_left")
    first = F.first(F.when(open_, F.struct("_left", "_weights")), ignorenulls=True).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    shared_out = with_left.withColumn("_level", first).withColumn("_open", open_)
    rest = F.expr("(weight * _level._left) div _level._weights")
    return shared_out.withColumn("budget", F.when(F.col("_open"), rest).otherwise(F.col("cap"))).drop("_left", "_weights", "_level", "_open")


def leaf_budgets(leaves: DataFrame, total: Column, max_epochs: int, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(domain, lang, source, tokens, budget) for rows (domain, lang, source, tokens); ``total`` is a whole number."""
    now = leaves.withColumn("cap", F.col("tokens") * max_epochs).withColumn("parent_budget", total.cast("bigint"))
    parent: list[str] = []
    for level in LEAF:
        path = [*parent, level]
        node = now.groupBy(*path).agg(F.sum("cap").alias("cap"), F.first("parent_budget").alias("parent_budget"))
        given = share_out(node.withColumn("weight", _weight(F.col(level), weights.get(level, {}))), parent, level).select(*path, "budget")
        now = now.drop("parent_budget").join(given.withColumnRenamed("budget", "parent_budget"), path)
        parent = path
    return now.select(*LEAF, "tokens", F.col("parent_budget").alias("budget"))


def draw(seed: int, epoch: Column, id_col: Column) -> Column:
    """The place of an id in the order of an epoch: 60 bits of MD5."""
    text = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), shared.id_text(id_col))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _cut(rows: DataFrame, cell: str, least_before: Column) -> DataFrame:
    """Per leaf the first cell at which the running tokens exceed what the leaf still gets, and the tokens before it."""
    sums = rows.groupBy(*LEAF, cell).agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"), F.first(least_before).alias("before"))
    run = F.sum("n").over(Window.partitionBy(*LEAF).orderBy(cell))
    over = sums.withColumn("run", run + F.col("before")).where(F.col("run") > F.col("rest"))
    return over.groupBy(*LEAF).agg(F.min(F.struct(F.col(cell).alias("at"), (F.col("run") - F.col("n")).alias("before"))).alias("cut")).select(*LEAF, "cut.*")


def mix(
    docs: DataFrame, share: float, max_epochs: int = MAX_EPOCHS, seed: int = SEED, weights: Mapping[str, Mapping[str, int]] | None = None,
    id_col: str = "doc_id", text_col: str = "text", domain: Column | None = None,
) -> DataFrame:
    """One row per document: (id, key, domain, lang, source, n_tokens, leaf_budget, copies).

    ``share`` of all tokens is the total budget; ``weights`` has weights by level and name.
    """
    weights = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS} if weights is None else weights
    name = lambda c: F.coalesce(c.cast("string"), F.lit("unknown"))
    rows = shared.store(docs.select(
        docs[id_col].alias("id"), shared.row_key(docs[id_col], docs[text_col]).alias("key"),
        name(domain_of(docs["source"]) if domain is None else domain).alias("domain"), name(docs["lang"]).alias("lang"), name(docs["source"]).alias("source"),
        F.coalesce(F.regexp_count(docs[text_col], F.lit(shared.WORD)), F.lit(0)).cast("bigint").alias("n_tokens"),
    ))
    leaves = rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    tokens = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"))
    total = F.floor(tokens.select("n").scalar() * F.lit(share))
    plan = leaf_budgets(leaves, total, max_epochs, weights).select(
        *LEAF, F.col("budget").alias("leaf_budget"),
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("epochs"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("rest"),
    )
    drawn = rows.join(broadcast_if_small(plan), LEAF).withColumn("draw", draw(seed, F.col("epochs"), F.col("id")))
    mask = (1 << CELL_BITS) - 1
    celled = drawn.withColumns({
        "cell1": F.shiftright("draw", DRAW_BITS - CELL_BITS).cast("int"),
        "cell2": F.shiftright("draw", DRAW_BITS - 2 * CELL_BITS).bitwiseAND(F.lit(mask)).cast("int"),
    })
    cut1 = broadcast_if_small(_cut(celled, "cell1", F.lit(0).cast("bigint")).toDF(*LEAF, "at1", "before1"))
    at1 = celled.join(cut1, LEAF, "left")
    inside1 = at1.where("cell1 = at1")
    cut2 = broadcast_if_small(_cut(inside1, "cell2", F.col("before1")).toDF(*LEAF, "at2", "before2"))
    last = inside1.join(cut2, LEAF).where("cell2 = at2")
    run = F.sum("n_tokens").over(Window.partitionBy(*LEAF).orderBy("draw"))
    end = broadcast_if_small(
        last.withColumn("run", F.col("before2") + run).where("run > rest").groupBy(*LEAF).agg(F.min("draw").alias("end"))
    )
    # A leaf without an end gives its whole last epoch; rows before the end are the prefix.
    return celled.join(end, LEAF, "left").select(
        "id", "key", *LEAF, "n_tokens", "leaf_budget",
        (F.col("epochs") + F.coalesce((F.col("draw") < F.col("end")).cast("bigint"), F.lit(1))).alias("copies"),
    )


QUERY_SHARE = 0.6
#: The pipeline gives out as many tokens as it has; small leaves may repeat.
STAGE_SHARE = 1.0


def op10(docs: DataFrame) -> DataFrame:
    return mix(docs, QUERY_SHARE).select(F.col("id").alias("doc_id"), *LEAF, "n_tokens", "leaf_budget", "copies")


def stage(docs: DataFrame) -> DataFrame:
    """The documents as often as they were chosen, all columns."""
    chosen = mix(docs, STAGE_SHARE).where("copies > 0").groupBy("key").agg(F.max("copies").alias("copies"))
    keyed = docs.select(shared.row_key(docs["doc_id"], docs["text"]).alias("key"), F.struct("*").alias("row"))
    return keyed.join(chosen, "key").select("row", F.explode(F.expr("sequence(1, copies)"))).select("row.*")


SQL_OP10 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
         CASE WHEN regexp_matches(coalesce(source, ''), '\d{1,9}$')
              THEN (['web', 'books', 'code', 'wiki'])[CAST(regexp_extract(source, '(\d{1,9})$', 1) AS INT) % 4 + 1] ELSE 'unknown' END AS domain,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents
),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, 2 * CAST(sum(n_tokens) AS BIGINT) AS cap FROM d GROUP BY ALL),
n1 AS (
  SELECT domain, CAST(sum(cap) AS BIGINT) AS cap, CASE domain WHEN 'web' THEN 40 WHEN 'books' THEN 30 WHEN 'code' THEN 20 WHEN 'wiki' THEN 10 ELSE 1 END AS w,
         (SELECT CAST(floor(sum(tokens) * CAST(0.6 AS DOUBLE)) AS BIGINT) FROM leaves) AS b
  FROM leaves GROUP BY ALL
),
a1 AS (SELECT *, b - coalesce(sum(cap) OVER p, 0) AS lft, sum(w) OVER () - coalesce(sum(w) OVER p, 0) AS ws FROM n1
       WINDOW p AS (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g1 AS (SELECT domain, CASE WHEN cap * ws > w * lft THEN
         (w * first(CASE WHEN cap * ws > w * lft THEN lft END IGNORE NULLS) OVER o) // first(CASE WHEN cap * ws > w * lft THEN ws END IGNORE NULLS) OVER o
         ELSE cap END AS b FROM a1
       WINDOW o AS (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
n2 AS (
  SELECT domain, lang, CAST(sum(cap) AS BIGINT) AS cap, CASE lang WHEN 'en' THEN 40 WHEN 'de' THEN 30 WHEN 'fr' THEN 20 WHEN 'es' THEN 10 ELSE 1 END AS w, any_value(b) AS b
  FROM leaves JOIN g1 USING (domain) GROUP BY domain, lang
),
a2 AS (SELECT *, b - coalesce(sum(cap) OVER p, 0) AS lft, sum(w) OVER (PARTITION BY domain) - coalesce(sum(w) OVER p, 0) AS ws FROM n2
       WINDOW p AS (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g2 AS (SELECT domain, lang, CASE WHEN cap * ws > w * lft THEN
         (w * first(CASE WHEN cap * ws > w * lft THEN lft END IGNORE NULLS) OVER o) // first(CASE WHEN cap * ws > w * lft THEN ws END IGNORE NULLS) OVER o
         ELSE cap END AS b FROM a2
       WINDOW o AS (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
n3 AS (SELECT domain, lang, source, tokens, cap, 1 AS w, b FROM leaves JOIN g2 USING (domain, lang)),
a3 AS (SELECT *, b - coalesce(sum(cap) OVER p, 0) AS lft, sum(w) OVER (PARTITION BY domain, lang) - coalesce(sum(w) OVER p, 0) AS ws FROM n3
       WINDOW p AS (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g3 AS (SELECT domain, lang, source, tokens, CAST(CASE WHEN cap * ws > w * lft THEN
         (w * first(CASE WHEN cap * ws > w * lft THEN lft END IGNORE NULLS) OVER o) // first(CASE WHEN cap * ws > w * lft THEN ws END IGNORE NULLS) OVER o
         ELSE cap END AS BIGINT) AS leaf_budget FROM a3
       WINDOW o AS (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (
  SELECT d.*, leaf_budget, CASE WHEN tokens > 0 THEN leaf_budget // tokens ELSE 0 END AS epochs, CASE WHEN tokens > 0 THEN leaf_budget % tokens ELSE 0 END AS rest
  FROM d JOIN g3 USING (domain, lang, source)
),
r AS (SELECT *, CAST('0x' || substr(md5('7:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS draw FROM e)
SELECT doc_id, domain, lang, source, n_tokens, leaf_budget,
       CAST(epochs + CASE WHEN sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY draw) <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM r
"""
