"""Document fingerprints by a homomorphic multiset hash.

A text is a multiset of paragraphs: runs up to a line end, cut again after the end of a sentence so that a text
of one line has parts, too. Each paragraph is hashed to a vector of ``LANES`` bits (from its SHA-256), and the
fingerprint is the sum of the vectors modulo 2^14 per lane, with the number of paragraphs, modulo 2^16, behind them.
So the order of paragraphs does not matter, and inserting or deleting a paragraph adds or subtracts its vector.

A lane's bit stands for +1 or -1 (twice the sum less the number of paragraphs). Two such vectors' inner product
per lane estimates how many paragraphs the texts share, counted with multiplicity, so likeness is twice the
product over the sum of both squares: 1 for equal multisets, near 0 (about 1 / sqrt(LANES)) for
disjoint ones.

Four lanes share a long, 16 bits each, so that a sum of two lanes never carries into the next. Everything is
expressions over a row's own paragraphs. For the next document's text, rows are dealt to buckets of
ids and shuffled once; the first row of each bucket is sent to the bucket before it as well.

Defined cases: a null text is empty and has one empty paragraph; rows without an id come after all others;
of rows that repeat an id the order is by text; a single row is its own next document; empty tables give no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listlens.llm import shared
from listlens.session import broadcast_if_small

LANES = 256
_WORDS = LANES // 4
_ONES = 0x0001000100010001
_MODULUS_BITS = 14
_MASK = _ONES * ((1 << _MODULUS_BITS) - 1)
#: Rows in a bucket of neighbours, and quantiles of the ids that bound ranges of buckets.
BUCKET_ROWS = 8_000
RANGES = 64
BOUNDARY = r"\n+|(?<=[.!?])[\x20\t]+"


def paragraphs(text: Column) -> Column:
    return F.split(text, BOUNDARY, -1)


def _as_long(hex16: Column) -> Column:
    """16 hexadecimal digits as a signed long."""
    half = lambda at: F.conv(F.substring(hex16, at, 8), 16, 10).cast("bigint")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def add(a: Column, b: Column) -> Column:
    """Sum of two packed longs, modulo 2^14 in each lane."""
    return (a + b).bitwiseAND(F.lit(_MASK))


def subtract(a: Column, b: Column) -> Column:
    """Difference of two packed longs, modulo 2^14 in each lane."""
    return (a.bitwiseOR(F.lit(_ONES << _MODULUS_BITS)) - b).bitwiseAND(F.lit(_MASK))


def _hashes(parts: Column) -> Column:
    return F.transform(parts, lambda p: F.sha2(p, 256))


def _quarter(hashes: Column, k: int) -> Column:
    """A quarter of each hash as a long."""
    return F.transform(hashes, lambda h: _as_long(F.substring(h, 16 * k + 1, 16)))


def _lanes(longs: Column, shift: int) -> Column:
    """Packed sums of four bits of each long: of every quarter the bit at ``shift``."""
    return F.aggregate(longs, F.lit(0).cast("bigint"), lambda acc, b: add(acc, F.shiftrightunsigned(b, shift).bitwiseAND(F.lit(_ONES))))


def with_vector(df: DataFrame, parts: Column, name: str) -> DataFrame:
    """Adds the fingerprint of an array of paragraphs: packed lanes, and last the number of paragraphs modulo 2^16.

    Hashes and their quarters are columns of their own, as each is read many times.
    """
    quarters = [f"__q{k}" for k in range(4)]
    hashed = df.withColumn("__h", _hashes(parts)).withColumns({q: _quarter(F.col("__h"), k) for k, q in enumerate(quarters)})
    n = F.size("__h").cast("bigint") % 65536
    lanes = [_lanes(F.col(q), shift) for q in quarters for shift in range(16)]
    return hashed.withColumn(name, F.array(*lanes, n)).drop("__h", *quarters)


def combine(a: Column, b: Column, insert: bool = True) -> Column:
    """Fingerprint of the union of two multisets, or of what is left of ``a`` without ``b``."""
    both = F.zip_with(F.slice(a, 1, _WORDS), F.slice(b, 1, _WORDS), add if insert else subtract)
    n = F.element_at(a, -1) + F.element_at(b, -1) * (1 if insert else -1)
    return F.concat(both, F.array(F.pmod(n, F.lit(65536))))


def _signed_lanes(v: Column) -> Column:
    """Each lane's +1 minus -1 count; it is known modulo 2^15 and read as a signed number."""
    n = F.element_at(v, -1)
    lane = lambda x, s: F.pmod(2 * F.shiftright(x, s).bitwiseAND(F.lit(0xFFFF)) - n + 16384, F.lit(32768)) - 16384
    return F.flatten(F.transform(F.slice(v, 1, _WORDS), lambda x: F.array(*[lane(x, s) for s in (0, 16, 32, 48)])))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0).cast("bigint"), lambda acc, p: acc + p)


def likeness(equal: Column, product: Column, squares: Column) -> Column:
    """Estimated share of common paragraphs, 0 to 1, from a product of signed lanes and the sum of both squares."""
    near = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(2 * product, squares)))
    return F.when(equal, F.lit(1.0)).otherwise(F.coalesce(near, F.lit(0.0)))


def to_text(v: Column) -> Column:
    return F.lower(F.concat(F.array_join(F.transform(F.slice(v, 1, _WORDS), lambda x: F.lpad(F.hex(x), 16, "0")), ""), F.lpad(F.hex(F.element_at(v, -1)), 4, "0")))


def with_next(docs: DataFrame, id_col: str, carried: list[str]) -> DataFrame:
    """Adds ``next``: a struct of ``carried`` of the row that follows by descending id; after the last the first.

    One shuffle: buckets are runs of ids, found from quantiles and divided evenly between them. The row with
    the largest id of each bucket is sent to the next higher bucket, too, where it stands after all rows.
    """
    ids = docs.select(F.col(id_col).cast("bigint").alias("id"))
    n, bounds = ids.agg(F.count("*"), F.percentile_approx("id", [i / RANGES for i in range(1, RANGES)], 10_000)).first()
    lo, hi = ids.agg(F.min("id"), F.max("id")).first()
    if lo is None:
        edges = [0, 1]
    else:
        edges = sorted({lo, hi + 1, *(b for b in bounds or ())})
    inside = max(1, round(n / BUCKET_ROWS / (len(edges) - 1)))
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(edges[0] - 1))
    at = sum(((key >= e).cast("int") for e in edges[1:-1]), F.lit(0))
    low, high = F.element_at(F.array(*map(F.lit, edges)), at + 1), F.element_at(F.array(*map(F.lit, edges)), at + 2)
    step = F.greatest(F.lit(0), F.floor((key - low) * inside / (high - low))).cast("bigint")
    keyed = docs.withColumn("__sort", key).withColumn("__bucket", at * inside + step)
    heads = keyed.groupBy("__bucket").agg(F.max("__sort").alias("__sort"))
    # Of the buckets there is a row each; the highest one's head follows the lowest one's last row.
    order = Window.partitionBy(F.lit(0)).orderBy("__bucket")
    above = heads.withColumn("__to", F.coalesce(F.lead("__bucket").over(order), F.first("__bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    sent = keyed.join(broadcast_if_small(above.select("__sort", "__to"), 100_000), "__sort", "left")
    copies = F.array_compact(F.array(
        F.struct(F.col("__bucket").alias("b"), F.lit(0).alias("extra")),
        F.when(F.col("__to").isNotNull(), F.struct(F.col("__to").alias("b"), F.lit(1).alias("extra"))),
    ))
    dealt = sent.withColumn("__x", F.explode(copies)).drop("__bucket")
    following = Window.partitionBy("__x.b").orderBy("__x.extra", F.col("__sort").desc(), *[F.col(c) for c in carried[:1]])
    return dealt.withColumn("next", F.lead(F.struct(*carried)).over(following)).where("__x.extra = 0").drop("__x", "__sort", "__to")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of the text with its second half replaced by the next document's beginning, and their likeness."""
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    own = with_vector(texts, paragraphs(F.col("text")), "v")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = with_next(own, "id", ["text", "v"]).select(
        "id", n.cast("bigint").alias("n_chars"), "v", F.col("next.v").alias("w"),
        F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half)).alias("edited"),
    )
    made = with_vector(pairs, paragraphs(F.col("edited")), "e")
    lanes = made.withColumns({f"l{x}": _signed_lanes(F.col(x)) for x in "vew"})
    dots = lanes.withColumns({a + b: _dot(F.col(f"l{a}"), F.col(f"l{b}")) for a, b in ("vv", "ee", "ww", "ve", "vw")})
    return dots.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        to_text(F.col("v")).alias("fingerprint"), to_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("v") == F.col("e"), F.col("ve"), F.col("vv") + F.col("ee")).alias("near_edited"),
        likeness(F.col("v") == F.col("w"), F.col("vw"), F.col("vv") + F.col("ww")).alias("near_next"),
    )


def op8(docs: DataFrame) -> DataFrame:
    return fingerprint_edits(docs)
