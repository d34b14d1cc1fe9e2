"""Driver tables and the views derived from them, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listlens.sources.files import spread


def table(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """A driver table; ``heavy`` deals a small file out to all cores before costly per-row work."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if heavy else rows


# Labelled documents: quality plays the part of the listing's condition.
DOC_LABELS = """(select d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic,
 case when l.quality = 1 then 'new' else 'used' end as condition
 from documents d join labels l on d.doc_id = l.doc_id)"""


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.when(F.col("quality") == 1, "new").otherwise("used")
    return (
        table(spark, sf_dir, "documents", True).join(table(spark, sf_dir, "labels"), "doc_id").withColumn("condition", q)
    )


# Documents with nullable labels.
DOC_OUTER = """(select d.doc_id, d.lang, d.source, d.n_chars, d.text, l.quality
 from documents d left join labels l on d.doc_id = l.doc_id)"""


def doc_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left"
    )


# Listing titles with years, specs, prices and state words.
TITLES = """(select l_orderkey, l_linenumber,
 case when l_linestatus = 'O' then 'new' else 'used' end as condition,
 concat_ws(' ', p_name, p_type, p_brand,
  case when l_orderkey % 3 = 0 then cast(year(o_orderdate) as varchar) end,
  case when p_size % 4 = 0 then concat(cast(p_size as varchar), ' GB')
       when p_size % 4 = 1 then concat(cast(p_size as varchar), ' cm') end,
  case when l_linenumber % 2 = 0 then 'oferta!' end,
  case l_returnflag when 'R' then 'usado' when 'N' then 'nuevo' end,
  case when l_linenumber = 3 then concat('($', cast(cast(floor(p_retailprice) as bigint) as varchar), ')') end
 ) as title, lineitem.*, part.*, o_orderpriority, o_orderstatus, o_orderdate
 from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey)"""


def title_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part and order, a title and a condition; other columns stay for pruning."""
    c = F.col
    lines, part = table(spark, sf_dir, "lineitem", True), table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    # The part's texts come last: so only its own rows carry them through a shuffle, not every line.
    rows = (
        lines.join(orders, c("l_orderkey") == c("o_orderkey")).join(part, c("l_partkey") == c("p_partkey"))
        .select(*lines.columns, *part.columns, *orders.columns)
    )
    size = c("p_size").cast("string")
    title = F.concat_ws(
        " ", "p_name", "p_type", "p_brand",
        F.when(c("l_orderkey") % 3 == 0, F.year("o_orderdate").cast("string")),
        F.when(c("p_size") % 4 == 0, F.concat(size, F.lit(" GB"))).when(c("p_size") % 4 == 1, F.concat(size, F.lit(" cm"))),
        F.when(c("l_linenumber") % 2 == 0, F.lit("oferta!")),
        F.when(c("l_returnflag") == "R", F.lit("usado")).when(c("l_returnflag") == "N", F.lit("nuevo")),
        F.when(
            c("l_linenumber") == 3, F.concat(F.lit("($"), F.floor("p_retailprice").cast("bigint").cast("string"), F.lit(")"))
        ),
    )
    return rows.withColumn("title", title).withColumn(
        "condition", F.when(c("l_linestatus") == "O", "new").otherwise("used")
    )


# Full listing records, built row by row from the title view: nested columns need no grouping.
LISTINGS = f"""(select *, l_extendedprice as price, l_discount >= 0.05 as automatic_relist,
 cast(l_quantity as bigint) as initial_quantity, cast(p_size as bigint) as sold_quantity,
 case when p_size <> 50 then struct_pack(local_pick_up := l_tax > 0.04,
   free_shipping := case when l_linenumber <> 7 then l_discount < 0.03 end,
   mode := case l_returnflag when 'A' then 'me1' when 'R' then 'me2' else 'not_specified' end) end as shipping,
 list_filter([
   case when l_quantity <= 20 then struct_pack(id := '1', description := 'Visa', type := 'C') end,
   case when l_tax >= 0.05 then struct_pack(id := '2', description := 'Efectivo', type := 'N') end,
   case when p_size > 25 then struct_pack(id := '3', description := 'MercadoPago', type := 'G') end,
   case when o_orderstatus = 'P' then struct_pack(id := '4', description := 'Otro medio', type := 'N') end],
   lambda x: x is not null) as payments,
 case when l_returnflag <> 'A' then list_transform(range(1, l_linenumber), lambda i: struct_pack(
   available_quantity := case when (l_partkey + i) % 5 <> 0 then cast(l_quantity as bigint) * i end,
   price := l_extendedprice / i)) end as variations,
 case p_type when 'STANDARD' then 'bronze' when 'MEDIUM' then 'silver' when 'LARGE' then 'free'
   when 'SMALL' then 'gold_special' when 'ECONOMY' then 'other_type' end as listing_type_id,
 case o_orderpriority when '1-URGENT' then 'auction' when '2-HIGH' then 'classified'
   when '3-MEDIUM' then 'buy_it_now' when '4-NOT SPECIFIED' then 'buy_it_now' end as buying_mode,
 case when l_linenumber <> 6 then list_filter([
   case when l_quantity > 40 then 'dragged_visits' end, case when l_discount > 0.07 then 'free_relist' end,
   case when p_size < 10 then 'good_quality_thumbnail' end, case when l_tax = 0 then 'other_tag' end],
   lambda x: x is not null) end as tags,
 case when p_size % 10 = 0 then l_suppkey end as official_store_id,
 case l_linenumber when 1 then 'Sin garantía' when 2 then 'Garantía con plazo explícito'
   when 3 then 'Garantía basada en reputación del vendedor' when 5 then 'Garantía por defecto de fabricación'
   end as warranty_category,
 case l_suppkey % 8 when 0 then 'Capital Federal' when 1 then 'Buenos Aires' when 2 then 'Santa Fe'
   when 3 then 'Córdoba' when 4 then 'Mendoza' when 5 then 'Salta' end as state_name
 from {TITLES})"""


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing records with native nested columns, one per line item."""
    c, lit = F.col, F.lit

    def payment(i: str, name: str, kind: str):
        return F.struct(lit(i).alias("id"), lit(name).alias("description"), lit(kind).alias("type"))

    quantity = c("l_quantity").cast("bigint")
    variation = lambda i: F.struct(
        F.when((c("l_partkey") + i) % 5 != 0, quantity * i).alias("available_quantity"),
        (c("l_extendedprice") / i).alias("price"),
    )
    steps = F.when(c("l_linenumber") > 1, F.sequence(lit(1), c("l_linenumber") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    states = ["Capital Federal", "Buenos Aires", "Santa Fe", "Córdoba", "Mendoza", "Salta"]
    state = lit(None).cast("string")
    for i, name in enumerate(states):
        state = F.when(c("l_suppkey") % 8 == i, lit(name)).otherwise(state)
    kinds = {"STANDARD": "bronze", "MEDIUM": "silver", "LARGE": "free", "SMALL": "gold_special", "ECONOMY": "other_type"}
    modes = {"1-URGENT": "auction", "2-HIGH": "classified", "3-MEDIUM": "buy_it_now", "4-NOT SPECIFIED": "buy_it_now"}
    warranty = {
        1: "Sin garantía", 2: "Garantía con plazo explícito",
        3: "Garantía basada en reputación del vendedor", 5: "Garantía por defecto de fabricación",
    }

    def pick(col, mapping):
        out = lit(None).cast("string")
        for k, v in mapping.items():
            out = F.when(col == k, lit(v)).otherwise(out)
        return out

    return title_rows(spark, sf_dir).withColumns(
        {
            "price": c("l_extendedprice"),
            "automatic_relist": c("l_discount") >= 0.05,
            "initial_quantity": quantity,
            "sold_quantity": c("p_size").cast("bigint"),
            "shipping": F.when(
                c("p_size") != 50,
                F.struct(
                    (c("l_tax") > 0.04).alias("local_pick_up"),
                    F.when(c("l_linenumber") != 7, c("l_discount") < 0.03).alias("free_shipping"),
                    F.when(c("l_returnflag") == "A", "me1").when(c("l_returnflag") == "R", "me2")
                    .otherwise("not_specified").alias("mode"),
                ),
            ),
            "non_mercado_pago_payment_methods": F.array_compact(
                F.array(
                    F.when(c("l_quantity") <= 20, payment("1", "Visa", "C")),
                    F.when(c("l_tax") >= 0.05, payment("2", "Efectivo", "N")),
                    F.when(c("p_size") > 25, payment("3", "MercadoPago", "G")),
                    F.when(c("o_orderstatus") == "P", payment("4", "Otro medio", "N")),
                )
            ),
            "variations": F.when(c("l_returnflag") != "A", F.transform(steps, variation)),
            "listing_type_id": pick(c("p_type"), kinds),
            "buying_mode": pick(c("o_orderpriority"), modes),
            "tags": F.when(
                c("l_linenumber") != 6,
                F.array_compact(
                    F.array(
                        F.when(c("l_quantity") > 40, "dragged_visits"),
                        F.when(c("l_discount") > 0.07, "free_relist"),
                        F.when(c("p_size") < 10, "good_quality_thumbnail"),
                        F.when(c("l_tax") == 0, "other_tag"),
                    )
                ),
            ),
            "official_store_id": F.when(c("p_size") % 10 == 0, c("l_suppkey")),
            "warranty_category": pick(c("l_linenumber"), warranty),
            "seller_address": F.when(
                c("l_suppkey") % 8 != 7, F.struct(F.struct(state.alias("name")).alias("state"))
            ),
        }
    )


# Words of the labelled documents and of the titles, longer than two characters.
def words_sql(source: str, text: str) -> str:
    return (
        f"(select condition, unnest(list_filter(string_split_regex(regexp_replace(lower({text}), "
        rf"'[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+'), lambda w: length(w) > 2)) as word from {source})"
    )
