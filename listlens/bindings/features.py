"""Nested, encoding and composed feature operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from listlens import fixed_values as fv
from listlens.bindings.registry import query
from listlens.bindings.tables import DOC_OUTER, LISTINGS, doc_outer, listings, table
from listlens.functions import encode, nested
from listlens.operators import nested_profile as npf
from listlens.operators import counts, ordering
from listlens.plans.listing_features import listing_features

c = F.col
PAYMENTS = "non_mercado_pago_payment_methods"


# ---- nested columns ----
@query("n1_parse_nested", """
select event_id, case when event_type = 'error' then null else (props->>'k')::bigint end as k from events""")
def _(spark, d):
    # JSON, the same in Python spelling, and for errors text that is no object.
    text = (
        F.when(c("event_type") == "error", F.concat(F.lit("oops "), F.substring("props", 2, 4)))
        .when(c("event_type") == "click", F.regexp_replace(F.regexp_replace("props", '"', "'"), r"\}", ", 'x': None, 'y': True}"))
        .otherwise(c("props"))
    )
    rows = table(spark, d, "events").select("event_id", "event_type", "props")
    return rows.select("event_id", nested.parse_nested(text, "struct<k:bigint,y:boolean>").getField("k").alias("k"))


@query("n2_struct_fields", f"""
select l_orderkey, shipping.local_pick_up as local_pick_up, shipping.free_shipping as free_shipping, shipping.mode as mode from {LISTINGS}""")
def _(spark, d):
    return listings(spark, d).select(
        "l_orderkey", *[nested.path(c("shipping"), f).alias(f) for f in ("local_pick_up", "free_shipping", "mode")]
    )


@query("n3_nested_path", "select c_custkey, n_name as state, r_name as region from customer left join nation on c_nationkey = n_nationkey and n_regionkey <> 2 left join region on n_regionkey = r_regionkey")
def _(spark, d):
    place = table(spark, d, "nation").where("n_regionkey <> 2").join(
        table(spark, d, "region"), c("n_regionkey") == c("r_regionkey"), "left"
    )
    address = F.struct(F.struct(c("n_name").alias("name"), c("r_name").alias("region")).alias("state")).alias("address")
    rows = table(spark, d, "customer").join(place.select("n_nationkey", address), c("c_nationkey") == c("n_nationkey"), "left")
    return rows.select(
        "c_custkey", nested.path(c("address"), "state", "name").alias("state"), nested.path(c("address"), "state", "region").alias("region")
    )


def _hot(column: str, values, field: str | None = None) -> str:
    items = f"list_transform({column}, lambda x: x.{field})" if field else column
    return ", ".join(f"coalesce(list_contains({items}, '{v}'), false)::bigint as \"{v}\"" for v in values)


@query("n4_payment_methods", f"select l_orderkey, {_hot('payments', fv.PAYMENT_NAMES, 'description')} from {LISTINGS}")
def _(spark, d):
    return encode.with_features(
        listings(spark, d).select("l_orderkey", PAYMENTS), nested.multi_hot(c(PAYMENTS), fv.PAYMENT_NAMES, "description")
    ).drop(PAYMENTS)


VARIATION_MEAN = """case when coalesce(len(variations), 0) = 0 then 0.0 else
 list_sum(list_transform(variations, lambda x: coalesce(x.available_quantity, 0)))::double / len(variations) end"""


@query("n5_n6_variations", f"""
select l_orderkey, l_extendedprice, coalesce(len(variations), 0)::bigint as items_variation, round({VARIATION_MEAN}, 6) as available_quantity_variation,
 round(case when coalesce(len(variations), 0) = 0 then 1.0 else list_sum(list_transform(variations, lambda x: x.price)) / len(variations) end, 6) as price_variation
from {LISTINGS}""")
def _(spark, d):
    v = c("variations")
    return listings(spark, d).select(
        "l_orderkey", "l_extendedprice", nested.size_or_zero(v).alias("items_variation"),
        nested.mean_of_field(v, "available_quantity").alias("available_quantity_variation"),
        nested.mean_of_field(v, "price", empty_value=1.0).alias("price_variation"),
    )


@query("n7_tags", f"select l_orderkey, {_hot('tags', fv.TAG_NAMES)}, (coalesce(len(tags), 0) = 0)::bigint as sin_tag from {LISTINGS}")
def _(spark, d):
    return listings(spark, d).select(
        "l_orderkey", *[x.alias(n) for n, x in nested.multi_hot(c("tags"), fv.TAG_NAMES).items()], nested.no_elements(c("tags")).alias("sin_tag")
    )


@query("n8_element_counts", f"select element, count(*)::bigint as count from (select unnest(tags) as element from {LISTINGS}) group by 1")
def _(spark, d):
    return npf.element_counts(listings(spark, d), "tags")


@query("n9_empty_count", f"select count_if(len(tags) = 0)::bigint as empty_rows from {LISTINGS}")
def _(spark, d):
    return npf.empty_count(listings(spark, d), "tags")


@query("n10_key_population", f"""
with v as (select unnest(['local_pick_up', 'free_shipping', 'mode']) as key,
  unnest([shipping.local_pick_up::varchar, shipping.free_shipping::varchar, shipping.mode]) as value from {LISTINGS})
select key, count_if(value is not null and value <> '')::bigint as rows_with_content,
 array_to_string(list_sort(list(distinct value) filter (value is not null and value <> '')), '|') as examples from v group by 1""")
def _(spark, d):
    return npf.key_population(listings(spark, d), "shipping").withColumn("examples", F.array_join("examples", "|"))


PAYMENT_ITEMS = f"(select unnest(payments) as x, condition from {LISTINGS})"


@query("n11_tuple_counts", f"select x.id as id, x.description as description, x.type as type, count(*)::bigint as count from {PAYMENT_ITEMS} group by 1, 2, 3 order by 4 desc, 1, 2, 3 limit 10")
def _(spark, d):
    return npf.tuple_counts(listings(spark, d), PAYMENTS, ["id", "description", "type"], 10)


@query("n11_tuple_totals", f"select count(*)::bigint as items, count(distinct x)::bigint as distinct_items from {PAYMENT_ITEMS}")
def _(spark, d):
    return npf.tuple_totals(listings(spark, d), PAYMENTS, ["id", "description", "type"])


@query("n12_nonempty_by_class", f"select condition, count(*)::bigint as count from {LISTINGS} where len(variations) > 0 group by 1")
def _(spark, d):
    return npf.nonempty_by_class(listings(spark, d), "variations", "condition")


VARIATION_ITEMS = f"(select unnest(variations).available_quantity as v from {LISTINGS} where condition = 'used')"


@query("n13_element_stats", f"select count(v)::bigint as items, round(avg(v), 6) as mean, min(v)::bigint as min, max(v)::bigint as max from {VARIATION_ITEMS}")
def _(spark, d):
    return npf.element_stats(listings(spark, d), "variations", "available_quantity", "condition", "used")


@query("n13_element_distribution", f"select v::bigint as value, count(*)::bigint as count from {VARIATION_ITEMS} where v is not null group by 1")
def _(spark, d):
    return npf.element_distribution(listings(spark, d), "variations", "available_quantity", "condition", "used")


@query("n14_element_class_counts", f"""
select element, condition, count(*)::bigint as count from (select condition,
 unnest(case when len(tags) = 0 then [null] else tags end) as element from {LISTINGS} where tags is not null) group by 1, 2""")
def _(spark, d):
    return npf.element_class_counts(listings(spark, d), "tags", "condition")


# ---- encodings ----
SEGMENTS = ["AUTOMOBILE", "BUILDING", "MACHINERY", "ABSENT"]


@query("e1_one_hot", "select c_custkey, " + ", ".join(f"(coalesce(c_mktsegment, '') = '{s}')::bigint as \"{s}\"" for s in SEGMENTS) + " from customer")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", *[x.alias(n) for n, x in encode.one_hot(c("c_mktsegment"), SEGMENTS).items()])


@query("e2_is_present", f"select doc_id, (quality is not null)::bigint as labelled from {DOC_OUTER}")
def _(spark, d):
    return doc_outer(spark, d).select("doc_id", encode.is_present(c("quality")).alias("labelled"))


@query("e3_bool_null_kept", f"select doc_id, (quality = 1)::bigint as good from {DOC_OUTER}")
def _(spark, d):
    return encode.bools_to_int(doc_outer(spark, d).select("doc_id", (c("quality") == 1).alias("good")))


@query("e4_membership_pair", f"""
select l_orderkey, coalesce(warranty_category in ('Sin garantía', 'Garantía de autenticidad / descripción', 'Garantía basada en reputación del vendedor'), false)::bigint as sin_garantia,
 (not coalesce(warranty_category in ('Sin garantía', 'Garantía de autenticidad / descripción', 'Garantía basada en reputación del vendedor'), false))::bigint as garantia_especifica from {LISTINGS}""")
def _(spark, d):
    without, specific = encode.membership_pair(c("warranty_category"), fv.NO_WARRANTY_LABELS)
    return listings(spark, d).select("l_orderkey", without.alias("sin_garantia"), specific.alias("garantia_especifica"))


@query("e5_label_codes", """
select o_orderkey, dense_rank() over (order by o_orderstatus)::bigint - 1 as code, o_orderstatus as decoded from orders""")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    codes = counts.code_table(rows, "o_orderstatus")
    coded = rows.join(codes, "o_orderstatus").select("o_orderkey", "code")
    return coded.join(codes, "code").select("o_orderkey", "code", c("o_orderstatus").alias("decoded"))


TOP = ["NATION_3", "NATION_1", "NATION_7", "NATION_20"]


@query("e6_top_list_dummies", """
select c_custkey, (n_name = 'NATION_20')::bigint as g_NATION_20, (n_name = 'NATION_3')::bigint as g_NATION_3, (n_name = 'NATION_7')::bigint as g_NATION_7,
 (n_name not in ('NATION_3', 'NATION_1', 'NATION_7', 'NATION_20'))::bigint as g_Otros from customer join nation on c_nationkey = n_nationkey""")
def _(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), c("c_nationkey") == c("n_nationkey"))
    grouped = encode.keep_or_other(c("n_name"), TOP)
    return rows.select("c_custkey", *[x.alias(n) for n, x in encode.dummies(grouped, [*TOP, "Otros"], "g").items()])


@query("e7_top_list_by_share", """
select n_name from (select n_name, sum(n) over (order by n desc, n_name)::double / sum(n) over () as s
 from (select n_name, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1)) where s <= 0.98""")
def _(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), c("c_nationkey") == c("n_nationkey"))
    shares = ordering.running_share(counts.value_counts(rows, "n_name"), "count", [F.desc("count"), F.asc("n_name")])
    return shares.where(c("cum_share") <= 0.98).select("n_name")


@query("e8_cut_right", """
select o_orderkey, case when o_totalprice between 0 and 50000 then 'low' when o_totalprice > 50000 and o_totalprice <= 200000 then 'mid'
 when o_totalprice > 200000 and o_totalprice <= 400000 then 'high' end as band from orders""")
def _(spark, d):
    band = encode.cut_right(c("o_totalprice"), [0, 50000, 200000, 400000], ["low", "mid", "high"])
    return table(spark, d, "orders").select("o_orderkey", band.alias("band"))


def _features_sql(mode: str) -> str:
    hot = lambda col, values: ", ".join(f"(coalesce({col}, '') = '{v}')::bigint as \"{v}\"" for v in values)
    no_warranty = ", ".join(f"'{v}'" for v in fv.NO_WARRANTY_LABELS)
    states = sorted([*fv.TOP_STATES, "Otros"])[1:]
    top = ", ".join(f"'{s}'" for s in fv.TOP_STATES)
    grouped = f"(case when state_name in ({top}) then state_name else 'Otros' end)"
    label = "case condition when 'new' then 0 when 'used' then 1 end::bigint as condition, " if mode == "training" else ""
    return f"""
select l_orderkey, price, automatic_relist::bigint as automatic_relist, initial_quantity, {label}sold_quantity, title,
 shipping.local_pick_up::bigint as local_pick_up, shipping.free_shipping::bigint as free_shipping,
 {_hot('payments', fv.PAYMENT_NAMES, 'description')},
 coalesce(len(variations), 0)::bigint as items_variation, round({VARIATION_MEAN}, 6) as available_quantity_variation,
 {hot('listing_type_id', fv.LISTING_TYPES)}, {hot('buying_mode', fv.BUYING_MODES)},
 {_hot('tags', fv.TAG_NAMES)}, (coalesce(len(tags), 0) = 0)::bigint as sin_tag,
 (official_store_id is not null)::bigint as is_official_store, {hot('shipping.mode', fv.SHIPPING_MODES)},
 coalesce(warranty_category in ({no_warranty}), false)::bigint as sin_garantia,
 (not coalesce(warranty_category in ({no_warranty}), false))::bigint as garantia_especifica,
 {", ".join(f"({grouped} = '{s}')::bigint as \"state_grouped_{s}\"" for s in states)}
from {LISTINGS}"""


@query("e10_training_features", _features_sql("training"))
def _(spark, d):
    return listing_features(listings(spark, d), "training", keep=["l_orderkey"])


@query("e11_test_features", _features_sql("test"))
def _(spark, d):
    return listing_features(listings(spark, d).drop("condition"), "Test ", keep=["l_orderkey"])
