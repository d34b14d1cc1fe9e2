"""Scans, splits, projections, counts, order and set operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from listlens.bindings.registry import query
from listlens.bindings.tables import (
    DOC_LABELS, DOC_OUTER, LISTINGS, TITLES, doc_labels, doc_outer, listings, table, title_rows, words_sql,
)
from listlens.functions import encode, text as tx
from listlens.operators import counts, distribution, ordering, sets
from listlens.session import shared_folder
from listlens.sources import files

c = F.col


# ---- sources and splits ----
@query("s2_scan_pushdown", """
select l_orderkey, l_linenumber::bigint as l_linenumber, l_quantity, l_returnflag from lineitem where l_quantity > 45 and l_returnflag = 'R'""")
def _(spark, d):
    rows = files.read_parquet(spark, f"{d}/lineitem.parquet")
    return rows.where((c("l_quantity") > 45) & (c("l_returnflag") == "R")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )


@query("s6_holdout_last", """
with cut as (select min(event_id) as k from (select event_id from events order by event_id desc limit 1000))
select event_type, case when event_id >= k then 'test' else 'train' end as part, count(*)::bigint as rows,
 min(event_id)::bigint as first_id, max(event_id)::bigint as last_id
from events, cut group by 1, 2""")
def _(spark, d):
    train, test = files.holdout_last(table(spark, d, "events"), "event_id", 1000)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("event_type", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query("s7_hide_target", f"select doc_id, lang, source, n_chars from {DOC_LABELS}")
def _(spark, d):
    rows = doc_labels(spark, d).select("doc_id", "lang", "source", "n_chars", "condition")
    return files.hide_target(rows, "condition")[0]


@query("s7_target", f"select condition, count(*)::bigint as rows from {DOC_LABELS} group by 1")
def _(spark, d):
    label = files.hide_target(doc_labels(spark, d), "condition")[1]
    return label.groupBy("condition").agg(F.count(F.lit(1)).alias("rows"))


@query("s8_union_of_keys", """
select o_orderkey as k, o_totalprice as price, null::double as quantity, o_orderstatus as status from orders
union all select l_orderkey, l_extendedprice, l_quantity, null from lineitem""")
def _(spark, d):
    a = table(spark, d, "orders").select(c("o_orderkey").alias("k"), c("o_totalprice").alias("price"), c("o_orderstatus").alias("status"))
    b = table(spark, d, "lineitem").select(c("l_orderkey").alias("k"), c("l_extendedprice").alias("price"), c("l_quantity").alias("quantity"))
    return sets.append_rows(a, b).select("k", "price", "quantity", "status")


@query("s9_stratified_split", f"""
select doc_id, condition, row_number() over (partition by condition order by h, doc_id)
  <= ceil(count(*) over (partition by condition) * cast(0.2 as double)) as is_test
from (select doc_id, condition, ('0x' || substr(md5(cast(doc_id as varchar)), 1, 15))::bigint as h from {DOC_LABELS})""")
def _(spark, d):
    # md5 instead of the default hash, so that SQL can draw the same rows.
    draw = F.conv(F.substring(F.md5(c("doc_id").cast("string")), 1, 15), 16, 10).cast("bigint")
    return files.stratified_split(doc_labels(spark, d).select("doc_id", "condition"), "condition", "doc_id", 0.2, draw)


@query("s9_stratified_split_events", """
select event_type, is_test, count(*)::bigint as rows, sum(event_id)::bigint as id_sum from (
 select event_id, event_type, row_number() over (partition by event_type order by h, event_id)
   <= ceil(count(*) over (partition by event_type) * cast(0.3 as double)) as is_test
 from (select *, ('0x' || substr(md5(cast(event_id as varchar)), 1, 15))::bigint as h from events)) group by 1, 2""")
def _(spark, d):
    draw = F.conv(F.substring(F.md5(c("event_id").cast("string")), 1, 15), 16, 10).cast("bigint")
    split = files.stratified_split(table(spark, d, "events"), "event_type", "event_id", 0.3, draw)
    return split.groupBy("event_type", "is_test").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("id_sum"))


@query("s13_load_train_test", f"""
select lang, label::bigint as label, is_test, count(*)::bigint as rows, sum(n_chars)::bigint as chars from (
 select lang, n_chars, case condition when 'new' then 0 when 'used' then 1 end as label, toxic = 1 as is_test from {DOC_LABELS})
group by 1, 2, 3""")
def _(spark, d):
    rows = doc_labels(spark, d).select("lang", "n_chars", "condition", "toxic")
    features = ["lang", "n_chars", "condition"]
    train, test = files.load_train_test(
        rows.where("toxic = 0").select(features), rows.where("toxic = 1").select(features), "condition", {"new": 0, "used": 1}
    )
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return both.groupBy("lang", c("condition").alias("label"), "is_test").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("chars")
    )


@query("s1_json_lines", "select event_id, event_type, user_id, value from events")
def _(spark, d):
    path = shared_folder(spark)
    rows = table(spark, d, "events").select("event_id", "event_type", "user_id", "value")
    rows.write.json(f"{path}/events")
    return files.read_json_lines(spark, f"{path}/events", rows.schema)


@query("s2_csv_scan", "select doc_id, text, lang, n_chars from documents")
def _(spark, d):
    path = shared_folder(spark)
    rows = table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    files.write_csv(rows, f"{path}/documents")
    return files.read_csv(spark, f"{path}/documents", rows.schema)


@query("s3_parquet_round_trip", "select o_orderkey, o_orderstatus, o_totalprice from orders")
def _(spark, d):
    path = shared_folder(spark)
    files.write_parquet(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), f"{path}/orders")
    return files.read_parquet(spark, f"{path}/orders")


@query("s4_report_sink", """
select 'status' as section, o_orderstatus as key, count(*)::bigint as count from orders group by 2 union all
select 'priority', o_orderpriority, count(*)::bigint from orders group by 2""")
def _(spark, d):
    path, rows = shared_folder(spark), table(spark, d, "orders")
    sections = {
        "status": counts.value_counts(rows, "o_orderstatus").withColumnRenamed("o_orderstatus", "key"),
        "priority": counts.value_counts(rows, "o_orderpriority").withColumnRenamed("o_orderpriority", "key"),
    }
    files.write_report(sections, f"{path}/report")
    parts = [
        files.read_json_lines(spark, f"{path}/report/{name}", df.schema).select(F.lit(name).alias("section"), "key", "count")
        for name, df in sections.items()
    ]
    return parts[0].unionByName(parts[1])


# ---- projections and filters ----
@query("p1_p2_project_drop", "select l_orderkey, l_linenumber::bigint as l_linenumber, l_shipdate from lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_tax").drop("l_tax", "absent")


@query("p3_p6_masks", "select l_orderkey, l_linenumber::bigint as l_linenumber, l_discount from lineitem where l_returnflag = 'A' and l_discount > 0.05")
def _(spark, d):
    return table(spark, d, "lineitem").where((c("l_returnflag") == "A") & (c("l_discount") > 0.05)).select(
        "l_orderkey", "l_linenumber", "l_discount"
    )


@query("p4_not_equal_keeps_null", f"select doc_id, quality::bigint as quality from {DOC_OUTER} where quality is null or quality <> 0")
def _(spark, d):
    return doc_outer(spark, d).where(encode.differs(c("quality"), 0)).select("doc_id", "quality")


@query("p5_null_handling", f"""
select lang, count(*)::bigint as rows, count(quality)::bigint as known, sum(coalesce(quality, 0))::bigint as filled from {DOC_OUTER} group by 1""")
def _(spark, d):
    return doc_outer(spark, d).groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"), F.count("quality").alias("known"),
        F.sum(F.coalesce("quality", F.lit(0))).alias("filled"),
    )


@query("p7_keep_or_other", """
select c_custkey, case when n_name in ('NATION_1', 'NATION_5', 'NATION_7') then n_name else 'Otros' end as grouped
from customer left join nation on c_nationkey = n_nationkey""")
def _(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), c("c_nationkey") == c("n_nationkey"), "left")
    return rows.select("c_custkey", encode.keep_or_other(c("n_name"), ["NATION_1", "NATION_5", "NATION_7"]).alias("grouped"))


@query("p8_remap", """
select o_orderkey, case o_orderstatus when 'F' then 'final' when 'O' then 'open' else o_orderstatus end as status from orders""")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", encode.remap(c("o_orderstatus"), {"F": "final", "O": "open"}).alias("status"))


@query("p9_slice", "select o_orderkey, o_totalprice from orders order by o_orderkey limit 10 offset 1000")
def _(spark, d):
    return ordering.slice_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [c("o_orderkey")], 1000, 1010)


@query("p10_first_where", "select o_orderkey, o_totalprice from orders where o_totalprice > 400000 order by o_orderkey limit 1")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ordering.first_where(rows, c("o_totalprice") > 400000, [c("o_orderkey")])


@query("p11_side_by_side", """
select c_custkey, c_acctbal, (c_acctbal < 0)::bigint as in_debt, length(c_name)::bigint as name_length from customer""")
def _(spark, d):
    return encode.with_features(
        table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_name"),
        {"in_debt": (c("c_acctbal") < 0).cast("int"), "name_length": F.length("c_name")},
    ).drop("c_name")


@query("p12_bools_to_int", """
select l_orderkey, l_linenumber::bigint as l_linenumber, (l_linestatus = 'O')::bigint as is_open, (l_discount > 0)::bigint as discounted from lineitem""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (c("l_linestatus") == "O").alias("is_open"), (c("l_discount") > 0).alias("discounted")
    )
    return encode.bools_to_int(rows)


# ---- joins ----
@query("j1_merge_counts", f"""
select word, count_if(condition = 'new')::bigint as n_new, count_if(condition = 'used')::bigint as n_used
from {words_sql(DOC_LABELS, 'text')} group by 1""")
def _(spark, d):
    words = doc_labels(spark, d).select("condition", F.explode(tx.tokens(c("text"))).alias("word"))
    return counts.merge_counts(words, "word", "condition")


@query("j1_merge_count_tables", """
select brand, coalesce(a, 0)::bigint as left_count, coalesce(b, 0)::bigint as right_count from
 (select p_brand as brand, count(*) as a from part where p_size < 5 group by 1) full join
 (select p_brand as brand, count(*) as b from part where p_retailprice > 1000 group by 1) using (brand)""")
def _(spark, d):
    part = table(spark, d, "part").withColumnRenamed("p_brand", "brand")
    return counts.merge_count_tables(
        counts.value_counts(part.where("p_size < 5"), "brand"), counts.value_counts(part.where("p_retailprice > 1000"), "brand"), "brand"
    )


@query("j3_attach_label", "select d.doc_id, n_chars, quality::bigint as quality from documents d join labels l on d.doc_id = l.doc_id")
def _(spark, d):
    return sets.attach_label(
        table(spark, d, "documents").select("doc_id", "n_chars"), table(spark, d, "labels").select("doc_id", "quality"), "doc_id"
    )


# ---- aggregations ----
@query("a1_value_counts", "select event_type, count(*)::bigint as count from events where event_type is not null group by 1")
def _(spark, d):
    return counts.value_counts(table(spark, d, "events"), "event_type")


@query("a2_shares", """
select event_type, count(*)::bigint as count, round(count(*)::double / sum(count(*)) over (), 6) as share,
 round(count(*)::double / sum(count(*)) over () * 100, 6) as percent from events group by 1""")
def _(spark, d):
    return counts.shares(table(spark, d, "events"), "event_type")


@query("a3_cross_counts", """
select o_orderpriority, count_if(o_orderstatus = 'F')::bigint as "F", count_if(o_orderstatus = 'O')::bigint as "O",
 count_if(o_orderstatus = 'P')::bigint as "P", count_if(o_orderstatus = 'X')::bigint as "X" from orders group by 1""")
def _(spark, d):
    return counts.cross_counts(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P", "X"])


@query("a4_pivot_non_null", f"""
select condition, count_if(automatic_relist and official_store_id is not null)::bigint as "true",
 count_if(not automatic_relist and official_store_id is not null)::bigint as "false" from {LISTINGS} group by 1""")
def _(spark, d):
    return counts.pivot_non_null(listings(spark, d), "condition", "automatic_relist", "official_store_id", [True, False])


@query("a5_distinct_values", f"select distinct quality::bigint as quality from {DOC_OUTER}")
def _(spark, d):
    return counts.distinct_values(doc_outer(spark, d), "quality")


@query("a5_distinct_counts", """
select 'p_brand' as "column", count(distinct p_brand)::bigint as "distinct" from part union all
select 'p_type', count(distinct p_type)::bigint from part union all
select 'p_size', count(distinct p_size)::bigint from part union all
select 'p_retailprice', count(distinct p_retailprice)::bigint from part""")
def _(spark, d):
    return counts.distinct_counts(table(spark, d, "part"), ["p_brand", "p_type", "p_size", "p_retailprice"])


@query("a6_describe", """
select round(avg(o_totalprice), 4) as mean, (select o_totalprice from orders group by 1 order by count(*) desc, 1 limit 1) as mode,
 min(o_totalprice) as min, max(o_totalprice) as max, round(quantile_cont(o_totalprice, 0.25), 4) as q1,
 round(quantile_cont(o_totalprice, 0.5), 4) as q2, round(quantile_cont(o_totalprice, 0.75), 4) as q3 from orders""", 4)
def _(spark, d):
    return distribution.describe_numeric(table(spark, d, "orders"), "o_totalprice", 4)


@query("a6_quantiles_by_class", """
select l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) as q0, round(quantile_cont(l_extendedprice, 0.5), 4) as q1,
 round(quantile_cont(l_extendedprice, 0.99), 4) as q2 from lineitem group by 1""", 4)
def _(spark, d):
    return distribution.exact_quantiles(table(spark, d, "lineitem"), "l_extendedprice", [0.25, 0.5, 0.99], ["l_returnflag"])


@query("a7_histogram", """
with q as (select quantile_cont(o_totalprice, 0.99) as top from orders),
 kept as (select o_totalprice as v from orders, q where o_totalprice <= top),
 e as (select min(v) as lo, max(v) as hi, (max(v) - min(v)) / 50 as w from kept)
select least(floor((v - lo) / w), 49)::bigint as bin, round(max(lo) + least(floor((v - lo) / w), 49) * max(w), 4) as lower,
 round(max(lo) + (least(floor((v - lo) / w), 49) + 1) * max(w), 4) as upper, count(*)::bigint as count
from kept, e group by least(floor((v - lo) / w), 49)""", 4)
def _(spark, d):
    return distribution.histogram(table(spark, d, "orders"), "o_totalprice")


@query("a8_text_stats", f"""
select condition as class, count(*)::bigint as count, round(avg(length(text)), 6) as avg_length, median(length(text)) as median_length,
 round(avg(w), 6) as avg_words, median(w) as median_words, max(length(text))::bigint as max_length, min(length(text))::bigint as min_length
from (select *, len(regexp_extract_all(text, '\\S+')) as w from {DOC_LABELS}) group by 1""")
def _(spark, d):
    return counts.text_stats(doc_labels(spark, d), "text", "condition")


@query("a9_top_values_by_class", """
select l_returnflag, l_quantity, count, place from (select l_returnflag, l_quantity, count(*)::bigint as count,
 row_number() over (partition by l_returnflag order by count(*) desc, l_quantity)::bigint as place from lineitem group by 1, 2) where place <= 10""")
def _(spark, d):
    return counts.top_values_by_class(table(spark, d, "lineitem"), "l_quantity", "l_returnflag", 10)


@query("a10_overview", f"""
select count(*)::bigint as rows, count_if(condition = 'new')::bigint as rows_new, count_if(condition = 'used')::bigint as rows_used,
 min(n_chars)::bigint as min_value, max(n_chars)::bigint as max_value, round(avg(n_chars), 6) as mean_value from {DOC_LABELS}""")
def _(spark, d):
    return counts.overview(doc_labels(spark, d), "n_chars", "condition", ["new", "used"])


@query("a11_variances", """
select 'l_quantity' as feature, round(var_samp(l_quantity), 4) as variance from lineitem union all
select 'l_extendedprice', round(var_samp(l_extendedprice), 4) from lineitem union all
select 'l_discount', round(var_samp(l_discount), 4) from lineitem union all
select 'constant', round(var_samp(1), 4) from lineitem""", 4)
def _(spark, d):
    rows = table(spark, d, "lineitem").withColumn("constant", F.lit(1.0))
    return counts.variances(rows, ["l_quantity", "l_extendedprice", "l_discount", "constant"])


@query("a12_null_counts_by_class", f"select quality is null as is_null, lang, count(*)::bigint as count from {DOC_OUTER} group by 1, 2")
def _(spark, d):
    return counts.null_counts_by_class(doc_outer(spark, d), "quality", "lang")


@query("a13_class_share", f"""
select p_brand, count_if(condition = 'new')::bigint as n_new, count_if(condition = 'used')::bigint as n_used, count(*)::bigint as total,
 round(count_if(condition = 'new')::double / count(*), 6) as ratio_new from {TITLES} group by 1""")
def _(spark, d):
    return counts.class_share(title_rows(spark, d), "p_brand", "condition")


# ---- running shares and order ----
NATION_COUNTS = "(select n_name, count(*) as count from customer join nation on c_nationkey = n_nationkey group by 1)"
RUNNING = f"""(select n_name, count::bigint as count, row_number() over (order by count desc, n_name)::bigint as position,
 round(sum(count) over (order by count desc, n_name)::double / sum(count) over (), 6) as cum_share from {NATION_COUNTS})"""


def _nation_shares(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), c("c_nationkey") == c("n_nationkey"))
    return ordering.running_share(counts.value_counts(rows, "n_name"), "count", [F.desc("count"), F.asc("n_name")])


@query("w1_running_share", f"select n_name, count, position, cum_share from {RUNNING}")
def _(spark, d):
    return _nation_shares(spark, d)


@query("w1_running_share_parts", """
select l_partkey, n::bigint as count, row_number() over (order by n desc, l_partkey)::bigint as position,
 round(sum(n) over (order by n desc, l_partkey)::double / sum(n) over (), 6) as cum_share
from (select l_partkey, count(*) as n from lineitem group by 1)""")
def _(spark, d):
    per_part = counts.value_counts(table(spark, d, "lineitem"), "l_partkey")
    return ordering.running_share(per_part, "count", [F.desc("count"), F.asc("l_partkey")])


@query("w2_first_reaching", f"""
select t as threshold, min(case when cum_share >= t then position end)::bigint as position
from {RUNNING}, (select unnest([0.8, 0.85, 0.9, 0.95, 0.99])::double as t) group by 1""")
def _(spark, d):
    return ordering.first_reaching(_nation_shares(spark, d), [0.80, 0.85, 0.90, 0.95, 0.99])


@query("w3_top_k_per_group", f"""
select condition, word, n::bigint as count, place from (select condition, word, count(*) as n,
 row_number() over (partition by condition order by count(*) desc, word)::bigint as place from {words_sql(TITLES, 'title')} group by 1, 2) where place <= 5""")
def _(spark, d):
    words = title_rows(spark, d).select("condition", F.explode(tx.tokens(c("title"))).alias("word"))
    return ordering.top_k_per_group(words.groupBy("condition", "word").count(), ["condition"], [F.desc("count"), F.asc("word")], 5)


@query("k1_rank_metrics", """
select l_returnflag || l_linestatus as model, round(avg(l_discount), 6) as accuracy, round(avg(l_tax), 6) as recall
from lineitem group by 1 order by 2 desc, 3 desc, 1""")
def _(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("model")).agg(
        F.avg("l_discount").alias("accuracy"), F.avg("l_tax").alias("recall")
    )
    return ordering.rank_metrics(rows, ["accuracy", "recall"])


@query("k2_most_common", f"select word, count(*)::bigint as count from {words_sql(TITLES, 'title')} group by 1 order by 2 desc, 1 limit 20")
def _(spark, d):
    words = title_rows(spark, d).select(F.explode(tx.tokens(c("title"))).alias("word"))
    return ordering.most_common(words.groupBy("word").count(), "word", 20)


@query("k3_n_largest", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 3")
def _(spark, d):
    return ordering.n_largest(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 3, "o_orderkey")


@query("k4_arg_best", """
(select 'max' as how, p_partkey, p_retailprice from part order by p_retailprice desc, p_partkey limit 1) union all
(select 'min', p_partkey, p_retailprice from part order by p_retailprice, p_partkey limit 1)""")
def _(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_retailprice")
    pick = lambda how: ordering.arg_best(rows, "p_retailprice", how, "p_partkey").select(F.lit(how).alias("how"), "*")
    return pick("max").unionByName(pick("min"))


@query("k5_floor_after_top", f"""
select word, count from (select word, count(*)::bigint as count from {words_sql(DOC_LABELS, 'text')} group by 1 order by 2 desc, 1 limit 50) where count >= 120""")
def _(spark, d):
    words = doc_labels(spark, d).select(F.explode(tx.tokens(c("text"))).alias("word"))
    return ordering.most_common(words.groupBy("word").count(), "word", 50, min_count=120)


# ---- set operations ----
@query("o1_union_keys", "select p_brand as key from part union select p_type from part")
def _(spark, d):
    part = table(spark, d, "part")
    return sets.union_keys(part.select(c("p_brand").alias("key")), part.select(c("p_type").alias("key")), "key")


@query("o2_distinct_elements", f"select distinct unnest(tags) as element from {LISTINGS}")
def _(spark, d):
    return sets.distinct_elements(listings(spark, d), "tags")


@query("o3_clean_distinct", "select distinct lower(p_type) as p_type from part where lower(p_type) <> 'promo' and p_type <> ''")
def _(spark, d):
    return sets.clean_distinct(table(spark, d, "part"), "p_type", "promo")


@query("o4_append_rows", """
select part, count(*)::bigint as rows, round(sum(o_totalprice), 2) as total from
 (select 'open' as part, o_totalprice from orders where o_orderstatus = 'O' union all
  select 'rest', o_totalprice from orders where o_orderstatus <> 'O') group by 1""", 2)
def _(spark, d):
    rows = table(spark, d, "orders")
    both = sets.append_rows(
        rows.where("o_orderstatus = 'O'").withColumn("part", F.lit("open")), rows.where("o_orderstatus <> 'O'").withColumn("part", F.lit("rest"))
    )
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_totalprice").alias("total"))
