"""Queries of the window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiltgrid.operators import windows as W
from quiltgrid.plans.base import Queries, read, rounded_sql

_q = Queries()
QUERIES, ORACLES = _q.queries, _q.oracles


@_q.add("w1_rank_rows", """select o_orderkey, rank() over (partition by o_custkey order by o_orderpriority desc) as rank_eq,
  rank() over (partition by o_custkey order by o_orderpriority desc) + (count(*) over (partition by o_custkey, o_orderpriority) - 1) / 2.0::double as rank_avg,
  row_number() over (partition by o_custkey order by o_orderpriority desc, o_orderkey) as rank_unique from orders""")
def w1(spark, d):
    return W.rank_rows(read(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey").select("o_orderkey", "rank_eq", "rank_avg", "rank_unique")


@_q.add("w2_percent_rank", """with r as (select p_partkey, rank() over (partition by p_brand order by p_retailprice) - 1 as b, count(*) over (partition by p_brand) as n from part)
  select p_partkey, case when n > 1 then floor(b / (n - 1) * 1000 + 1e-9) / 1000 else 1.0 end::double as rank_inc, (floor((b + 1) / (n + 1) * 1000 + 1e-9) / 1000)::double as rank_exc from r""")
def w2(spark, d):
    return W.percent_rank_at(read(spark, d, "part"), ["p_brand"], "p_retailprice").select("p_partkey", "rank_inc", "rank_exc")


@_q.add("w2_percent_rank_of", """with g as (select p_brand, max(p_size) filter (where p_size <= 20.5) as l, min(p_size) filter (where p_size >= 20.5) as h, count(*) filter (where p_size <= 20.5) as c, count(*) as n from part group by p_brand)
  select p_brand, (floor((c - 1 + (20.5 - l) / (h - l)) / (n - 1) * 1000 + 1e-9) / 1000)::double as percent_rank from g""")
def w2_of(spark, d):
    return W.percent_rank_of(read(spark, d, "part"), ["p_brand"], "p_size", 20.5)


@_q.add("w3_running", rounded_sql("""select event_id, (sum(value) over w)::double as running_sum, count(*) over (partition by user_id, value order by event_id rows unbounded preceding) as running_count,
  max(value) over w as running_max, round((sum(value) over w)::double / (sum(value) over (partition by user_id))::double, 6) as running_share
  from events window w as (partition by user_id order by event_id rows unbounded preceding)""", "running_sum"))
def w3(spark, d):
    return W.running(read(spark, d, "events"), ["user_id"], "value", "event_id").select("event_id", F.round("running_sum", 2).alias("running_sum"), "running_count", "running_max", F.round("running_share", 6).alias("running_share"))


@_q.add("w3_scan", """select o_orderkey, max(floor(o_totalprice / 1000)::bigint) over (partition by o_custkey order by o_orderkey rows unbounded preceding) as scan from orders""")
def w3_scan(spark, d):
    orders = read(spark, d, "orders").withColumn("k", F.floor(F.col("o_totalprice") / 1000))
    return W.scan(orders, ["o_custkey"], "o_orderkey", F.col("k"), "max").select("o_orderkey", "scan")


@_q.add("w4_row_change", """select event_id, round(value - lag(value) over w, 4) as difference, round((value - lag(value) over w) / nullif(lag(value) over w, 0), 4) as change from events window w as (partition by user_id order by event_id)""")
def w4(spark, d):
    return W.row_change(read(spark, d, "events"), ["user_id"], "value", "event_id").select("event_id", F.round("difference", 4).alias("difference"), F.round("change", 4).alias("change"))


@_q.add("w5_fill_down", """select event_id, last_value(case when event_type = 'purchase' then value::varchar end ignore nulls) over (partition by user_id order by event_id rows unbounded preceding) as filled from events""")
def w5(spark, d):
    events = read(spark, d, "events").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value").cast("string")).otherwise(""))
    return W.fill_down(events, ["user_id"], "v", "event_id").select("event_id", "filled")


@_q.add("w6_normalize", """select p_partkey, round((p_retailprice - avg(p_retailprice) over g) / stddev_pop(p_retailprice) over g, 6) as z_score,
  round((p_retailprice - min(p_retailprice) over g) / (max(p_retailprice) over g - min(p_retailprice) over g), 6) as scaled from part window g as (partition by p_brand)""")
def w6(spark, d):
    return W.normalize(read(spark, d, "part"), ["p_brand"], "p_retailprice").select("p_partkey", F.round("z_score", 6).alias("z_score"), F.round("scaled", 6).alias("scaled"))


@_q.add("w7_share_of_total", """select o_orderkey, round(o_totalprice / (sum(o_totalprice) over (partition by o_custkey))::double, 6) as share,
  round((sum(o_totalprice) over (partition by o_custkey order by o_orderkey rows unbounded preceding))::double / (sum(o_totalprice) over (partition by o_custkey))::double, 6) as cumulative_share from orders""")
def w7(spark, d):
    return W.share_of_total(read(spark, d, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey").select("o_orderkey", F.round("share", 6).alias("share"), F.round("cumulative_share", 6).alias("cumulative_share"))


@_q.add("w8_last_n", rounded_sql("""with r as (select *, row_number() over (partition by user_id order by event_id) as k, row_number() over (partition by user_id order by event_id desc) as b from events)
  select user_id, round((sum(value) filter (where b <= 3))::double / count(*) filter (where b <= 3), 4) as last_mean, (sum(value) filter (where (k - 1) % 3 = 0))::double as every_sum from r group by user_id""", "every_sum"))
def w8(spark, d):
    return W.last_n_agg(read(spark, d, "events"), ["user_id"], "value", "event_id", 3, 3).withColumns({"last_mean": F.round("last_mean", 4), "every_sum": F.round("every_sum", 2)})


@_q.add("w9_flag_duplicates", "select doc_id, count(*) over (partition by text) > 1 as is_duplicate, min(doc_id) over (partition by text) as first_pos from documents")
def w9(spark, d):
    # Texts are compared by a strong digest, so that only digests are moved.
    docs = read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return W.flag_duplicates(docs, "h", "doc_id").select("doc_id", "is_duplicate", "first_pos")


@_q.add("w9_position_of_max", "select o_custkey, max(o_totalprice) as max_value, (list(o_orderkey order by o_totalprice desc, o_orderkey))[1] as max_pos from orders group by o_custkey")
def w9_max(spark, d):
    return W.position_of_max(read(spark, d, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey")


@_q.add("w10_top_n", rounded_sql("""with r as (select o_custkey, o_orderkey, o_totalprice, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as place from orders)
  select o_custkey, o_orderkey, place, (sum(o_totalprice) over g)::double as top_sum, round((sum(o_totalprice) over g)::double / count(*) over g, 4) as top_mean from r where place <= 3 window g as (partition by o_custkey)""", "top_sum"))
def w10(spark, d):
    return W.top_n(read(spark, d, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey", 3).select("o_custkey", "o_orderkey", "place", F.round("top_sum", 2).alias("top_sum"), F.round("top_mean", 4).alias("top_mean"))
