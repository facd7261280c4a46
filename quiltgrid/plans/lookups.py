"""Queries of the lookup operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiltgrid.operators import lookups as J
from quiltgrid.plans.base import Queries, read, rounded, rounded_sql
from quiltgrid.session import dealt

_q = Queries()
QUERIES, ORACLES = _q.queries, _q.oracles


@_q.add("j1_lookup", """with p as (select p_name, min_by(p_retailprice, p_partkey) as price from part where p_size > 20 group by p_name)
  select p_partkey, coalesce(price, -1) as p_retailprice, price is not null as found from (select p_partkey, p_name, p_size from part) q left join p using (p_name)""")
def j1(spark, d):
    part = read(spark, d, "part")
    return J.lookup(part.select("p_partkey", "p_name"), part.where("p_size > 20").select("p_partkey", "p_name", "p_retailprice"), "p_name", "p_name", "p_retailprice", "p_partkey", -1.0).select("p_partkey", "p_retailprice", "found")


@_q.add("j1_lookup_parts", "select l_partkey, l_orderkey, l_linenumber, p_brand, p_brand is not null as found, count(*) as n from lineitem left join part on l_partkey = p_partkey group by all")
def j1_parts(spark, d):
    items = read(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    # The join and the count both keep rows where their part is; counting all rows reads no column.
    items = dealt(items, items.count(), "l_partkey")
    out = J.lookup(items, read(spark, d, "part"), "l_partkey", "p_partkey", "p_brand", "p_partkey")
    return out.groupBy("l_partkey", "l_orderkey", "l_linenumber", "p_brand", "found").agg(F.count("*").alias("n"))


@_q.add("j1_match_position", "select c_custkey, (select min(o_orderkey) from orders where o_custkey = c_custkey) as position from customer")
def j1_match(spark, d):
    return J.match_position(read(spark, d, "customer").select("c_custkey"), read(spark, d, "orders"), "c_custkey", "o_custkey", "o_orderkey")


@_q.add("j1_header_lookup", "select c_custkey, c_mktsegment as value from customer")
def j1_header(spark, d):
    return J.header_lookup(read(spark, d, "customer"), "c_custkey", ["c_name", "c_mktsegment"], "C_MKTSEGMENT")


@_q.add("j2_lookup_approx", """with v as (select user_id, ts, max(event_id) as event_id from events where event_type = 'view' group by all)
  select e.event_id, v.event_id as view_id from (select * from events where event_type = 'purchase') e asof left join v on e.user_id = v.user_id and e.ts >= v.ts""")
def j2(spark, d):
    events = read(spark, d, "events")
    views = events.where("event_type = 'view'").groupBy("user_id", F.col("ts").alias("view_ts")).agg(F.max("event_id").alias("view_id"))
    bought = events.where("event_type = 'purchase'").select("user_id", "event_id", "ts")
    return J.lookup_approx(bought, views, ["user_id"], "ts", "view_ts", ["view_id"]).select("event_id", "view_id")


@_q.add("j2_next_larger", """select o.o_orderkey, (select min(n.o_totalprice) from orders n where n.o_custkey = o.o_custkey and n.o_orderstatus = 'O' and n.o_totalprice >= o.o_totalprice) as next_price from orders o where o.o_orderstatus = 'F'""")
def j2_next(spark, d):
    orders = read(spark, d, "orders")
    larger = orders.where("o_orderstatus = 'O'").select("o_custkey", F.col("o_totalprice").alias("next_price"))
    return J.lookup_approx(orders.where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_totalprice"), larger, ["o_custkey"], "o_totalprice", "next_price", [], next_larger=True).select("o_orderkey", "next_price")


@_q.add("j2_lookup_bins", "select o_orderkey, case when o_totalprice >= 300000 then 'A' when o_totalprice >= 100000 then 'B' when o_totalprice >= 0 then 'C' end as grade from orders")
def j2_bins(spark, d):
    return J.lookup_bins(read(spark, d, "orders").select("o_orderkey", "o_totalprice"), [(0, "C"), (100000, "B"), (300000, "A")], "o_totalprice", "grade").select("o_orderkey", "grade")


@_q.add("j3_lookup_wildcard", """select pattern, (select p_partkey from part where p_name ilike l order by p_partkey limit 1) as p_partkey from (values ('*ring', '%ring'), ('red *', 'red %'), ('?mall*', '_mall%'), ('zz*', 'zz%')) t(pattern, l)""")
def j3(spark, d):
    return J.lookup_wildcard(["*ring", "red *", "?mall*", "zz*"], read(spark, d, "part").withColumn("pos", F.col("p_partkey")), "p_name", "pos", "p_partkey")


@_q.add("j3_pattern_table", """with p as (select distinct left(p_name, 4) || '*' || right(p_name, 2) as pattern, lower(left(p_name, 4)) || '%' || lower(right(p_name, 2)) as l from part
    union all select distinct '??' || substr(p_name, 3, 3) || '*', '__' || lower(substr(p_name, 3, 3)) || '%' from part union all select '*' || p_type || '*', '%' || lower(p_type) || '%' from part group by p_type)
  select pattern, min(p_partkey) as p_partkey from p left join part on lower(p_name) like l group by pattern""")
def j3_table(spark, d):
    part = read(spark, d, "part").select("p_partkey", "p_name", "p_type")
    ends = F.concat(F.left("p_name", F.lit(4)), F.lit("*"), F.right("p_name", F.lit(2)))
    inside = F.concat(F.lit("??"), F.substring("p_name", 3, 3), F.lit("*"))
    patterns = part.select(F.explode(F.array(ends, inside, F.concat(F.lit("*"), "p_type", F.lit("*")))).alias("pattern"))
    return J.lookup_patterns(patterns, part.withColumn("pos", F.col("p_partkey")), "pattern", "p_name", "pos", "p_partkey")


@_q.add("j4_lookup_composite", "select l_orderkey, l_partkey, l_suppkey, min(l_linenumber) as l_linenumber from lineitem group by all")
def j4(spark, d):
    items = read(spark, d, "lineitem").withColumn("pos", F.col("l_linenumber"))
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    return J.lookup_composite(items.select(*keys).distinct(), items, keys, "l_linenumber", "pos")


@_q.add("j5_lookup_two_way", "select l_returnflag, l_linestatus, sum(l_quantity) as cell from lineitem group by all")
def j5(spark, d):
    items = read(spark, d, "lineitem")
    cross = items.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.sum("l_quantity"))
    return J.lookup_two_way(items.select("l_returnflag", "l_linestatus").distinct(), cross, "l_returnflag", "l_linestatus", ["F", "O"])


@_q.add("j6_lookup_last", "select user_id, arg_max(event_type, event_id) as last_value, arg_max(event_type, event_id) filter (where event_type <> '') as last_non_blank from (select user_id, event_id, case when event_type = 'error' then '' else event_type end as event_type from events) group by user_id")
def j6(spark, d):
    events = read(spark, d, "events").withColumn("v", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")))
    return J.lookup_last(events, ["user_id"], "v", "event_id")


@_q.add("j7_lookup_all", "select c_custkey, o_orderkey from customer join orders on c_custkey = o_custkey")
def j7(spark, d):
    wanted = read(spark, d, "customer").select("c_custkey")
    return J.lookup_all(wanted, read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), ["c_custkey"])


@_q.add("j8_membership", """select c_custkey, 'both' as kind from customer where c_custkey in (select o_custkey from orders where o_totalprice > 490000) union all
  select c_custkey, 'only' from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 490000)""")
def j8(spark, d):
    customers = read(spark, d, "customer").select("c_custkey")
    big = read(spark, d, "orders").where("o_totalprice > 490000").select(F.col("o_custkey").alias("c_custkey"))
    both, only = J.in_both(customers, big, ["c_custkey"]), J.not_in(customers, big, ["c_custkey"])
    return both.withColumn("kind", F.lit("both")).unionByName(only.withColumn("kind", F.lit("only")))


@_q.add("j8_flag_and_union", "select nk, nk in (select s_nationkey from supplier) as is_in from (select c_nationkey as nk from customer union select s_nationkey from supplier)")
def j8_flag(spark, d):
    a = read(spark, d, "customer").select(F.col("c_nationkey").alias("nk"))
    b = read(spark, d, "supplier").select(F.col("s_nationkey").alias("nk"))
    return J.flag_in(J.combine_lists(a, b), b, "nk")


@_q.add("j9_db_aggregate", rounded_sql("""with k as (select * from orders where (o_orderstatus ilike 'f' and o_totalprice > 200000) or (o_orderpriority ilike '1-%' and o_totalprice <= 50000))
  select (sum(o_totalprice))::double as dsum, round((sum(o_totalprice))::double / count(*), 4) as daverage, count(o_totalprice) as dcount, min(o_totalprice) as dmin, max(o_totalprice) as dmax, null::double as dget from k""", "dsum"))
def j9(spark, d):
    criteria = [{"o_orderstatus": "F", "o_totalprice": ">200000"}, {"o_orderpriority": "1-*", "o_totalprice": "<=50000"}]
    return J.db_aggregate(read(spark, d, "orders"), criteria, "O_TOTALPRICE").withColumns({"dsum": F.round("dsum", 2), "daverage": F.round("daverage", 4)})


@_q.add("j10_bracket_sum", "select o_orderkey, round(greatest(o_totalprice - 0, 0) * 0.1 + greatest(o_totalprice - 100000, 0) * 0.1 + greatest(o_totalprice - 300000, 0) * 0.15, 5) as tax from orders")
def j10(spark, d):
    return J.bracket_sum(read(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", [(0, 0.1), (100000, 0.2), (300000, 0.35)], "tax").select("o_orderkey", F.round("tax", 5).alias("tax"))


YEARS = range(1992, 1999)


@_q.add("j11_cross_table", rounded_sql(f"""select o_orderpriority, sum(o_totalprice) as total, {', '.join(f"coalesce(sum(o_totalprice) filter (where year(o_orderdate) = {y}), 0) as from_y{y}" for y in YEARS)},
  coalesce(sum(o_totalprice) filter (where year(o_orderdate) not between 1992 and 1998), 0) as from_other from orders group by o_orderpriority""", "total", "from_other", *(f"from_y{y}" for y in YEARS)))
def j11(spark, d):
    orders = read(spark, d, "orders")
    tables = {f"y{y}": orders.where(F.year("o_orderdate") == y) for y in YEARS} | {"other": orders.where(~F.year("o_orderdate").isin(*YEARS))}
    out = J.cross_table_agg(tables, ["o_orderpriority"], "o_totalprice")
    return rounded(out, "total", *(f"from_{n}" for n in tables), digits=2)
