"""Queries of the table operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiltgrid.operators import tables as T
from quiltgrid.plans.base import Queries, read, rounded, rounded_sql

_q = Queries()
QUERIES, ORACLES = _q.queries, _q.oracles


@_q.add("t1_unique_rows", "select o_orderpriority, o_orderstatus, min(o_orderkey) as first_pos, count(*) as n from orders group by all")
def t1(spark, d):
    return T.unique_rows(read(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"], "o_orderkey")


@_q.add("t1_exactly_once", "select o_custkey, o_orderpriority, min(o_orderkey) as first_pos, count(*) as n from orders group by all having count(*) = 1")
def t1_once(spark, d):
    return T.unique_rows(read(spark, d, "orders"), ["o_custkey", "o_orderpriority"], "o_orderkey", exactly_once=True)


@_q.add("t2_sort_table", "select o_orderkey, row_number() over (order by o_orderpriority, o_totalprice desc, o_orderkey) as place from orders")
def t2(spark, d):
    orders = T.sort_table(read(spark, d, "orders"), [("o_orderpriority", 1), ("o_totalprice", -1)], "o_orderkey")
    return T.numbered(orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey"], "place").select("o_orderkey", "place")


@_q.add("t3_to_column", """select s_suppkey as row_pos, c as column_no, case c when 0 then s_name when 1 then s_nationkey::varchar end as value from supplier, (values (0), (1)) t(c)""")
def t3(spark, d):
    return T.to_column(read(spark, d, "supplier"), ["s_name", "s_nationkey"], "s_suppkey")


@_q.add("t3_wrap_rows", "select c_custkey // 3 as row_no, max(c_name) filter (where c_custkey % 3 = 0) as c0, max(c_name) filter (where c_custkey % 3 = 1) as c1, max(c_name) filter (where c_custkey % 3 = 2) as c2 from customer group by 1")
def t3_wrap(spark, d):
    return T.wrap_rows(read(spark, d, "customer"), "c_name", F.col("c_custkey"), 3)


@_q.add("t3_wrap_columns", """select n_nationkey % 5 as row_no, max(n_name) filter (where n_nationkey // 5 = 0) as c0, max(n_name) filter (where n_nationkey // 5 = 1) as c1, max(n_name) filter (where n_nationkey // 5 = 2) as c2,
  max(n_name) filter (where n_nationkey // 5 = 3) as c3, max(n_name) filter (where n_nationkey // 5 = 4) as c4 from nation group by 1""")
def t3_wrap_columns(spark, d):
    return T.wrap_columns(read(spark, d, "nation"), "n_name", F.col("n_nationkey"), 5, 5)


@_q.add("t1_unique_columns", "select n_nationkey, n_name, n_regionkey from nation")
def t1_columns(spark, d):
    nation = read(spark, d, "nation").withColumns({"twin": F.col("n_name"), "region_again": F.col("n_regionkey")})
    return nation.select("n_nationkey", *T.unique_columns(nation, ["n_name", "n_regionkey", "twin", "region_again"]))


@_q.add("t3_split_text", r"""with r as (select doc_id, string_split(text, chr(10)) as rs from documents), r1 as (select doc_id, unnest(range(0, len(rs))) as row_no, rs from r),
  c as (select doc_id, row_no, list_filter(string_split(rs[row_no + 1], '.'), lambda x: x <> '') as cs from r1), c1 as (select doc_id, row_no, unnest(range(0, len(cs))) as column_no, cs from c)
  select doc_id, row_no, column_no, md5(cs[column_no + 1]) as cell from c1""")
def t3_split(spark, d):
    return T.split_text(read(spark, d, "documents"), "doc_id", "text", "\n", ".", skip_empty=True).withColumn("cell", F.md5("cell"))


@_q.add("t4_vstack", "select o_orderkey, o_totalprice, null as o_custkey from orders where o_orderstatus = 'F' union all select o_orderkey, null, o_custkey from orders where o_orderstatus <> 'F'")
def t4(spark, d):
    orders = read(spark, d, "orders")
    return T.vstack(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey"))


@_q.add("t4_hstack", "select c_custkey as place, c_name, s_name from customer full join supplier on c_custkey = s_suppkey")
def t4_h(spark, d):
    return T.hstack(read(spark, d, "customer").select(F.col("c_custkey").alias("place"), "c_name"), read(spark, d, "supplier").select(F.col("s_suppkey").alias("place"), "s_name"), "place")


@_q.add("t5_take", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def t5(spark, d):
    return T.take_rows(read(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), "o_orderkey"], 100)


@_q.add("t5_drop", "select o_orderkey, o_totalprice from orders where o_orderkey not in (select o_orderkey from orders order by o_totalprice, o_orderkey limit 500)")
def t5_drop(spark, d):
    return T.drop_rows(read(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 500)


@_q.add("t5_columns", "select s_suppkey, s_name, s_acctbal as last_column from supplier")
def t5_columns(spark, d):
    suppliers = read(spark, d, "supplier").withColumn("key", F.col("s_suppkey"))
    first = T.take_columns(T.drop_columns(suppliers, -1), 2)
    last = T.take_columns(T.drop_columns(suppliers, 3), -2)
    return first.join(last.withColumnsRenamed({"s_acctbal": "last_column"}), F.col("s_suppkey") == F.col("key")).drop("key")


@_q.add("t6_choose", "select w.i as out_pos, o_orderkey, o_custkey, o_custkey as o_custkey_3 from (values (0, 5), (1, 3), (2, 5), (3, (select max(o_orderkey) from orders))) w(i, k) join orders on o_orderkey = k")
def t6(spark, d):
    chosen = T.choose_rows(read(spark, d, "orders"), "o_orderkey", [5, 3, 5])
    orders = read(spark, d, "orders")
    last = T.choose_rows(orders.withColumn("place", F.col("o_orderkey") + 1), "place", [-1]).withColumn("out_pos", F.lit(3).cast("long"))
    both = chosen.select("out_pos", "o_orderkey", "o_custkey").unionByName(last.select("out_pos", "o_orderkey", "o_custkey"))
    return T.choose_columns(both, [1, 2, 3, -1]).withColumnRenamed("o_custkey_4", "o_custkey_3")


@_q.add("t7_series_pad", """with days as (select unnest(generate_series(date '2023-12-25', date '2024-02-05', interval 1 day))::date as day), c as (select ts::date as day, count(*) as n from events group by 1)
  select day::varchar as day, coalesce(n, 0) as n from days left join c using (day)""")
def t7(spark, d):
    series = T.generate_series(spark, 43, 1, 0, 1).select(F.date_add(F.lit("2023-12-25").cast("date"), F.col("c1").cast("int")).alias("day"))
    counts = read(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return T.pad(counts, "day", series, {"n": 0}).withColumn("day", F.col("day").cast("string"))


@_q.add("t8_frequency", """with e(bin, upper, low) as (values (0, 5.0, -1e9), (1, 10.0, 5.0), (2, 25.0, 10.0), (3, 40.0, 25.0), (4, null, 40.0))
  select bin, upper::double as upper, (select count(*) from lineitem where l_quantity > low and (upper is null or l_quantity <= upper)) as n from e""")
def t8(spark, d):
    return T.frequency(read(spark, d, "lineitem"), "l_quantity", [5, 10, 25, 40])


@_q.add("t9_group_totals", rounded_sql("""select l_returnflag, l_linestatus, (sum(l_quantity))::double as sum_qty, (sum(l_extendedprice))::double as sum_price, (sum((l_extendedprice * (1 - l_discount))))::double as revenue, count(*) as n_rows,
  (grouping(l_returnflag) + grouping(l_linestatus))::int as level from lineitem group by rollup(l_returnflag, l_linestatus)""", "sum_qty", "sum_price", "revenue", digits=3))
def t9(spark, d):
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    aggs = [F.sum("l_quantity").alias("sum_qty"), F.sum("l_extendedprice").alias("sum_price"), F.sum(revenue).alias("revenue"), F.count("*").alias("n_rows")]
    return rounded(T.group_totals(read(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], aggs), "sum_qty", "sum_price", "revenue", digits=3)


@_q.add("t10_pivot_totals", """select l_returnflag, sum(case when l_linestatus = 'F' then l_quantity end) as "F", sum(case when l_linestatus = 'O' then l_quantity end) as "O", sum(l_quantity) as total, grouping(l_returnflag) = 1 as is_total from lineitem group by rollup(l_returnflag)""")
def t10(spark, d):
    return T.pivot_totals(read(spark, d, "lineitem"), "l_returnflag", "l_linestatus", None, F.col("l_quantity"))


@_q.add("t11_filter_rows", "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 400000 union all select -1, null where not exists (select 1 from orders where o_totalprice > 1e12)")
def t11(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    found = T.filter_rows(orders, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000))
    none = T.filter_rows(orders, F.col("o_totalprice") > 1e12, {"o_orderkey": -1})
    return found.unionByName(none).select("o_orderkey", "o_totalprice")


@_q.add("t12_transpose", """with v as (select n_regionkey as p, min(n_name) as first_name, count(*)::varchar as nations from nation group by 1)
  select name, max(case when p = 0 then v end) as "0", max(case when p = 1 then v end) as "1", max(case when p = 2 then v end) as "2", max(case when p = 3 then v end) as "3", max(case when p = 4 then v end) as "4"
  from (select p, 'first_name' as name, first_name as v from v union all select p, 'nations', nations from v) group by name""")
def t12(spark, d):
    by_region = read(spark, d, "nation").groupBy("n_regionkey").agg(F.min("n_name").alias("first_name"), F.count("*").alias("nations"))
    return T.transpose(by_region, "n_regionkey", ["first_name", "nations"])
