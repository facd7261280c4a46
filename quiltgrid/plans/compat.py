"""Queries of the compatibility pipeline and its sources, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiltgrid.operators import compat as P
from quiltgrid.plans.base import Queries, read
from quiltgrid.session import shared_dir
from quiltgrid.sources import readers as S

_q = Queries()
QUERIES, ORACLES = _q.queries, _q.oracles
LABELS = (("click", "ui"), ("view", "ui"), ("purch", "sale"))


def outcomes(spark, d):
    """Events as cases: types as outcomes."""
    t = F.col("event_type")
    return read(spark, d, "events").withColumns({"matched": F.when(t == "view", None).when(t == "click", True).when(t == "purchase", F.col("value") < 150).otherwise(F.lit(True)), "error": F.when((t == "error") & (F.col("value") > 40), "#NAME?").when((t == "signup") & (F.col("value") > 60), "#N/A")})


@_q.add("s1_read_cases", """select p_brand as function, count(*) as cases, sum(2)::bigint as cells, count(*) filter (where p_partkey % 5 = 0) as texts, count(*) filter (where p_partkey % 5 = 1) as nulls, count(*) filter (where p_partkey % 5 = 2) as errors, count(*) filter (where p_partkey % 5 = 3) as arrays, count(*) filter (where p_partkey % 5 = 4) as numbers from part group by 1""")
def s1(spark, d):
    path, k = shared_dir(spark), F.col("p_partkey") % 5
    size = F.col("p_size").cast("string")
    expected = F.when(k == 0, '"text"').when(k == 1, "null").when(k == 2, '"#DIV/0!"').when(k == 3, F.concat(F.lit("["), size, F.lit(",2]"))).otherwise(size)
    case = F.format_string('{"id":"c%d","formula":"=SUM(A1:A2)","description":"x","setup_cells":{"A1":%d,"A2":"b"},"expected":%s}', F.col("p_partkey"), F.col("p_size"), expected)
    one = F.concat(F.format_string('{"function":"%s","cases":[', F.col("p_brand")), case, F.lit("]}"))
    read(spark, d, "part").select(one.alias("value")).write.option("lineSep", "\n").text(path)
    rows = S.read_cases(spark, path, multi_line=False)
    count = lambda x: F.count_if(F.col("expected_kind") == x)
    return rows.groupBy("function").agg(F.count("*").alias("cases"), F.sum("n_cells").cast("long").alias("cells"), count("str").alias("texts"), count("null").alias("nulls"), count("err").alias("errors"), count("array").alias("arrays"), count("num").alias("numbers"))


@_q.add("s2_read_recipes", """select p_name as title, count(*) as recipes, count(*) filter (where p_partkey % 2 = 0) as verified, count(*) filter (where p_partkey % 4 = 0) as lists, sum(p_size)::bigint as total from part group by p_name""")
def s2(spark, d):
    path, done, k = shared_dir(spark), shared_dir(spark), F.col("p_partkey")
    part = read(spark, d, "part").withColumn("slug", F.concat(F.lit("r"), k.cast("string")))
    recipe = F.format_string('{"slug":"%s","title":"%s","keywords":["a"],"solutions":{"excel":{"formula":"=A1","note":""}},"verify":{"formula":"=A1","expected":%d}}', "slug", "p_name", "p_size")
    part.select(recipe.alias("value")).write.text(path)
    actual = F.when(k % 4 == 0, F.format_string("[%d,%d]", "p_size", "p_size")).otherwise(F.col("p_size").cast("string"))
    verified = F.concat(F.format_string('{"recipes":{"%s":{"verified":true,"engine":"x","actual":', "slug"), actual, F.lit("}}}"))
    part.where(k % 2 == 0).select(verified.alias("value")).write.text(done)
    rows = S.read_recipes(spark, path, done, multi_line=False)
    total = F.sum(F.try_variant_get("verify.expected", "$", "long"))
    return rows.groupBy("title").agg(F.count("*").alias("recipes"), F.count_if("verified").alias("verified"), F.count_if(F.contains("actual", F.lit(", "))).alias("lists"), total.alias("total"))


@_q.add("s3_read_results", """select case when event_type in ('view', 'click') then 'libreoffice' else 'excel' end as app, (event_id % 3)::varchar || '.2' as engine_version, event_type as function, count(*) as cases, count(*) filter (where value < 50) as matched from events where event_type <> 'error' group by all""")
def s3(spark, d):
    path = shared_dir(spark)
    events = read(spark, d, "events")
    engine = F.when(F.col("event_type").isin("view", "click"), "LibreOffice Calc").when(F.col("event_type") == "error", "abacus").otherwise("MS Excel")
    result = F.struct(F.col("value"), F.array("value").alias("range_values"), (F.col("value") < 50).alias("matched_expected"))
    per_function = F.map_from_arrays(F.array("event_type"), F.array(F.map_from_arrays(F.array(F.col("event_id").cast("string")), F.array(result))))
    events.select(engine.alias("engine"), F.concat((F.col("event_id") % 3).cast("string"), F.lit(".2")).alias("engine_version"), F.lit(True).alias("trusted"), per_function.alias("function_results")).write.json(path)
    rows = S.read_results(spark, path, multi_line=False)
    return rows.groupBy("app", "engine_version", "function").agg(F.count("*").alias("cases"), F.count_if("matched").alias("matched"))


@_q.add("s4_read_inventory", "select c_mktsegment as category, a as app, count(*) as functions, count(*) filter (where a = 'excel' or c_custkey % 2 = 0) as documented from customer, (values ('excel'), ('sheets')) t(a) group by all")
def s4(spark, d):
    path = shared_dir(spark)
    app = lambda on: F.struct(on.alias("documented"), F.lit("u").alias("url"))
    apps = F.create_map(F.lit("excel"), app(F.lit(True)), F.lit("sheets"), app(F.col("c_custkey") % 2 == 0))
    one = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("category"), apps.alias("apps"))
    read(spark, d, "customer").select(F.array(one).alias("functions")).write.json(path)
    rows = S.read_inventory(spark, path, multi_line=False)
    return rows.groupBy("category", "app").agg(F.count("*").alias("functions"), F.count_if("documented").alias("documented"))


@_q.add("s5_read_named_tables", "select r_name, count(*) as nations from nation join region on n_regionkey = r_regionkey group by r_name")
def s5(spark, d):
    t = S.read_named_tables(spark, d, ["nation", "region"])
    return t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count("*").alias("nations"))


@_q.add("s6_write_wide", "select c_name as name, c_mktsegment as cat, true as x, c_custkey % 2 = 0 as g, case when c_custkey % 7 = 0 then true end as lnew from customer")
def s6(spark, d):
    path, k = shared_dir(spark), F.col("c_custkey")
    S.write_wide(read(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("cat"), F.lit(True).alias("x"), (k % 2 == 0).alias("g"), (k % 7 == 0).alias("lnew")), path)
    return spark.read.schema("name string, cat string, x boolean, g boolean, lnew boolean").json(path)


@_q.add("p1_normalize_label", "select event_id, case when event_type ilike '%click%' or event_type ilike '%view%' then 'ui' when event_type ilike '%purch%' then 'sale' end as label from events")
def p1(spark, d):
    return read(spark, d, "events").select("event_id", P.normalize_label(F.col("event_type"), LABELS).alias("label"))


@_q.add("p2_version_key", "select event_id, event_id // 1000 as major, event_id % 1000 // 10 as minor, 0 as patch, 3::int as parts from events")
def p2(spark, d):
    k = F.col("event_id")
    version = F.concat((k / 1000).cast("long").cast("string"), F.lit(".v"), (k % 1000 / 10).cast("long").cast("string"), F.lit(".rc"))
    key = P.version_key(version)
    return read(spark, d, "events").select("event_id", F.get(key, F.lit(0)).cast("long").alias("major"), F.get(key, F.lit(1)).cast("long").alias("minor"), F.get(key, F.lit(2)).alias("patch"), F.size(key).alias("parts"))


@_q.add("p3_latest_per_key", "select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def p3(spark, d):
    return P.latest_per_key(read(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@_q.add("p4_history_per_key", "select o_orderkey, row_number() over w as step, lag(o_orderstatus) over w as value_before from orders window w as (partition by o_custkey order by o_orderkey)")
def p4(spark, d):
    return P.history_per_key(read(spark, d, "orders"), ["o_custkey"], "o_orderkey", "o_orderstatus").select("o_orderkey", "step", "value_before")


@_q.add("p5_flag_error_codes", "select event_type, count(*) as n, count(*) filter (where event_type = 'error') as errors from events group by 1")
def p5(spark, d):
    code = P.flag_error_codes(F.when(F.col("event_type") == "error", "#N/A").otherwise(F.col("event_type")))
    return read(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count(code).alias("errors"))


@_q.add("p6_to_serial", "select o_orderkey, (o_orderdate::date - date '1899-12-30')::double as serial from orders")
def p6(spark, d):
    return read(spark, d, "orders").select("o_orderkey", P.serial(F.col("o_orderdate")).alias("serial"))


@_q.add("p7_p8_compare_tables", """select o_orderkey, o_orderkey % 11 <> 0 and o_orderkey % 10 <> 0 and o_orderkey % 7 <> 0 as matched, case when o_orderkey % 11 = 0 then 'missing' when o_orderkey % 10 = 0 then 'o_totalprice' when o_orderkey % 7 = 0 then 'o_orderstatus' end as detail from orders""")
def p8(spark, d):
    orders, k = read(spark, d, "orders"), F.col("o_orderkey")
    altered = orders.where(k % 11 != 0).withColumns({"o_totalprice": F.col("o_totalprice") + F.when(k % 10 == 0, 1.0).otherwise(1e-12), "o_orderstatus": F.when(k % 7 == 0, "X").otherwise(F.col("o_orderstatus"))})
    return P.compare_tables(orders, altered, ["o_orderkey"], ["o_totalprice", "o_orderstatus"])


@_q.add("p8_arrays", "select vec_id, vec_id % 3 <> 0 as matched, case when vec_id % 3 = 0 then '64 cells wanted, 3 read' end as detail from embeddings")
def p8_arrays(spark, d):
    own = F.col("embedding")
    other = F.when(F.col("vec_id") % 3 == 0, F.slice(own, 1, 3)).otherwise(own)
    return read(spark, d, "embeddings").select("vec_id", P.arrays_equal(own, other).alias("matched"), P.arrays_detail(own, other).alias("detail"))


@_q.add("p9_trust_gate", """with g as (select ts::date::varchar as run, bool_and(value >= 0) as d, bool_and(event_type <> 'error' or value < 100) as v from events group by 1)
  select run, d and v as trusted, array_to_string(list_filter([case when not d then 'deterministic value differs' end, case when not v then 'volatile value repeats' end], lambda x: x is not null), '; ') as gate_note from g""")
def p9(spark, d):
    events = read(spark, d, "events").withColumn("run", F.to_date("ts").cast("string"))
    return P.trust_gate(events, ["run"], F.col("value") >= 0, (F.col("event_type") != "error") | (F.col("value") < 100))


@_q.add("p10_case_report", """select o_orderkey, case when o_orderkey % 5 <> 0 then o_orderkey % 4 <> 0 end as matched, array_to_string(list_filter([case when o_orderkey % 6 = 0 then 'UNTRUSTED_RECALC' end, case when o_orderstatus = 'P' then 'open' end,
  case when o_orderkey % 5 <> 0 and o_orderkey % 4 = 0 then 'should be ' || o_custkey::varchar || ', is ' || (o_custkey + 1)::varchar end], lambda x: x is not null), '; ') as notes from orders""")
def p10(spark, d):
    orders, k = read(spark, d, "orders"), F.col("o_orderkey")
    cases = orders.select("o_orderkey", F.when(k % 5 != 0, F.col("o_custkey")).alias("expected"), F.when(F.col("o_orderstatus") == "P", "open").alias("expected_note"))
    results = orders.select("o_orderkey", (F.col("o_custkey") + F.when(k % 4 == 0, 1).otherwise(0)).alias("value"), (k % 6 != 0).alias("canary_ok"))
    return P.case_report(cases, results, "o_orderkey").select("o_orderkey", "matched", "notes")


@_q.add("p11_group_verdict", """with e as (select user_id, case event_type when 'view' then null when 'click' then true when 'purchase' then value < 150 else true end as matched, case when event_type = 'error' and value > 40 then '#NAME?' when event_type = 'signup' and value > 60 then '#N/A' end as error from events)
  select user_id, case when bool_and(coalesce(matched, error is null)) then 'supported' when bool_or(error = '#NAME?') then 'unsupported' else 'quirky' end as verdict, count(*) as cases from e group by user_id""")
def p11(spark, d):
    rows = outcomes(spark, d)
    return P.group_verdict(rows, ["user_id"], F.col("matched"), F.col("error"), F.col("error"), F.array("error"))


@_q.add("p12_support_matrix", """with v as (select o_custkey as k, o_orderstatus as app, case when max(o_totalprice) > 300000 then 'supported' else 'quirky' end as verdict from orders group by all)
  select c_custkey as k, max(verdict) filter (where app = 'F') as "F", max(verdict) filter (where app = 'O') as "O" from customer left join v on c_custkey = k group by c_custkey""")
def p12(spark, d):
    verdicts = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("app")).agg(F.when(F.max("o_totalprice") > 300000, "supported").otherwise("quirky").alias("verdict"))
    return P.support_matrix(read(spark, d, "customer").select(F.col("c_custkey").alias("k")), verdicts, "k", ["F", "O"])


@_q.add("p13_mismatch_rows", "select o_orderkey, case when o_orderkey % 11 = 0 then 'missing' when o_orderkey % 10 = 0 then 'o_totalprice' else 'o_orderstatus' end as detail from orders where o_orderkey % 11 = 0 or o_orderkey % 10 = 0 or o_orderkey % 7 = 0")
def p13(spark, d):
    return P.mismatch_rows(p8(spark, d), "matched").drop("matched")


@_q.add("p14_state_change", """with g as (select o_custkey, count(distinct o_orderkey) as n, arg_min(o_orderstatus = 'F', o_orderkey) as first_state, arg_max(o_orderstatus = 'F', o_orderkey) as last_state, min(o_orderkey) filter (where o_orderstatus = 'F') as since from orders group by o_custkey)
  select o_custkey, first_state, last_state, since, not first_state and last_state as newly from g where n >= 2 and first_state <> last_state""")
def p14(spark, d):
    return P.state_change(read(spark, d, "orders"), ["o_custkey"], "o_orderkey", F.col("o_orderstatus") == "F")


@_q.add("p15_rollup_priority", """with o as (select *, case o_orderstatus when 'P' then 'quirky' when 'O' then 'unsupported' else 'supported' end as state from orders)
  select o_custkey, case when bool_or(state = 'quirky') then 'quirky' when bool_or(state = 'unsupported') then 'unsupported' else 'supported' end as worst, count(*) filter (where o_totalprice >= 400000) as quirks, count(*) as cases, max(o_orderkey) as last_date from o group by o_custkey""")
def p15(spark, d):
    orders = read(spark, d, "orders").withColumn("state", F.when(F.col("o_orderstatus") == "P", "quirky").when(F.col("o_orderstatus") == "O", "unsupported").otherwise("supported"))
    return P.rollup_priority(orders, ["o_custkey"], "state", F.col("o_totalprice") < 400000, "o_orderkey")


@_q.add("p16_corpus_stats", "select count(distinct event_type) as functions, count(distinct user_id) as engines, count(*) filter (where value > 10) as tested, count(*) as cases, count(*) filter (where event_type = 'error') as quirks from events")
def p16(spark, d):
    return P.corpus_stats(read(spark, d, "events"), functions=F.countDistinct("event_type"), engines=F.countDistinct("user_id"), tested=F.count_if(F.col("value") > 10), cases=F.count("*"), quirks=F.count_if(F.col("event_type") == "error"))


@_q.add("p17_top_k", "select c_custkey, c_name from customer order by c_mktsegment = 'MACHINERY' desc, c_acctbal desc, c_name limit 8")
def p17(spark, d):
    return P.top_k_by(read(spark, d, "customer"), [(F.col("c_mktsegment") == "MACHINERY").desc(), F.col("c_acctbal").desc(), "c_name"]).select("c_custkey", "c_name")


@_q.add("p18_allowlist", "select p_brand, i as list_pos, count(*) as n from part join (values ('Brand#3', 0), ('Brand#1', 1), ('Brand#99', 2)) t(b, i) on p_brand = b group by all")
def p18(spark, d):
    return P.ordered_allowlist(read(spark, d, "part"), "p_brand", ["Brand#3", "Brand#1", "Brand#99"]).groupBy("p_brand", "list_pos").agg(F.count("*").alias("n"))


@_q.add("p19_extract_calls", r"""select page_id, list_distinct(regexp_extract_all(regexp_replace(html, '"[^"]*"', '""', 'g'), '([A-Za-z_][A-Za-z0-9_.]*)\(', 1)) is not null as ok, len(list_distinct(list_transform(regexp_extract_all(regexp_replace(html, '"[^"]*"', '""', 'g'), '([A-Za-z_][A-Za-z0-9_.]*)\(', 1), lambda x: upper(x)))) as n_calls,
  array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(regexp_replace(html, '"[^"]*"', '""', 'g'), '([A-Za-z_][A-Za-z0-9_.]*)\(', 1), lambda x: upper(x)))), ' ') as names from pages""")
def p19(spark, d):
    calls = P.extract_calls(F.col("html"))
    return read(spark, d, "pages").select("page_id", calls.isNotNull().alias("ok"), F.size(calls).cast("long").alias("n_calls"), F.array_join(F.array_sort(calls), " ").alias("names"))


@_q.add("p20_inverted_index", "with p as (select distinct l_partkey, l_orderkey from lineitem) select l_partkey, l_orderkey, count(*) over (partition by l_partkey) as n_items from p")
def p20(spark, d):
    return P.inverted_index(read(spark, d, "lineitem"), "l_partkey", "l_orderkey")


@_q.add("p21_related_items", """with p as (select distinct l_orderkey, l_partkey from lineitem), s as (select a.l_partkey, b.l_partkey as other, count(*) as score from p a join p b on a.l_orderkey = b.l_orderkey and a.l_partkey <> b.l_partkey group by all)
  select * from (select *, row_number() over (partition by l_partkey order by score desc, other) as place from s) where place <= 5""")
def p21(spark, d):
    return P.related_items(read(spark, d, "lineitem"), "l_orderkey", "l_partkey")


@_q.add("p22_items_for_group", """with g as (select distinct l_suppkey, l_partkey from lineitem), i as (select distinct l_partkey, l_orderkey from lineitem), s as (select l_suppkey, l_orderkey, count(*) as score from g join i using (l_partkey) group by all)
  select * from (select *, row_number() over (partition by l_suppkey order by score desc, l_orderkey) as place from s) where place <= 6""")
def p22(spark, d):
    items = read(spark, d, "lineitem")
    return P.items_for_group(items, items, "l_suppkey", "l_partkey", "l_orderkey")


@_q.add("p23_classify", "select case when p_name ilike '%ring%' then 'jewel' when p_name ilike '%red%' or p_name ilike '%blue%' then 'colour' else 'other' end as class, count(*) as n from part group by 1")
def p23(spark, d):
    rules = [("jewel", ["ring"]), ("colour", ["red", "blue"])]
    return read(spark, d, "part").groupBy(P.classify_first_match(F.col("p_name"), rules, "other").alias("class")).agg(F.count("*").alias("n"))


COMPAT = "select p_brand, sum(p_size) % 3 = 0 as x, sum(p_size) % 2 = 0 as l from part where p_brand <> 'Brand#7' group by p_brand"


def _calls(spark, d):
    items = read(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    return items.join(read(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").select("l_orderkey", "p_brand")


def _compat(spark, d):
    return read(spark, d, "part").where("p_brand <> 'Brand#7'").groupBy("p_brand").agg((F.sum("p_size") % 3 == 0).alias("x"), (F.sum("p_size") % 2 == 0).alias("l"))


@_q.add("p25_check_corpus", f"""with c as (select distinct l_orderkey, p_brand from lineitem join part on l_partkey = p_partkey), k as ({COMPAT})
  select l_orderkey, count(*) as n_calls, bool_and(coalesce(x, false)) as ok_x, bool_and(coalesce(l, false)) as ok_l, count(*) filter (where k.p_brand is null) as n_unknown from c left join k on c.p_brand = k.p_brand group by l_orderkey""")
def p25(spark, d):
    return P.check_corpus(_calls(spark, d), _compat(spark, d), "l_orderkey", "p_brand", ["x", "l"])


@_q.add("p26_migration_report", f"""with c as (select distinct l_orderkey, p_brand from lineitem join part on l_partkey = p_partkey), k as ({COMPAT}), a as (select p_brand, min(p_name) as alternative from part where p_brand < 'Brand#2' group by 1)
  select l_orderkey, c.p_brand, alternative from c join k using (p_brand) left join a using (p_brand) where not l""")
def p26(spark, d):
    alternatives = read(spark, d, "part").where("p_brand < 'Brand#2'").groupBy("p_brand").agg(F.min("p_name").alias("alternative"))
    return P.migration_report(_calls(spark, d), _compat(spark, d), alternatives, "l_orderkey", "p_brand", F.col("l")).select("l_orderkey", "p_brand", "alternative")


def _both(spark, d):
    big = read(spark, d, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return P.flag_member(read(spark, d, "customer"), big, "c_custkey").withColumn("rich", F.col("c_acctbal") > 5000)


@_q.add("p27_exclusive_items", "select c_custkey, c_name from customer where c_acctbal > 5000 and c_custkey not in (select o_custkey from orders where o_totalprice > 450000)")
def p27(spark, d):
    return P.exclusive_items(_both(spark, d), F.col("rich"), F.col("is_member")).select("c_custkey", "c_name")


@_q.add("p28_overlap_counts", """with b as (select c_acctbal > 5000 as a, c_custkey in (select o_custkey from orders where o_totalprice > 450000) as b from customer)
  select count(*) filter (where a and not b) as only_a, count(*) filter (where b and not a) as only_b, count(*) filter (where a and b) as both from b""")
def p28(spark, d):
    return P.overlap_counts(_both(spark, d), F.col("rich"), F.col("is_member"))


#: The years of ``orders``, for the SQL; the operator finds them.
YEARS = range(1995, 2002)


@_q.add("p29_version_matrix", f"""with s as (select o_custkey, year(o_orderdate) as y, max(o_orderstatus) as state from orders group by all), c as (select o_custkey from s group by 1 having count(distinct state) > 1)
  select o_custkey, {', '.join(f'max(state) filter (where y = {y}) as "{y}"' for y in YEARS)} from s join c using (o_custkey) group by o_custkey""")
def p29(spark, d):
    states = read(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.max("o_orderstatus").alias("state"))
    return P.version_matrix(states, "o_custkey", "y", None, "state")


@_q.add("p30_verify_examples", "select l_orderkey % 100 as bucket, count(*) as n, count(*) filter (where l_linenumber <> 7 and l_quantity <> 13) as verified from lineitem group by 1")
def p30(spark, d):
    q = F.col("l_quantity")
    expected = F.array(q.cast("int").cast("string"), F.lit(None).cast("string"), F.lit("a"))
    actual = F.array(F.when(q == 13, "?").otherwise(q.cast("string")), F.lit("a"))
    rows = P.verify_examples(read(spark, d, "lineitem"), expected, actual, F.when(F.col("l_linenumber") == 7, "#REF!"))
    return rows.groupBy((F.col("l_orderkey") % 100).alias("bucket")).agg(F.count("*").alias("n"), F.count_if("verified").alias("verified"))


@_q.add("p31_outcome_summary", "select count(*) filter (where not (event_type = 'error' and value > 40) and not (event_type = 'signup' and value > 60)) as fine, count(*) filter (where event_type = 'error' and value > 40) as unknown_name, count(*) filter (where event_type = 'signup' and value > 60) as other_errors from events")
def p31(spark, d):
    return P.outcome_summary(outcomes(spark, d), F.col("error"))


@_q.add("p32_rewrite_tokens", r"""select page_id, md5(regexp_replace(html, '(^|[^A-Za-z0-9_.])track\(', '\1_xlfn.TRACK(', 'gi')) as rewritten from pages""")
def p32(spark, d):
    return read(spark, d, "pages").select("page_id", F.md5(P.rewrite_tokens(F.col("html"), {"TRACK": "_xlfn."})).alias("rewritten"))


@_q.add("p35_flag_member", "select p_partkey, p_name in (select p_name from part where p_size > 48) as is_member from part")
def p35(spark, d):
    part = read(spark, d, "part")
    return P.flag_member(part.select("p_partkey", "p_name"), part.where("p_size > 48"), "p_name").select("p_partkey", "is_member")
