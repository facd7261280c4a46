"""Queries of the column jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiltgrid.functions import values as V
from quiltgrid.operators import columns as C
from quiltgrid.plans.base import Queries, read

_q = Queries()
QUERIES, ORACLES = _q.queries, _q.oracles


@_q.add("c1_conditional", """select o_orderkey, case when o_totalprice >= 400000 then 'A' when o_totalprice >= 200000 then 'B' else 'F' end as grade,
  case o_orderstatus when 'F' then 'filled' when 'O' then 'open' end as status, not (o_totalprice > 100000) as is_small from orders""")
def c1(spark, d):
    x = F.col("o_totalprice")
    return C.derive(read(spark, d, "orders"), ["o_orderkey"], grade=C.first_true([(x >= 400000, "A"), (x >= 200000, "B")], "F"), status=C.switch(F.col("o_orderstatus"), {"F": "filled", "O": "open"}), is_small=~(x > 100000))


@_q.add("c2_errors", """select l_orderkey, l_partkey, l_linenumber, count(*) as n, round(sum(case when l_tax = 0 then 0 else l_discount / l_tax end), 4) as ratio,
  count(*) filter (where l_tax <> 0 and l_linenumber = 7) as missing from lineitem group by l_orderkey, l_partkey, l_linenumber""")
def c2(spark, d):
    items = read(spark, d, "lineitem")
    error = F.when(F.col("l_tax") == 0, "#DIV/0!").when(F.col("l_linenumber") == 7, "#N/A")
    ratio = F.try_divide("l_discount", "l_tax")
    items = items.withColumns({"ratio": C.if_error(ratio, F.when(F.col("l_tax") == 0, "#DIV/0!"), 0.0), "missing": C.if_na(F.lit(0), error, 1)})
    return items.groupBy("l_orderkey", "l_partkey", "l_linenumber").agg(F.count("*").alias("n"), F.round(F.sum("ratio"), 4).alias("ratio"), F.sum("missing").alias("missing"))


@_q.add("c3_type_profile", """with c as (select 'k' as "column", json_extract_string(props, '$.k') as v from events union all select 'event_type', event_type from events union all select 'value', value::varchar from events)
  select "column", count(*) filter (where v is null) as blank, count(*) filter (where try_cast(v as double) is not null) as number, count(*) filter (where upper(v) in ('TRUE', 'FALSE')) as bool, 0::bigint as error,
  count(*) filter (where v is not null and try_cast(v as double) is null and upper(v) not in ('TRUE', 'FALSE')) as text, count(*) filter (where floor(abs(try_cast(v as double))) % 2 = 1) as odd, count(*) filter (where floor(abs(try_cast(v as double))) % 2 = 0) as even from c group by 1""")
def c3(spark, d):
    events = read(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return C.type_profile(events, ["k", "event_type", "value"])


@_q.add("c4_rounding", """select p_partkey, round(p_retailprice, 0) as r0, ceil(round(p_retailprice / 10, 9)) * 10.0::double as up10, floor(round(p_retailprice / 10, 9)) * 10.0::double as down10, floor(round(p_retailprice / 25 + 0.5, 9)) * 25.0::double as near25,
  p_size - -7 * floor(p_size / -7::double) as mod_neg, ceil(p_size / 2::double) * 2 as even, (ceil((p_size - 1) / 2::double) * 2 + 1) as odd, (p_size / 7::double - 0.499999999)::bigint as whole_div, floor(-p_size / 4::double) * 4 as floor4, ceil(-p_size / 4::double) * 4 + 0.0 as ceil4 from part""")
def c4(spark, d):
    price, size = F.col("p_retailprice"), F.col("p_size").cast("double")
    return C.derive(
        read(spark, d, "part"), ["p_partkey"], r0=V.round_half_away(price), up10=V.round_up(price, -1), down10=V.round_down(price, -1), near25=V.mround(price, 25.0), mod_neg=V.mod(size, -7),
        even=V.even(size), odd=V.odd(size), whole_div=V.quotient(size, 7), floor4=V.floor_math(-size, 4), ceil4=V.ceiling_math(-size, 4),
    )


@_q.add("c5_numeric", """select l_orderkey, l_partkey, l_suppkey, l_linenumber, round(sum(abs(l_discount - 0.05)), 4) as dist, round(sum(sqrt(l_extendedprice)), 3) as root, round(sum(ln(l_quantity)), 4) as ln, round(sum(log10(l_quantity)), 4) as log10, round(sum(degrees(l_tax)), 4) as degrees,
  sum(sign(l_tax - 0.04))::double as sign, sum(least(greatest(l_quantity, 10), 40)) as clamped, round(sum(pow(l_quantity, 1.5)), 3) as power, count(*) filter (where l_tax < 0.05) as no_root from lineitem group by all""")
def c5(spark, d):
    q, tax = F.col("l_quantity"), F.col("l_tax")
    items = C.derive(
        read(spark, d, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], dist=F.abs(F.col("l_discount") - 0.05), root=V.sqrt(F.col("l_extendedprice")), ln=F.ln(q), log10=F.log10(q), degrees=F.degrees(tax),
        sign=F.signum(tax - 0.04), clamped=F.least(F.greatest(q, F.lit(10.0)), F.lit(40.0)), power=V.power(q, 1.5), no_root=V.sqrt(tax - 0.05).isNull(),
    )
    rounded = {"dist": 4, "root": 3, "ln": 4, "log10": 4, "degrees": 4, "power": 3}
    return items.groupBy("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").agg(*(F.round(F.sum(c), n).alias(c) for c, n in rounded.items()), F.sum("sign").alias("sign"), F.sum("clamped").alias("clamped"), F.count_if("no_root").alias("no_root"))


@_q.add("c6_bit_flags", "select p_partkey, p_size & 12 as band, p_size | 3 as bor, xor(p_size, 21) as bxor, p_size << 2 as left2, p_size >> 1 as right1, (p_size & 4) <> 0 as has_4 from part")
def c6(spark, d):
    s = F.col("p_size")
    return C.derive(read(spark, d, "part"), ["p_partkey"], band=s.bitwiseAND(12), bor=s.bitwiseOR(3), bxor=s.bitwiseXOR(21), left2=F.shiftleft(s, 2), right1=F.shiftright(s, 1), has_4=s.bitwiseAND(4) != 0)


@_q.add("c7_radix", """select o_orderkey, case when o_orderkey < 256 then lpad(bin(o_orderkey), 8, '0') else bin(o_orderkey) end as bin8, upper(hex(o_orderkey)) as hex, o_orderkey as back, upper(hex((1099511627776 - o_orderkey) % 1099511627776)) as hex_neg, -o_orderkey as back_neg from orders""")
def c7(spark, d):
    k = F.col("o_orderkey")
    return C.derive(read(spark, d, "orders"), ["o_orderkey"], bin8=V.radix(k, 2, 8), hex=V.radix(k, 16), back=V.from_radix(V.radix(k, 2), 2), hex_neg=V.radix(-k, 16, bits=40), back_neg=V.from_radix(V.radix(-k, 16, bits=40), 16, bits=40))


@_q.add("c8_combinatorics", """select l_orderkey, l_partkey, l_suppkey, l_linenumber, sum(factorial(l_linenumber)::bigint)::bigint as fact, sum(case when l_quantity >= 3 then l_quantity * (l_quantity - 1) * (l_quantity - 2) / 6 end)::double as choose3, sum(pow(l_linenumber, 3)) as permutationa,
  sum([1, 1, 2, 3, 8, 15, 48, 105][l_linenumber + 1])::double as fact2 from lineitem group by all""")
def c8(spark, d):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    items = C.derive(read(spark, d, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], fact=F.factorial(n), choose3=V.combin(q, 3), permutationa=V.power(n.cast("double"), 3), fact2=V.double_factorial(n))
    return items.groupBy("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").agg(*(F.sum(c).alias(c) for c in ("fact", "choose3", "permutationa", "fact2")))


@_q.add("c9_text_slices", """select c_custkey, left(c_name, 4) as l4, right(c_name, 3) as r3, substr(c_name, 3, 5) as mid, string_split(c_name, '#')[1] as before, string_split(c_name, '#')[2] as after, length(c_name) as len, repeat('*', (c_custkey % 4)::int) as stars, c_name || '-' || c_mktsegment as joined,
  case when c_mktsegment like '%I%' then string_split(c_mktsegment, 'I')[-1] end as after_last from customer""")
def c9(spark, d):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return C.derive(
        read(spark, d, "customer"), ["c_custkey"], l4=V.left(name, 4), r3=V.right(name, 3), mid=F.substring(name, 3, 5), before=V.text_before(name, "#"), after=V.text_after(name, "#"), len=F.length(name).cast("long"),
        stars=F.repeat(F.lit("*"), (F.col("c_custkey") % 4).cast("int")), joined=F.concat_ws("-", name, segment), after_last=V.text_after(segment, "I", -1),
    )


@_q.add("c10_search_replace", """select doc_id, nullif(strpos(text, 'the'), 0) as found, nullif(strpos(lower(text), 'the'), 0) as searched, md5(replace(text, 'an', 'AN')) as replaced, md5(substr(text, 1, 2) || 'XX' || substr(text, 6)) as placed, text = lower(text) as same_case,
  md5(case when len(string_split(text, 'an')) > 2 then array_to_string(string_split(text, 'an')[1:2], 'an') || 'AN' || array_to_string(string_split(text, 'an')[3:], 'an') else text end) as second from documents""")
def c10(spark, d):
    t = F.col("text")
    return C.derive(
        read(spark, d, "documents"), ["doc_id"], found=V.find("the", t).cast("long"), searched=V.search("t?e", F.regexp_replace(t, "(?i)t[^h]e", "---")).cast("long"), replaced=F.md5(V.substitute(t, "an", "AN")),
        placed=F.md5(V.replace_at(t, 3, 3, "XX")), same_case=t == F.lower(t), second=F.md5(V.substitute(t, "an", "AN", 2)),
    )


@_q.add("c11_text_clean", r"""select doc_id, md5(lower(text)) as down, md5(regexp_replace(text, '[\x00-\x1f]', '', 'g')) as cleaned, length(trim(regexp_replace(text, ' +', ' ', 'g'), ' ')) as trimmed, unicode(text) as code, chr((65 + doc_id % 26)::int) as ch from documents""")
def c11(spark, d):
    t = F.col("text")
    first = F.conv(F.hex(F.encode(F.substring(t, 1, 1), "UTF-32")), 16, 10).cast("int")
    return C.derive(read(spark, d, "documents"), ["doc_id"], down=F.md5(F.lower(t)), cleaned=F.md5(V.clean(t)), trimmed=F.length(V.trim(t)).cast("long"), code=first, ch=V.char(65 + F.col("doc_id") % 26))


@_q.add("c11_proper", "select c_custkey, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) as proper, '76Budget' as fixed from customer")
def c11_proper(spark, d):
    return C.derive(read(spark, d, "customer"), ["c_custkey"], proper=V.proper(F.col("c_mktsegment")), fixed=V.proper(F.lit("76BudGet")))


@_q.add("c12_text_to_value", """select event_id, json_extract_string(props, '$.k')::double as k, value as money, round(value / 100, 6) as share, ts::date::varchar as day from events""")
def c12(spark, d):
    events = read(spark, d, "events")
    text = F.format_number("value", 2)
    return C.derive(events, ["event_id"], k=V.to_number(F.get_json_object("props", "$.k")), money=V.to_number(F.concat(F.lit("$"), text)), share=F.round(V.to_number(F.concat(text, F.lit("%"))), 6), day=F.try_to_date(F.date_format("ts", "yyyy-MM-dd")).cast("string"))


@_q.add("c13_formats", """select o_orderkey, format('{:,.2f}', o_totalprice) as grouped, '$' || format('{:,.2f}', o_totalprice) as dollars, strftime(o_orderdate, '%Y-%m-%d') as iso, strftime(o_orderdate, '%B') as month_name, lpad(o_custkey::varchar, 6, '0') as padded,
  case when o_custkey % 3 = 0 then '-' else (o_custkey % 3)::varchar end as dashed from orders""")
def c13(spark, d):
    x, k = F.col("o_totalprice"), F.col("o_custkey")
    return C.derive(
        read(spark, d, "orders"), ["o_orderkey"], grouped=F.format_number(x, 2), dollars=F.concat(F.lit("$"), F.format_number(x, 2)), iso=F.date_format("o_orderdate", "yyyy-MM-dd"), month_name=F.date_format("o_orderdate", "MMMM"),
        padded=F.lpad(k.cast("string"), 6, "0"), dashed=F.when(k % 3 == 0, "-").otherwise((k % 3).cast("string")),
    )


@_q.add("c14_date_parts", """select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, day(o_orderdate) as d, isodow(o_orderdate) as weekday2, dayofweek(o_orderdate) + 1 as weekday1, weekofyear(o_orderdate) as isoweek, quarter(o_orderdate) as q,
  (make_date(year(o_orderdate), 1, 1) + to_months((month(o_orderdate) + 3)::int) + to_days((day(o_orderdate) + 9)::int))::date::varchar as built from orders""")
def c14(spark, d):
    t = F.col("o_orderdate")
    return C.derive(
        read(spark, d, "orders"), ["o_orderkey"], y=F.year(t), m=F.month(t), d=F.day(t), weekday2=F.weekday(t) + 1, weekday1=F.dayofweek(t), isoweek=F.weekofyear(t), q=F.quarter(t),
        built=V.make_date(F.year(t), F.month(t) + 4, F.day(t) + 10).cast("string"),
    )


@_q.add("c15_date_shifts", """with o as (select o_orderkey, o_orderdate::date as s, date '2001-10-31' as e from orders)
  select o_orderkey, (s + to_months(1))::date::varchar as plus_month, last_day((s + to_months(2))::date)::varchar as month_end, datesub('year', s, e) as years, datesub('month', s, e) as months, e - s as days, round((e - s) / 365.0, 6)::double as frac3,
  round(((2001 - year(s)) * 360 + (10 - month(s)) * 30 + 30 - least(day(s), 30)) / 360.0, 6)::double as frac4 from o""")
def c15(spark, d):
    s, e = F.col("o_orderdate").cast("date"), F.lit("2001-10-31").cast("date")
    return C.derive(
        read(spark, d, "orders"), ["o_orderkey"], plus_month=V.edate(s, 1).cast("string"), month_end=V.eomonth(s, 2).cast("string"), years=V.date_dif(s, e, "Y"), months=V.date_dif(s, e, "M"), days=F.datediff(e, s).cast("long"),
        frac3=F.round(V.year_frac(s, e, 3), 6), frac4=F.round(V.year_frac(s, e, 4), 6),
    )


@_q.add("c16_workdays", """with o as (select o_orderkey, o_orderdate::date as s, (o_orderdate + to_days((o_orderkey % 30)::int))::date as e from orders),
  cal as (select d::date as d, row_number() over (order by d) as n from generate_series(date '1994-12-01', date '2002-01-31', interval 1 day) g(d) where isodow(d) < 6)
  select o_orderkey, (select count(*) from cal where d between s and e) as workdays, (select min(d) from cal where n = (select count(*) from cal c where c.d <= s) + 10)::varchar as plus_10 from o""")
def c16(spark, d):
    s = F.col("o_orderdate").cast("date")
    return C.derive(read(spark, d, "orders"), ["o_orderkey"], workdays=V.workdays(s, F.date_add(s, (F.col("o_orderkey") % 30).cast("int"))), plus_10=V.workday_after(s, F.lit(10)).cast("string"))


@_q.add("c16_holidays", """with o as (select o_orderkey, o_orderdate::date as s, (o_orderdate + to_days((o_orderkey % 30)::int))::date as e from orders),
  h as (select distinct o_orderdate::date as d from orders where o_totalprice > 499000),
  cal as (select d::date as d from generate_series(date '1994-12-01', date '2002-01-31', interval 1 day) g(d) where isodow(d) not in (5, 6) and d::date not in (select d from h)),
  num as (select d, row_number() over (order by d) as n from cal)
  select o_orderkey, (select count(*) from cal where d between s and e) as days, case when e > s then -1 else 1 end * (select count(*) from cal where d between s and e) as reversed, (select min(x.d) from num x where x.n = (select count(*) from cal c where c.d <= s) + 5)::varchar as plus_5 from o""")
def c16_holidays(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("s"), F.date_add("o_orderdate", (F.col("o_orderkey") % 30).cast("int")).alias("e"))
    calendar = C.workday_calendar(spark, "1994-12-01", "2002-01-31", read(spark, d, "orders").where("o_totalprice > 499000").select("o_orderdate"), "0000110")
    rows = C.network_days(C.network_days(orders, "s", "e", calendar, "days"), "e", "s", calendar, "reversed")
    return C.workday_shift(rows, "s", 5, calendar, "plus_5").select("o_orderkey", "days", "reversed", F.col("plus_5").cast("string").alias("plus_5"))


@_q.add("c17_time_of_day", """select event_id, hour(ts) as h, minute(ts) as mi, second(ts) as s, round((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 86400.0, 8)::double as fraction, round(((hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 25200) % 86400) / 86400.0, 8)::double as shifted from events""")
def c17(spark, d):
    t = F.col("ts")
    seconds = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return C.derive(read(spark, d, "events"), ["event_id"], h=F.hour(t), mi=F.minute(t), s=F.second(t), fraction=F.round(seconds / 86400, 8), shifted=F.round(((seconds + 25200) % 86400) / 86400, 8))


@_q.add("c18_rates", """with l as (select c_custkey, abs(c_acctbal) + 100 as v from customer)
  select c_custkey, round(-v * pow(1.01, 24) * 0.01 / (pow(1.01, 24) - 1), 4) as pmt, round(v * pow(1.01, 24), 3) as fv, round(-v / pow(1.01, 24), 4) as pv, round((v - v / 10) / 5, 4) as sln, round((v - v / 10) * 4 * 2 / 30, 4) as syd,
  round(pow(1 + 0.12 / 12, 12) - 1, 8) as effect, round(v * pow(1 - round(1 - pow(0.1, 0.2), 3), 1) * round(1 - pow(0.1, 0.2), 3), 3) as db, round(greatest(v * pow(0.6, 1), v / 10) - greatest(v * pow(0.6, 2), v / 10), 4) as ddb from l""")
def c18(spark, d):
    v = F.abs("c_acctbal") + 100
    return C.derive(
        read(spark, d, "customer"), ["c_custkey"], pmt=F.round(V.pmt(0.01, 24, v), 4), fv=F.round(-V.fv(0.01, 24, 0.0, v), 3), pv=F.round(V.pv(0.01, 24, 0.0, v), 4), sln=F.round(V.sln(v, v / 10, 5), 4), syd=F.round(V.syd(v, v / 10, 5, 2), 4),
        effect=F.round(V.effect(F.lit(0.12), 12), 8), db=F.round(V.db(v, v / 10, 5, 2), 3), ddb=F.round(V.ddb(v, v / 10, 5, 2), 4),
    )


@_q.add("c18_payments", """with l as (select c_custkey, abs(c_acctbal) + 100 as v, 1 + c_custkey % 12 as k from customer),
  p as (select *, -v * 0.01 * pow(1.01, 24) / (pow(1.01, 24) - 1) as pay from l),
  q as (select *, -(v * pow(1.01, k - 1) + pay * (pow(1.01, k - 1) - 1) / 0.01) * 0.01 as interest from p),
  c as (select c_custkey, sum(-(v * pow(1.01, j - 1) + pay * (pow(1.01, j - 1) - 1) / 0.01) * 0.01) as cum from (select *, unnest(range(1, k + 1)) as j from p) group by c_custkey)
  select q.c_custkey, round(interest, 4) as ipmt, round(pay - interest, 4) as ppmt, round(cum, 4) as cumipmt, round(k * pay - cum, 4) as cumprinc, 0.01::double as rate from q join c using (c_custkey)""")
def c18_payments(spark, d):
    v, k = F.abs("c_acctbal") + 100, 1 + F.col("c_custkey") % 12
    return C.derive(
        read(spark, d, "customer"), ["c_custkey"], ipmt=F.round(V.ipmt(0.01, k, 24, v), 4), ppmt=F.round(V.ppmt(0.01, k, 24, v), 4), cumipmt=F.round(V.cumipmt(0.01, 24, v, 1, k), 4), cumprinc=F.round(V.cumprinc(0.01, 24, v, 1, k), 4),
        rate=F.round(V.rate(24, V.pmt(0.01, 24, v), v), 8),
    )


@_q.add("c13_text_codes", """select o_orderkey, printf('%.1f%%', floor(o_totalprice / 100) / 10) as percent, replace(regexp_replace(regexp_replace(printf('%.2e', floor(o_totalprice / 1000) * 1000 + 1), 'e', 'E'), 'x', ''), ' ', '') as scientific,
  lpad((o_orderkey % 1000)::varchar, 5, '0') as padded, case when o_orderkey % 3 = 0 then 'none' when o_orderkey % 3 = 1 then '(' || (o_orderkey % 3) || ')' else 'up ' || (o_orderkey % 3) || '.0' end as sections,
  strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%d %b %y') as short_day, (o_orderkey % 100) || ':30' as elapsed from orders""")
def c13_text_codes(spark, d):
    k = F.col("o_orderkey")
    signed = F.when(k % 3 == 0, 0.0).when(k % 3 == 1, -1.0).otherwise(2.0)
    return C.derive(
        read(spark, d, "orders"), ["o_orderkey"], percent=V.text(F.floor(F.col("o_totalprice") / 100) / 1000, "0.0%"), scientific=V.text(F.floor(F.col("o_totalprice") / 1000) * 1000 + F.lit(1.0), "0.00E+00"), padded=V.text((k % 1000).cast("double"), "00000"),
        sections=V.text(signed, '"up "0.0;(0);"none"'), day=V.text(V.to_serial(F.col("o_orderdate")), "yyyy-mm-dd"), short_day=V.text(V.to_serial(F.col("o_orderdate")), "dd mmm yy"), elapsed=V.text((k % 100) / 24 + 0.5 / 24, "[h]:mm"),
    )


@_q.add("c8_combina", "select p_partkey, p_size::double * (p_size + 1) / 2 as pairs, 1.0::double as none from part")
def c8_combina(spark, d):
    n = F.col("p_size").cast("double")
    return C.derive(read(spark, d, "part"), ["p_partkey"], pairs=V.combina(n, 2), none=V.combina(n, 0))


@_q.add("c19_units", "select p_partkey, round(p_size * 1609.344 / 1000, 6) as km, round(p_size * 453.59237 / 1000, 6) as kg, round((p_size + 459.67) * 5 / 9 - 273.15, 6) as celsius, null::double as bad from part")
def c19(spark, d):
    s = F.col("p_size").cast("double")
    return C.derive(read(spark, d, "part"), ["p_partkey"], km=F.round(V.convert(s, "mi", "km"), 6), kg=F.round(V.convert(s, "lbm", "kg"), 6), celsius=F.round(V.convert(s, "F", "C"), 6), bad=V.convert(s, "m", "kg"))


@_q.add("c19_unit_columns", """with u(k, source, target, size, zero, other) as (values (0, 'Gibyte', 'kbit', 8.0::double * 1073741824, 0.0::double, 1000.0::double), (1, 'cm2', 'ft2', 0.0001, 0, 0.3048 * 0.3048), (2, 'F', 'K', 5 / 9.0::double, 459.67 * 5 / 9.0::double, 1),
    (3, 'mph', 'kn', 0.44704, 0, 1852 / 3600.0::double), (4, 'uk_gal', 'l', 0.00454609, 0, 0.001), (5, 'hPa', 'psi', 100, 0, 6894.757293168361::double), (6, 'm', 'sec', null, null, null), (7, 'no unit', 'm', null, null, null))
  select p_partkey, source, target, round((p_size * size + zero) / other, 6) as converted from part join u on p_partkey % 8 = k""")
def c19_columns(spark, d):
    pairs = [("Gibyte", "kbit"), ("cm2", "ft2"), ("F", "K"), ("mph", "kn"), ("uk_gal", "l"), ("hPa", "psi"), ("m", "sec"), ("no unit", "m")]
    nth = lambda i: F.get(F.array(*(F.lit(p[i]) for p in pairs)), F.col("p_partkey") % 8)
    part = read(spark, d, "part").select("p_partkey", "p_size", nth(0).alias("source"), nth(1).alias("target"))
    return C.convert_units(part, "p_size", "source", "target").select("p_partkey", "source", "target", F.round("converted", 6).alias("converted"))


def _random_sql(seed: int, *parts: str) -> str:
    """The SQL of ``random_of``, of columns that are never null."""
    key = " || ".join(f"len(({p})::varchar) || ':' || ({p})" for p in parts)
    return f"(('0x' || substr(md5('{seed}|' || {key}), 1, 13))::bigint / 4503599627370496.0::double)"


@_q.add("c20_random", f"select l_orderkey, l_linenumber, {_random_sql(42, 'l_orderkey', 'l_linenumber')} as rand, floor({_random_sql(43, 'l_orderkey', 'l_linenumber')} * 100)::bigint + 1 as rand_between from lineitem")
def c20(spark, d):
    return C.random_columns(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 42, 1, 100)


@_q.add("c20_random_array", f"""with c as (select s_suppkey, r, k, floor({_random_sql(7, 's_suppkey', 'r', 'k')} * 6)::bigint + 1 as x from supplier, (select unnest(range(1, 3)) as r), (select unnest(range(1, 4)) as k))
  select s_suppkey, count(*) as n_cells, sum(x)::bigint as total, min(x) as least, max(x) as most, string_agg(x::varchar, ',' order by r, k) as cells from c group by s_suppkey""")
def c20_array(spark, d):
    rolled = C.random_array(read(spark, d, "supplier").select("s_suppkey"), ["s_suppkey"], 2, 3, 7, 1, 6, whole=True)
    cells = rolled.select("s_suppkey", F.flatten("random").alias("c"))
    return cells.select("s_suppkey", F.size("c").cast("long").alias("n_cells"), F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), F.array_min("c").alias("least"), F.array_max("c").alias("most"), F.array_join(F.col("c").cast("array<string>"), ",").alias("cells"))


@_q.add("c20_random_pick", f"""with r as (select o_orderpriority, o_orderkey, row_number() over (partition by o_orderpriority order by {_random_sql(5, 'o_orderpriority', 'o_orderkey')}, o_orderkey) as nth from orders)
  select o_orderpriority, max(o_orderkey) filter (where nth = 1) as winner, string_agg(o_orderkey::varchar, ',' order by o_orderkey) as sample from r where nth <= 5 group by o_orderpriority""")
def c20_pick(spark, d):
    orders = read(spark, d, "orders").select("o_orderpriority", "o_orderkey")
    one = C.random_pick(orders, ["o_orderpriority"], ["o_orderkey"], 5).withColumnRenamed("o_orderkey", "winner")
    some = C.random_pick(orders, ["o_orderpriority"], ["o_orderkey"], 5, n=5).groupBy("o_orderpriority").agg(F.array_join(F.array_sort(F.collect_list("o_orderkey")).cast("array<string>"), ",").alias("sample"))
    return one.join(some, "o_orderpriority")


@_q.add("c21_arrays", """select vec_id, round(list_sum(list_transform(embedding, lambda x: (x * x)::double)), 4) as norm2, len(list_filter(embedding, lambda x: x > 0)) as n_positive, round(list_max(embedding)::double, 5) as peak from embeddings""")
def c21(spark, d):
    e = F.transform("embedding", lambda x: x.cast("double"))
    return C.derive(read(spark, d, "embeddings"), ["vec_id"], norm2=F.round(F.aggregate(F.transform("embedding", lambda x: (x * x).cast("double")), F.lit(0.0), lambda a, x: a + x), 4), n_positive=F.size(F.filter(e, lambda x: x > 0)).cast("long"), peak=F.round(F.array_max(e), 5))


@_q.add("c21_by_row_and_column", "select s_suppkey % 5 as k, sum(s_suppkey * 2 + s_nationkey)::bigint as by_row, max(s_suppkey) as max_key, [[1, 2], [2, 4]]::varchar as grid from supplier group by 1")
def c21_rows(spark, d):
    s = read(spark, d, "supplier").withColumn("by_row", C.by_row([F.col("s_suppkey") * 2, F.col("s_nationkey").cast("long")], lambda a, x: a + x, F.lit(0).cast("long")))
    grid = F.concat(F.lit("["), F.array_join(F.transform(C.make_array(2, 2, lambda r, c: r * c), lambda r: F.concat(F.lit("["), F.array_join(r.cast("array<string>"), ", "), F.lit("]"))), ", "), F.lit("]"))
    return s.groupBy((F.col("s_suppkey") % 5).alias("k")).agg(F.sum("by_row").alias("by_row"), F.max("s_suppkey").alias("max_key")).withColumn("grid", grid)


@_q.add("c22_patterns", r"""select doc_id, regexp_matches(text, '[0-9]{4,}') as has_number, regexp_extract(text, '([0-9]{2,})', 1) as first_number, md5(regexp_replace(text, '[aeiou]', '_', 'g')) as masked, len(regexp_extract_all(text, '[0-9]+')) as n_numbers from documents""")
def c22(spark, d):
    t = F.col("text")
    return C.derive(read(spark, d, "documents"), ["doc_id"], has_number=t.rlike("[0-9]{4,}"), first_number=F.regexp_extract(t, "([0-9]{2,})", 1), masked=F.md5(F.regexp_replace(t, "[aeiou]", "_")), n_numbers=F.regexp_count(t, F.lit("[0-9]+")).cast("long"))


@_q.add("q1_sql_query", "select l_shipmode_like, count(*) as n, sum(l_quantity) as qty from (select l_returnflag as l_shipmode_like, l_quantity from lineitem where l_discount > 0.05) group by 1")
def q1(spark, d):
    return C.sql_query(read(spark, d, "lineitem"), "t", "select l_returnflag as l_shipmode_like, count(*) as n, sum(l_quantity) as qty from {t} where l_discount > 0.05 group by l_returnflag")
