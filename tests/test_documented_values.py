"""Documented results of functions, as own fixtures: what an application's users know them to give. Null stands for an error."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from quiltgrid.functions import values as V
from quiltgrid.functions.criteria import criterion
from quiltgrid.operators import aggregates as A
from quiltgrid.operators import columns as C
from quiltgrid.operators import lookups as J
from quiltgrid.operators import tables as T
from quiltgrid.operators import windows as W

L = F.lit
D = lambda *ymd: F.lit(datetime.date(*ymd))
X = lambda x: F.lit(float(x))


def scalars():
    return {
        "BASE(255,16)": (V.radix(L(255), 16), "FF"), "DECIMAL(FF,16)": (V.from_radix(L("FF"), 16), 255), "BIN2DEC(1010)": (V.from_radix(L("1010"), 2, 10), 10), "BIN2HEX(1111,4)": (V.radix(V.from_radix(L("1111"), 2, 10), 16, 4), "000F"),
        "BIN2OCT(1111)": (V.radix(V.from_radix(L("1111"), 2, 10), 8), "17"), "BIN2OCT(111,4)": (V.radix(V.from_radix(L("111"), 2, 10), 8, 4), "0007"), "DEC2BIN(10)": (V.radix(L(10), 2, bits=10), "1010"), "DEC2BIN(10,8)": (V.radix(L(10), 2, 8, 10), "00001010"),
        "DEC2HEX(255,4)": (V.radix(L(255), 16, 4, 40), "00FF"), "DEC2HEX(16)": (V.radix(L(16), 16, bits=40), "10"), "DEC2OCT(15)": (V.radix(L(15), 8, bits=30), "17"), "DEC2OCT(8,4)": (V.radix(L(8), 8, 4, 30), "0010"), "HEX2BIN(F,8)": (V.radix(V.from_radix(L("F"), 16, 40), 2, 8), "00001111"),
        "HEX2DEC(DEC2HEX(4095))": (V.from_radix(V.radix(L(4095), 16, bits=40), 16, 40), 4095), "HEX2OCT(FF)": (V.radix(V.from_radix(L("FF"), 16, 40), 8), "377"), "OCT2BIN(7,4)": (V.radix(V.from_radix(L("7"), 8, 30), 2, 4), "0111"), "OCT2DEC(17)": (V.from_radix(L("17"), 8, 30), 15),
        "OCT2HEX(777)": (V.radix(V.from_radix(L("777"), 8, 30), 16), "1FF"), "FLOOR.MATH(24.3,5)": (V.floor_math(X(24.3), 5), 20.0), "FLOOR.MATH(6.7)": (V.floor_math(X(6.7), 1), 6.0), "FLOOR.MATH(-8.1,2)": (V.floor_math(X(-8.1), 2), -10.0), "FLOOR.MATH(-5.5,2,-1)": (V.floor_math(X(-5.5), 2, -1), -4.0),
        "MROUND(10,3)": (V.mround(X(10), 3.0), 9.0), "MROUND(1.3,0.2)": (V.mround(X(1.3), 0.2), 1.4), "MROUND(5,-2)": (V.mround(X(5), -2.0), None), "MROUND(0,5)": (V.mround(X(0), 5.0), 0.0), "EVEN(3)": (V.even(X(3)), 4.0), "ODD(2)": (V.odd(X(2)), 3.0),
        "ROUND(2.5)": (V.round_half_away(X(2.5)), 3.0), "ROUND(-2.5)": (V.round_half_away(X(-2.5)), -3.0), "ROUND(12345,-2)": (V.round_half_away(X(12345), -2), 12300.0), "ROUND(1.005,2)": (V.round_half_away(X(1.005), 2), 1.01), "ROUNDUP(-3.2)": (V.round_up(X(-3.2)), -4.0),
        "ROUNDUP(21.5,-1)": (V.round_up(X(21.5), -1), 30.0), "ROUNDUP(3.14159,2)": (V.round_up(X(3.14159), 2), 3.15), "ROUNDDOWN(-3.9)": (V.round_down(X(-3.9)), -3.0), "ROUNDDOWN(21.5,-1)": (V.round_down(X(21.5), -1), 20.0), "TRUNC(3.14159,2)": (V.round_down(X(3.14159), 2), 3.14),
        "MOD(7,3)": (V.mod(X(7), 3), 1.0), "MOD(-7,3)": (V.mod(X(-7), 3), 2.0), "MOD(7,-3)": (V.mod(X(7), -3), -2.0), "MOD(5,0)": (V.mod(X(5), 0), None), "QUOTIENT(17,5)": (V.quotient(X(17), 5), 3), "FACTDOUBLE(6)": (V.double_factorial(L(6)), 48.0), "COMBIN(5,2)": (V.combin(X(5), 2), 10.0),
        "COMBINA(4,3)": (V.combina(X(4), 3), 20.0), "MULTINOMIAL(2,3)": (V.multinomial(L(2), L(3)), 10.0), "MULTINOMIAL(1,2,3)": (V.multinomial(L(1), L(2), L(3)), 60.0), "LEFT(Excel)": (V.left(L("Excel")), "E"), "LEFT(Excel,100)": (V.left(L("Excel"), 100), "Excel"), "LEFT(Excel,0)": (V.left(L("Excel"), 0), ""),
        "RIGHT(Excel)": (V.right(L("Excel")), "l"), "RIGHT(Excel,3)": (V.right(L("Excel"), 3), "cel"), "RIGHT(Excel,0)": (V.right(L("Excel"), 0), ""), "FIND(e,spreadsheet)": (V.find("e", L("spreadsheet")), 4), "FIND(a,Apple)": (V.find("a", L("Apple")), None), "FIND(p,Apple,3)": (V.find("p", L("Apple"), 3), 3),
        "SEARCH(a,Apple)": (V.search("a", L("Apple")), 1), "SEARCH(p*e,Apple)": (V.search("p*e", L("Apple")), 2), "SEARCH(?pple,Apple)": (V.search("?pple", L("Apple")), 1), "SEARCH(z,Apple)": (V.search("z", L("Apple")), None), "SUBSTITUTE(all)": (V.substitute(L("a-b-a-b"), "a", "X"), "X-b-X-b"),
        "SUBSTITUTE(second)": (V.substitute(L("a-b-a-b"), "a", "X", 2), "a-b-X-b"), "SUBSTITUTE(case)": (V.substitute(L("Apple"), "a", "X"), "Apple"), "REPLACE(123456)": (V.replace_at(L("123456"), 1, 3, "@"), "@456"), "REPLACE(2009)": (V.replace_at(L("2009"), 3, 2, "10"), "2010"),
        "REPLACE(banana)": (V.replace_at(L("banana"), 2, 3, "XYZ"), "bXYZna"), "REPLACE(abcdefghijk)": (V.replace_at(L("abcdefghijk"), 6, 5, "*"), "abcde*k"), "CLEAN(bell)": (V.clean(L("Hello\x07World")), "HelloWorld"), "CLEAN(blanks)": (V.clean(L("  Hello  ")), "  Hello  "),
        "PROPER(title)": (V.proper(L("this is a title")), "This Is A Title"), "PROPER(o'brien)": (V.proper(L("o'brien")), "O'Brien"), "CHAR(97)": (V.char(L(97)), "a"), "CHAR(256)": (V.char(L(256)), None), "TEXT(phone)": (V.text(X(1234), "0000000"), "0001234"), "VALUE(123)": (V.to_number(L("123")), 123.0),
        "VALUE(50%)": (V.to_number(L("50%")), 0.5), "VALUE($1,000)": (V.to_number(L("$1,000")), 1000.0), "VALUE(abc)": (V.to_number(L("abc")), None), "FIXED(1234.567,1)": (V.fixed(X(1234.567), 1), "1,234.6"), "DOLLAR(1234.567)": (V.dollar(X(1234.567), 2), "$1,234.57"),
        "TEXTBEFORE(2)": (V.text_before(L("a-b-c"), "-", 2), "a-b"), "TEXTBEFORE(none)": (V.text_before(L("abc"), "-"), None), "TEXTAFTER(2)": (V.text_after(L("a-b-c"), "-", 2), "c"), "TEXTAFTER(-1)": (V.text_after(L("a-b-c"), "-", -1), "c"),
        "DATEDIF(Y)": (V.date_dif(D(2020, 1, 1), D(2023, 6, 15), "Y"), 3), "DATEDIF(M)": (V.date_dif(D(2020, 1, 1), D(2023, 6, 15), "M"), 41), "DATEDIF(D)": (V.date_dif(D(2024, 1, 1), D(2024, 1, 10), "D"), 9), "DATEDIF(MD)": (V.date_dif(D(2024, 1, 31), D(2024, 3, 1), "MD"), -1), "DATEDIF(reversed)": (V.date_dif(D(2024, 1, 10), D(2024, 1, 1), "D"), None), "DATEDIF(YD)": (V.date_dif(D(2020, 3, 1), D(2024, 2, 29), "YD"), 365), "DATEDIF(MD, same day)": (V.date_dif(D(2024, 1, 15), D(2024, 3, 15), "MD"), 0),
        "EDATE(+1)": (V.to_serial(V.edate(D(2024, 1, 31), 1)), 45351.0), "EDATE(-2)": (V.to_serial(V.edate(D(2024, 3, 15), -2)), 45306.0), "EDATE(3)": (V.to_serial(V.edate(D(2023, 11, 15), 3)), 45337.0), "EDATE(1.9)": (V.to_serial(V.edate(D(2024, 1, 1), 1.9)), 45323.0),
        "EOMONTH(0)": (V.to_serial(V.eomonth(D(2024, 3, 15), 0)), 45382.0), "EOMONTH(1)": (V.to_serial(V.eomonth(D(2024, 3, 15), 1)), 45412.0), "EOMONTH(-1)": (V.to_serial(V.eomonth(D(2024, 3, 15), -1)), 45351.0), "EOMONTH(year)": (V.to_serial(V.eomonth(D(2024, 12, 15), 1)), 45688.0),
        "NETWORKDAYS(week)": (V.workdays(D(2024, 1, 1), D(2024, 1, 5)), 5), "NETWORKDAYS(reversed)": (V.workdays(D(2024, 1, 5), D(2024, 1, 1)), -5), "NETWORKDAYS(weekend)": (V.workdays(D(2024, 1, 6), D(2024, 1, 7)), 0), "TIME(13,30,0)": (V.time_of(13, 30, 0), 0.5625), "TIME(25,0,0)": (V.time_of(25, 0, 0), 1 / 24),
        "TIMEVALUE(6:00 AM)": (V.time_value(L("6:00 AM")), 0.25), "PMT": (F.round(V.pmt(0.06 / 12, 360, -300000.0), 2), 1798.65), "FV": (F.round(V.fv(0.05 / 12, 120, -100.0, 0.0), 2), 15528.23), "PV": (F.round(V.pv(0.1, 5, -1000.0), 2), 3790.79), "NPER": (F.round(V.nper(0.1, -1000.0, 5000.0), 4), 7.2725),
        "RATE": (F.round(V.rate(360, -1798.65, 300000.0) * 12, 4), 0.06), "IPMT": (F.round(V.ipmt(0.005, 1, 360, -300000.0), 2), 1500.0), "PPMT": (F.round(V.ppmt(0.005, 1, 360, -300000.0), 2), 298.65), "EFFECT": (F.round(V.effect(X(0.06), 12), 6), 0.061678), "NOMINAL": (F.round(V.nominal(X(0.061678), 12), 4), 0.06),
        "SLN": (V.sln(X(10000), X(1000), 5), 1800.0), "SYD": (V.syd(X(10000), X(1000), 5, 1), 3000.0), "DDB": (V.ddb(X(10000), X(1000), 5, 1), 4000.0), "DB": (V.db(X(10000), X(1000), 5, 1), 3690.0), "CONVERT(100,C,F)": (V.convert(X(100), "C", "F"), 212.0), "CONVERT(1,day,hr)": (V.convert(X(1), "day", "hr"), 24.0),
        "N(hello)": (C.as_n(L("hello")), 0.0), "N(7)": (C.as_n(L("7")), 7.0), "N(TRUE)": (C.as_n(L("TRUE")), 1.0),
    }


def test_scalars(spark):
    known = scalars()
    row = spark.range(1).select(*(c.alias(str(i)) for i, (c, _) in enumerate(known.values()))).first()
    wrong = {name: (row[i], expected) for i, (name, (_, expected)) in enumerate(known.items()) if row[i] != (pytest.approx(expected) if isinstance(expected, float) else expected)}
    assert not wrong


GROUPS = {
    "2468": [2, 4, 6, 8], "skips": [10, "skip me", 20, None, 30], "texts": ["a", "b", "c"], "53819": [5, 3, 8, 1, 9], "51937": [5, 1, 9, 3, 7], "1234": [1, 2, 3, 4], "42": [42], "11223": [1, 1, 2, 2, 3], "44423": [4, 4, 4, 2, 3], "12234": [1, 2, 2, 3, 4], "55333": [5, 5, 3, 3, 3], "1122": [1, 1, 2, 2],
    "negative": [-4, -4, 7], "123": [1, 2, 3], "ten": list(range(1, 11)), "12345": [1, 2, 3, 4, 5], "trim": [2, 4, 4, 4, 100], "1,4,16": [1, 4, 16], "236": [2, 3, 6], "13": [1, 3], "777": [7, 7, 7], "246": [2, 4, 6], "eight": [2, 4, 4, 4, 5, 5, 7, 9], "10,20": [10, 20], "2": [2], "24x": [2, 4, "x"], "5555x": [5, 5, 5, 5, "x"],
    "minus": [-2, -4, -6], "12,18": [12, 18], "4,6": [4, 6], "ranks": [10, 20, 20, 30, 40], "prank": [10, 20, 30, 40],
}


@pytest.fixture(scope="module")
def groups(spark):
    rows = [(k, i, None if v is None else str(v)) for k, vs in GROUPS.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "k string, pos long, v string").cache()


def by(df, *columns):
    return {r["k"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_aggregates(groups):
    average = by(A.agg_basic(groups, ["k"], "v"), "average")
    assert (average["2468"], average["skips"], average["texts"]) == (5, 20, None)
    order = by(A.order_stats(groups, ["k"], "v", [0, 0.25, 0.5, 1, 1.5], [0.25, 0.5, 0.75], [0, 1, 2, 6]), "large_0", "large_1", "large_2", "large_6", "small_0", "small_1", "small_2", "small_6", "inc_0", "inc_25", "inc_50", "inc_100", "inc_150", "exc_25", "exc_50", "exc_75")
    assert order["53819"][:8] == (None, 9, 8, None, None, 1, 3, None)
    assert {k: order[k][10] for k in ("51937", "1234", "skips", "42", "ten")} == {"51937": 5, "1234": 2.5, "skips": 20, "42": 42, "ten": 5.5}
    assert (order["ten"][8], order["ten"][11], order["123"][12], order["1234"][9], order["12345"][13:]) == (1, 10, None, 1.75, (1.5, 3, 4.5))
    assert {k: v for k, v in by(A.mode_first(groups, ["k"], "v", "pos"), "mode").items() if k in ("12234", "55333", "1122", "negative", "123")} == {"12234": 2, "55333": 3, "1122": 1, "negative": -4, "123": None}
    modes = {k: sorted(r["mode"] for r in A.mode_all(groups.where(F.col("k") == k), ["k"], "v").collect()) for k in ("11223", "44423")}
    assert modes == {"11223": [1, 2], "44423": [4]}
    s = by(A.spread_means(groups, ["k"], "v"), "sd_p", "sd_s", "var_s", "var_p", "sd_a", "sd_pa", "var_a", "avedev", "devsq", "geomean", "harmean")
    near = pytest.approx
    assert s["eight"][:4] == (2, near(2.138089935299395), near(4.571428571428571), 4) and s["10,20"][:4] == (5, near(7.0710678118654755), 50, 25) and s["2"][:3] == (0, None, None)
    assert (s["246"][4], s["24x"][4], s["24x"][6], s["5555x"][5], s["minus"][2], s["12345"][8], s["246"][8], s["777"][7:9]) == (2, near(2), near(4), near(2), 4, near(10), near(8), (0, 0))
    assert (s["2468"][7], s["13"][7], s["1,4,16"][9], s["236"][10], s["13"][10]) == (2, 1, near(4), near(3), near(1.5))
    assert by(A.trim_mean(groups, ["k"], "v", 0.4), "trimmean")["trim"] == 4
    found = by(A.gcd_lcm(groups, ["k"], "v"), "gcd", "lcm")
    assert found["12,18"][0] == 6 and found["4,6"][1] == 12
    one = groups.where("k = 'prank'")
    assert [W.percent_rank_of(one, ["k"], "v", x).first()["percent_rank"] for x in (30, 10, 40, 25)] == [0.666, 0, 1, 0.5]  # cut off after three digits
    ranks = {r.pos: (r.rank_eq, r.rank_avg) for r in W.rank_rows(groups.where("k = 'ranks'").withColumn("v", A.number("v")), ["k"], "v", "pos").collect()}
    up = {r.pos: (r.rank_eq, r.rank_avg) for r in W.rank_rows(groups.where("k = 'ranks'").withColumn("v", A.number("v")), ["k"], "v", "pos", ascending=True).collect()}
    assert (ranks[1], ranks[3], up[1], up[3]) == ((3, 3.5), (2, 2.0), (2, 2.5), (4, 4.0))
    assert [r.scan for r in W.scan(groups.where("k = '123'"), ["k"], "pos", A.number("v"), "sum").orderBy("pos").collect()] == [1, 3, 6]
    assert [r.n for r in T.frequency(groups.where("k = '12345'").withColumn("v", A.number("v")), "v", [2, 4]).orderBy("bin").collect()] == [2, 2, 1]
    totals = A.subtotal_codes(groups.where("k = '1234'"), ["k"], "v", [3, 9]).first()
    assert (totals.code_3, totals.code_9) == (4, 10)


def test_conditions(spark):
    cells = [(10, 1, 1, "apple"), (20, 2, 2, "Apple"), (30, 3, 3, "banana"), (40, 4, 9, "avocado"), (50, 5, 9, "fig")]
    df = spark.createDataFrame(cells, "a int, b int, c int, t string")
    tests = {"gt": [("b", ">2")], "two": [("b", ">1"), ("c", "<5")], "none": [("b", ">100")], "word": [("t", "a*")]}
    r = A.agg_if(df, [], "a", tests).first()
    assert [(r[f"{n}_sum"], r[f"{n}_max"], r[f"{n}_min"], r[f"{n}_count"]) for n in tests] == [(120, 50, 30, 3), (50, 30, 20, 2), (0, 0, 0, 0), (70, 40, 10, 3)]
    assert [df.where(criterion(F.col("t"), x)).count() for x in ("a*", "APPLE")] == [3, 2] and df.where(criterion(F.col("a"), ">25")).count() == 3
    sales = spark.createDataFrame([("East", 100), ("West", 200), ("East", 50)], "Region string, Sales int")
    asked = lambda **c: J.db_aggregate(sales, [c], "Sales").first()
    east = asked(Region="East")
    assert (east.dsum, east.daverage, east.dcount, east.dmax, east.dmin, east.dget) == (150, 75, 2, 100, 50, None)
    assert (asked(Sales=">75").dsum, asked(Sales=">75").daverage, asked(Sales=">=50").dcount, asked(Region="West").dget, J.db_aggregate(sales, [{"Region": "East"}], 2).first().dsum) == (300, 150, 3, 200, 150)


def test_pairs_and_flows(spark):
    pairs = {"line": [(1, 2), (2, 4), (3, 6)], "five": [(1, 2), (2, 4), (3, 6), (4, 8), (5, 10)], "flat": [(1, 5), (2, 5), (3, 5)], "steps": [(1, 3), (2, 5), (3, 7)], "bent": [(1, 2), (2, 1), (3, 2)], "doubling": [(1, 2), (2, 4), (3, 8)], "two": [(2, 10), (3, 20)]}
    df = spark.createDataFrame([(k, float(x), float(y)) for k, xy in pairs.items() for x, y in xy], "k string, x double, y double")
    b = by(A.bivariate(df, ["k"], "y", "x"), "correl", "covar_p", "covar_s", "slope", "intercept", "rsq")
    near = pytest.approx
    assert (b["line"][0], b["five"][1], b["five"][2], b["flat"][1], b["flat"][2], b["steps"][3], b["steps"][4], b["line"][5], b["bent"][5]) == (near(1), near(4), near(5), 0, 0, near(2), near(1), near(1), near(0, abs=1e-12))
    at = {(r.k, r.x): (r.linear, r.growth) for r in A.linear_predict(df, ["k"], "y", "x", [2.5, 4.0, 5.0]).collect()}
    assert (at["two", 2.5][0], at["line", 5.0][0], at["doubling", 4.0][1]) == (near(15), near(10), near(16))
    day = lambda n: datetime.date(1899, 12, 30) + datetime.timedelta(n)
    flows = spark.createDataFrame([("npv", i, day(46023 + i), v) for i, v in enumerate((100.0, 200.0, 300.0))] + [("irr", i, day(46023 + i), v) for i, v in enumerate((-1000.0, 500.0, 500.0, 500.0))] + [("x", 1, day(46023), -1000.0), ("x", 2, day(46388), 1100.0)], "k string, pos int, day date, v double")
    worth = by(A.npv(flows, ["k"], 0.1, "v", "pos", "day"), "npv", "xnpv")
    assert round(worth["npv"][0], 2) == 481.59 and worth["x"][1] == near(0, abs=1e-9)
    assert round(by(A.irr(flows, ["k"], "v", "pos", days=False), "irr")["irr"], 3) == 0.234 and round(by(A.irr(flows, ["k"], "v", "day"), "xirr")["x"], 3) == 0.1


def test_joined_texts(spark):
    df = spark.createDataFrame([("e", 1, "a"), ("e", 2, ""), ("e", 3, "b"), ("x", 1, "x"), ("x", 2, "y"), ("x", 3, "z"), ("n", 1, None)], "k string, pos int, v string")
    assert by(A.text_agg(df, ["k"], "v", "pos", ","), "joined") == {"e": "a,b", "x": "x,y,z", "n": ""}
    assert by(A.text_agg(df, ["k"], "v", "pos", ",", skip_empty=False), "joined") == {"e": "a,,b", "x": "x,y,z", "n": ""}


def test_arrays(spark):
    grid = spark.range(1).select(F.to_json(C.make_array(2, 2, lambda r, c: r * c)).alias("g")).first().g
    assert json.loads(grid) == [[1, 2], [2, 4]]
    assert [len(r) for r in C.random_array(spark.range(1), ["id"], 2, 3, 1).first().random] == [3, 3]
