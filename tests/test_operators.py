"""Operators on the rows that every fixture should have: blanks, text, errors, ties, single and empty groups."""

import datetime

import pytest
from pyspark.sql import functions as F

from quiltgrid.operators import aggregates as A
from quiltgrid.operators import columns as C
from quiltgrid.operators import compat as P
from quiltgrid.operators import lookups as J
from quiltgrid.operators import tables as T
from quiltgrid.operators import windows as W
from quiltgrid.sources import readers as S

CELLS = [("g", 1, "5"), ("g", 2, "x"), ("g", 3, ""), ("g", 4, None), ("g", 5, "#N/A"), ("g", 6, "TRUE"), ("g", 7, "5"), ("g", 8, "-2.5"), ("one", 9, "7"), ("none", 10, "text")]


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame(CELLS, "k string, pos long, v string")


def by(df, key="k"):
    return {r[key]: r for r in df.collect()}


def test_sums_skip_what_is_no_number(cells):
    r = by(A.agg_basic(cells, ["k"], "v"))
    assert (r["g"]["sum"], r["g"]["average"], r["g"]["min"], r["g"]["max"], r["g"]["sumsq"]) == (7.5, 2.5, -2.5, 5.0, 56.25)
    assert (r["none"]["sum"], r["none"]["average"], r["none"]["min"], r["none"]["max"]) == (0.0, None, 0.0, 0.0)
    assert A.agg_basic(cells.limit(0), [], "v").first()["sum"] == 0.0


def test_counts(cells):
    r = by(A.count_kinds(cells, ["k"], "v"))["g"]
    assert (r["numbers"], r["non_empty"], r["blanks"]) == (3, 7, 2)


def test_mode_takes_the_first_of_ties(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([3.0, 1.0, 1.0, 3.0, 2.0])] + [("b", 9, 1.0)], "k string, pos long, v double")
    r = by(A.mode_first(df, ["k"], "v", "pos"))
    assert (r["a"]["mode"], r["a"]["modes"], r["b"]["mode"], r["b"]["modes"]) == (3.0, 2, None, 0)
    assert {(x["k"], x["mode"]) for x in A.mode_all(df, ["k"], "v").collect()} == {("a", 1.0), ("a", 3.0)}


def test_order_statistics_out_of_range(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 4.0)] + [("b", 9.0)], "k string, v double")
    r = by(A.order_stats(df, ["k"], "v", [0.5], [0.1, 0.5], [1, 2]))
    assert (r["a"]["inc_50"], r["a"]["exc_10"], r["a"]["exc_50"], r["a"]["large_2"], r["b"]["inc_50"], r["b"]["large_2"], r["b"]["small_1"]) == (2.0, None, 2.0, 2.0, 9.0, None, 9.0)


def test_spreads_count_text_as_zero(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "3"), ("a", "x"), ("a", None)], "k string, v string")
    r = by(A.spread_means(df, ["k"], "v"))["a"]
    assert (r["var_s"], r["sd_p"], r["devsq"]) == (2.0, 1.0, 2.0) and r["sd_pa"] == pytest.approx(1.2472191289)


def test_finance(spark):
    loan = spark.createDataFrame([(1, 0.01, 12, 1000.0), (2, 0.0, 4, 100.0)], "id int, r double, n int, p double")
    rows = A.loan_schedule(loan, "r", "n", "p").groupBy("id").agg(F.sum("principal_part").alias("p"), F.min_by("balance", -F.col("period")).alias("b"), F.min("payment").alias("pay")).collect()
    r = {x.id: x for x in rows}
    assert r[1].p == pytest.approx(1000) and r[1].b == pytest.approx(0, abs=1e-9) and r[1].pay == pytest.approx(88.84878868)
    assert (r[2].p, r[2].pay) == (100.0, 25.0)
    day = datetime.date
    flows = spark.createDataFrame([("a", day(2008, 1, 1), -10000.0), ("a", day(2008, 3, 1), 2750.0), ("a", day(2008, 10, 30), 4250.0), ("a", day(2009, 2, 15), 3250.0), ("a", day(2009, 4, 1), 2750.0), ("b", day(2008, 1, 1), 5.0)], "k string, d date, v double")
    r = by(A.irr(flows, ["k"], "v", "d"))
    assert r["a"]["xirr"] == pytest.approx(0.37336253) and r["b"]["xirr"] is None


def test_lookups(spark):
    table = spark.createDataFrame([("a", 2, "second"), ("a", 1, "first"), ("b", 3, None)], "key string, pos int, value string")
    asked = spark.createDataFrame([("a",), ("b",), ("A",), (None,)], "k string")
    r = {x.k: (x.value, x.found) for x in J.lookup(asked, table, "k", "key", "value", "pos", "none").collect()}
    assert r == {"a": ("first", True), "b": (None, True), "A": ("none", False), None: ("none", False)}
    steps = spark.createDataFrame([(10.0, "ten"), (20.0, "twenty")], "edge double, label string").withColumn("g", F.lit(1))
    points = spark.createDataFrame([(1, x) for x in (5.0, 10.0, 15.0, 25.0)], "g int, x double")
    below = {r.x: r.label for r in J.lookup_approx(points, steps, ["g"], "x", "edge", ["label"]).collect()}
    above = {r.x: r.label for r in J.lookup_approx(points, steps, ["g"], "x", "edge", ["label"], next_larger=True).collect()}
    assert below == {5.0: None, 10.0: "ten", 15.0: "ten", 25.0: "twenty"} and above == {5.0: "ten", 10.0: "ten", 15.0: "twenty", 25.0: None}
    assert by(J.lookup_last(table.withColumn("k", F.lit("x")), ["k"], "value", "pos"))["x"]["last_non_blank"] == "second"


def test_criteria_table(spark):
    df = spark.createDataFrame([("Apple", 10.0), ("pear", 5.0), ("apple", None)], "fruit string, n double")
    r = J.db_aggregate(df, [{"fruit": "APPLE", "n": ">3"}, {"fruit": "pea*"}], "N").first()
    assert (r.dsum, r.dcount, r.dmin, r.dmax, r.dget) == (15.0, 2, 5.0, 10.0, None)
    assert J.db_aggregate(df, [{"fruit": "pear"}], 2).first().dget == 5.0
    assert J.db_aggregate(df, [{"fruit": "fig"}], "n").first().dsum == 0.0


def test_tables(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(1, 8)], "pos long, v long")
    assert {(r.v, r.first_pos) for r in T.unique_rows(df, ["v"], "pos").collect()} == {(1, 1), (2, 2), (0, 3)}
    assert [(r.pos, r.place) for r in T.numbered(df, [F.col("v").desc(), "pos"], "place").orderBy("place").collect()] == [(2, 1), (5, 2), (1, 3), (4, 4), (7, 5), (3, 6), (6, 7)]
    assert sorted(r.pos for r in T.drop_rows(df, ["pos"], 5).collect()) == [6, 7] and T.drop_rows(df, ["pos"], 0).count() == 7
    assert [r.v for r in T.filter_rows(df, F.col("v") > 9, {"v": -1}).collect()] == [-1] and T.filter_rows(df, F.col("v") > 9).count() == 0
    assert [(r.bin, r.n) for r in T.frequency(df, "v", [0, 1, 5]).orderBy("bin").collect()] == [(0, 2), (1, 3), (2, 2), (3, 0)]
    assert sorted((r.out_pos, r.pos) for r in T.choose_rows(df, "pos", [2, -1, 2]).collect()) == [(0, 2), (1, 7), (2, 2)]


def test_windows(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([2.0, 0.0, 2.0, 4.0])], "k string, pos long, v double")
    r = {x.pos: x for x in W.rank_rows(df, ["k"], "v", "pos").collect()}
    assert [(r[i].rank_eq, r[i].rank_avg, r[i].rank_unique) for i in range(4)] == [(2, 2.5, 2), (4, 4.0, 4), (2, 2.5, 3), (1, 1.0, 1)]
    r = {x.pos: x for x in W.row_change(df, ["k"], "v", "pos").collect()}
    assert [(r[i].difference, r[i].change) for i in range(4)] == [(None, None), (-2.0, -1.0), (2.0, None), (2.0, 1.0)]
    text = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, ""), ("a", 4, None)], "k string, pos long, v string")
    assert [x.filled for x in W.fill_down(text, ["k"], "v", "pos").orderBy("pos").collect()] == [None, "x", "x", "x"]


def test_verdicts(spark):
    rows = [("good", True, None), ("good", None, None), ("unknown", False, "#NAME?"), ("odd", False, None), ("odd", True, None), ("probe", None, "#N/A")]
    df = spark.createDataFrame(rows, "k string, m boolean, e string")
    assert {k: r.verdict for k, r in by(P.group_verdict(df, ["k"], F.col("m"), F.col("e"), F.col("e"))).items()} == {"good": "supported", "unknown": "unsupported", "odd": "quirky", "probe": "quirky"}
    kinds = C.type_profile(spark.createDataFrame(CELLS, "k string, pos long, v string"), ["v"]).first()
    assert (kinds.blank, kinds.number, kinds.bool, kinds.error, kinds.text, kinds.odd, kinds.even) == (1, 4, 1, 1, 3, 3, 1)


def test_reading_cases(spark, tmp_path):
    (tmp_path / "F.json").write_text('{"function": "F",\n "cases": [{"id": "1", "formula": "=F(1)", "expected": 5, "setup_cells": {"A1": 1, "A2": "x"}}, {"id": "2", "formula": "=F(2)", "expected": "#N/A"}, {"id": "3", "formula": "=F(3)", "expected": [[1, 2], [3, 4]], "check_range": "A1:B2"}, {"id": "4", "formula": "=F(4)", "expected": null}, {"id": "5", "formula": "=F(5)", "expected": true}]}')
    r = by(S.read_cases(spark, str(tmp_path)), "id")
    assert [r[str(i)].expected_kind for i in range(1, 6)] == ["num", "err", "array", "null", "bool"]
    assert (r["1"].n_cells, r["1"].expected_text, r["3"].expected_text, r["2"].n_cells) == (2, "5", "[[1,2],[3,4]]", 0)


def test_sums_of_tiny_huge_and_odd_values(spark):
    df = spark.createDataFrame([("a", 0.00001, True), ("a", 0.00001, False), ("a", 0.00001, True), ("b", 1e21, None), ("b", 2e10, True), (None, 3.0, True), ("n", float("nan"), None), ("n", float("inf"), None), ("n", 2.0, None)], "k string, v double, t boolean")
    r = by(A.agg_basic(df, ["k"], "v"))
    assert r["a"]["sum"] == pytest.approx(3e-5) and r["b"]["sum"] == pytest.approx(1e21) and r["b"]["sumsq"] == pytest.approx(1e42)
    assert (r[None]["sum"], r["n"]["sum"], r["n"]["average"], r["n"]["max"]) == (3.0, 2.0, 2.0, 2.0)
    r = by(A.agg_basic(df, ["k"], "t"))["a"]
    assert (r["sum"], r["average"], by(A.count_kinds(df, ["k"], "t"))["a"]["numbers"]) == (0.0, None, 0)
    text = spark.createDataFrame([("a", x) for x in ("NaN", "Infinity", "2", " 3.5 ", "1e2", "5d", "0x1F", "-")], "k string, v string")
    assert by(A.agg_basic(text, ["k"], "v"))["a"]["sum"] == 105.5
    s = by(A.spread_means(df, ["k"], "v"))
    assert s[None]["devsq"] == 0 and s["a"]["harmean"] == pytest.approx(1e-5)
    z = by(A.spread_means(spark.createDataFrame([("z", 0.0), ("z", 1.0), ("m", -1.0), ("m", 4.0)], "k string, v double"), ["k"], "v"))
    assert (z["z"]["harmean"], z["z"]["geomean"], z["m"]["geomean"]) == (None, None, None)
    assert A.spread_means(df.where("k = 'a'"), [], "v").first()["avedev"] == pytest.approx(0, abs=1e-12)
    a = by(A.spread_means(spark.createDataFrame([("a", "2"), ("a", "4"), ("a", "x")], "k string, v string"), ["k"], "v"))["a"]
    assert a["var_a"] == 4


def test_shares_of_nothing(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 0.0), ("b", 3, 1e-9), ("b", 4, -1e-9)], "k string, pos long, v double")
    assert [r["running_share"] for r in W.running(df, ["k"], "v", "pos").collect()] == [None] * 4
    assert [r["share"] for r in W.share_of_total(df, ["k"], "v", "pos").collect()] == [None] * 4
    assert by(W.normalize(df, ["k"], "v"), "pos")[3]["scaled"] == 1.0 and W.normalize(df, [], "v").count() == 4


def test_percent_rank_of_ties_and_nulls(spark):
    rows = [("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 7.0), ("a", 4, None), (None, 5, 1.0), (None, 6, 2.0), ("b", 7, 3.0)]
    found = by(W.percent_rank_at(spark.createDataFrame(rows, "k string, pos long, v double"), ["k"], "v"), "pos")
    assert {p: r["rank_inc"] for p, r in found.items()} == {1: 0.0, 2: 0.0, 3: 1.0, 4: None, 5: 0.0, 6: 1.0, 7: 1.0}  # blanks are skipped
    assert {p: r["rank_exc"] for p, r in found.items()} == {1: 0.25, 2: 0.25, 3: 0.75, 4: None, 5: 0.333, 6: 0.666, 7: 0.5}


def test_groups_without_keys(spark):
    df = spark.createDataFrame([(12, 1, -1000.0), (18, 2, 500.0), (18, 3, 500.0), (30, 4, 500.0)], "v long, pos long, flow double")
    r = A.gcd_lcm(df, [], "v").first()
    assert (r["gcd"], r["lcm"]) == (6, 180.0)
    assert A.irr(df, [], "flow", "pos", days=False).first()["irr"] == pytest.approx(0.2337519, abs=1e-6)
    assert A.irr(df.where("flow > 0").selectExpr("'x' k", "flow", "pos"), ["k"], "flow", "pos", days=False).first()["irr"] is None
    fast = spark.createDataFrame([(1, -1.0), (2, 5000.0)], "pos long, flow double")
    assert A.irr(fast, [], "flow", "pos", days=False).first()["irr"] == pytest.approx(4999, rel=1e-6)


def test_function_codes(spark):
    df = spark.createDataFrame([(x, i == 0, i == 4) for i, x in enumerate(("10", "20", "x", None, "30"))], "v string, sub boolean, hid boolean")
    r = A.subtotal_codes(df, [], "v", [1, 2, 3, 4, 5, 6, 9, 12, 109, 102], F.col("sub"), is_hidden=F.col("hid")).first().asDict()
    assert r == {"code_1": 25, "code_2": 2, "code_3": 3, "code_4": 30, "code_5": 20, "code_6": 600, "code_9": 50, "code_12": 25, "code_109": 20, "code_102": 1}


def test_columns_taken_and_dropped(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert [f(df, n).columns for f, n in ((T.take_columns, 2), (T.take_columns, -1), (T.drop_columns, 1), (T.drop_columns, -2))] == [["a", "b"], ["c"], ["b", "c"], ["a"]]


def test_one_of_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from quiltgrid.session import shared_dir

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(far)
