"""Rules for nulls, text, ties, clashing names and extremes, and operators held against plain Python."""

import fnmatch
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiltgrid.functions.criteria import criterion
from quiltgrid.operators import aggregates as A
from quiltgrid.operators import columns as C
from quiltgrid.operators import compat as P
from quiltgrid.operators import lookups as J
from quiltgrid.operators import smoothing as E
from quiltgrid.operators import tables as T
from quiltgrid.operators import windows as W


def by(df, key="k"):
    return {r[key]: r for r in df.collect()}


def test_places_of_nulls_and_text(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None), ("a", 3, 9.0), ("a", 4, 9.0), ("n", 5, None)], "k string, pos long, v double")
    r = by(W.position_of_max(df, ["k"], "v", "pos"))
    assert (r["a"]["max_value"], r["a"]["max_pos"], r["n"]["max_value"], r["n"]["max_pos"]) == (9.0, 3, None, None)
    ranks = by(W.percent_rank_at(spark.createDataFrame([("a", 1, "1"), ("a", 2, None), ("a", 3, "3"), ("a", 4, "x"), ("a", 5, "")], "k string, pos long, v string"), ["k"], "v"), "pos")
    assert {p: r["rank_inc"] for p, r in ranks.items()} == {1: 0.0, 2: None, 3: 1.0, 4: None, 5: None}
    one = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("b", 2.0)], "k string, v double")
    assert {k: r["percent_rank"] for k, r in by(W.percent_rank_of(one, ["k"], "v", 3)).items()} == {"a": 1.0, "b": None}
    assert by(W.percent_rank_of(one, ["k"], "v", 1.5))["b"]["percent_rank"] == 0.5


def test_columns_that_swap_values_differ(spark):
    df = spark.createDataFrame([(1, 2, 1, None), (2, 1, 2, None)], "a int, b int, c int, d int")
    assert T.unique_columns(df, ["a", "b", "c", "d"]) == ["a", "b", "d"]
    assert T.unique_columns(df.select("a", "b"), ["a", "b"]) == ["a", "b"]


def test_dropping_rows_of_ties(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "v int")
    assert sorted(r.v for r in T.drop_rows(df, ["v"], 1).collect()) == [1, 1, 2]
    assert [r.v for r in T.drop_rows(df, [F.col("v").desc()], 1).collect()] == [1, 1, 1]
    assert T.drop_rows(df, ["v"], 9).count() == 0


def test_keys_of_inner_names(spark):
    df = spark.createDataFrame([("p", "q", 1.0), ("p", "q", 3.0), ("r", "q", 5.0)], "x string, n string, v double")
    assert {r.x: r.var_s for r in A.spread_means(df, ["x"], "v").collect()} == {"p": 2.0, "r": None}
    assert {(r.x, r.n, r.inc_50) for r in A.order_stats(df, ["x", "n"], "v", [0.5], [], []).collect()} == {("p", "q", 2.0), ("r", "q", 5.0)}
    assert {(r.x, r.trimmean) for r in A.trim_mean(df, ["x"], "v", 0.1).collect()} == {("p", 2.0), ("r", 5.0)}
    modes = A.mode_first(df.union(df), ["x"], "v", "v").collect()
    assert {(r.x, r["mode"], r.modes) for r in modes} == {("p", 1.0, 2), ("r", 5.0, 1)}
    assert {(r.x, r["mode"]) for r in A.mode_all(df.union(df), ["x"], "v").collect()} == {("p", 1.0), ("p", 3.0), ("r", 5.0)}


CELLS = ["apple", "Apple pie", "5", "7.5", "TRUE", "", None, "zebra"]


@pytest.mark.parametrize(
    ("text", "met"),
    [
        (5, {"5"}), ("=5", {"5"}), (">5", {"7.5"}), ("<banana", {"apple", "Apple pie"}), (">=banana", {"TRUE", "zebra"}), ("apple*", {"apple", "Apple pie"}), ("<>5", {"apple", "Apple pie", "7.5", "TRUE", "", None, "zebra"}),
        (True, {"TRUE"}), ("", {"", None}), ("<>", {"apple", "Apple pie", "5", "7.5", "TRUE", "zebra"}), ("=1", set()),
    ],
)
def test_criteria_of_text_cells(spark, text, met):
    df = spark.createDataFrame([(c,) for c in CELLS], "v string")
    assert {r.v for r in df.where(criterion(F.col("v"), text)).collect()} == met


def test_criteria_of_other_types(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, False), (None, None)], "x double, b boolean")
    met = lambda c, t: sorted(str(r[c]) for r in df.where(criterion(F.col(c), t)).collect())
    assert met("x", "<apple") == [] and met("x", "apple") == [] and met("x", "1*") == [] and met("x", ">1") == ["2.0"] and met("x", "<>apple") == ["1.0", "2.0", "None"]
    assert met("b", "=1") == [] and met("b", 1) == [] and met("b", True) == ["True"] and met("b", "true") == ["True"]


def test_text_and_blanks_are_skipped(spark):
    df = spark.createDataFrame([("a", 1, "1", "2"), ("a", 2, "2", "4"), ("a", 3, "x", "9"), ("a", 4, None, "1"), ("a", 5, "3", "6")], "k string, pos long, x string, y string")
    r = A.bivariate(df, ["k"], "y", "x").first()
    assert (r.slope, r.intercept, r.correl) == pytest.approx((2.0, 0.0, 1.0))
    assert A.linear_predict(df, ["k"], "y", "x", [10.0]).first().linear == pytest.approx(20)
    w = A.weighted(df, ["k"], "x", "y", F.col("pos") > 1).first()
    assert (w.sumproduct, w.weighted_mean, w.masked_sum) == pytest.approx((28.0, 28 / 12, 5.0))
    flows = spark.createDataFrame([(1, "2020-01-01", None), (2, "2020-01-01", "110"), (3, "2021-01-01", "text")], "pos long, d string, v string").withColumn("d", F.to_date("d"))
    n = A.npv(flows, [], 0.1, "v", "pos", "d").first()
    assert (n.npv, n.xnpv) == pytest.approx((100.0, 110.0))
    up = {r.pos: (r.running_sum, r.running_max, r.running_share) for r in W.running(df, ["k"], "x", "pos").collect()}
    assert up == {1: (1.0, 1.0, pytest.approx(1 / 6)), 2: (3.0, 2.0, 0.5), 3: (3.0, 2.0, 0.5), 4: (3.0, 2.0, 0.5), 5: (6.0, 3.0, 1.0)}
    assert [r.share for r in W.share_of_total(df, ["k"], "x", "pos").orderBy("pos").collect()] == [pytest.approx(1 / 6), pytest.approx(1 / 3), None, None, 0.5]
    assert A.ets_forecast(df, ["k"], "pos", "y").first().points == 5
    assert A.ets_forecast(df, ["k"], "pos", "x").first().forecast is not None


def test_multiples_of_many_numbers(spark):
    df = spark.createDataFrame([("far", i) for i in range(1, 1200)] + [("twelve", 4), ("twelve", 6), ("twelve", 4), ("big", 2**61 - 1), ("big", 2 * (2**61 - 1)), ("none", 0), ("none", -3), ("square", 999983 * 999979), ("square", 999983**2), ("thirty", 30)] + [("exact", i) for i in range(1, 60)], "k string, v long")
    r = {x.k: (x.gcd, x.lcm) for x in A.gcd_lcm(df, ["k"], "v").collect()}
    assert r == {
        "far": (1, None), "twelve": (2, 12.0), "big": (2**61 - 1, float(2 * (2**61 - 1))), "square": (999983, float(999983**2 * 999979)), "thirty": (30, 30.0), "exact": (1, float(math.lcm(*range(1, 60)))),
    }
    assert A.gcd_lcm(df.where("k = 'twelve'"), [], "v").first().lcm == 12.0
    for x in (1, 2, 97, 2**40, 600851475143, 2**61 - 1, 1000003 * 1000033):
        assert math.prod(p**e for p, e in A.prime_powers(x)) == x


def test_loans_without_periods(spark):
    loans = spark.createDataFrame([(1, 0.1, 0, 5.0), (2, 0.1, None, 5.0), (3, 0.0, 1, 5.0), (4, 0.1, -2, 5.0)], "id int, r double, n int, p double")
    assert [(r.id, r.period, r.payment) for r in A.loan_schedule(loans, "r", "n", "p").collect()] == [(3, 1, 5.0)]


def test_joined_numbers_and_long_texts(spark):
    df = spark.createDataFrame([("a", 2, 2.5), ("a", 1, 1.0), ("a", 3, None)], "k string, pos long, v double")
    r = A.text_agg(df, ["k"], "v", "pos", ", ").first()
    assert (r.joined, r.array_text) == ("1.0, 2.5", '{"1.0","2.5"}')
    long = spark.createDataFrame([("a", i, "x" * 1000) for i in range(32)] + [("b", i, "y" * 1000) for i in range(33)] + [("c", 1, None), ("d", 1, "z" * 32_767)], "k string, pos long, v string")
    r = by(A.text_agg(long, ["k"], "v", "pos", "|"))
    assert (len(r["a"]["joined"]), r["b"]["joined"], r["c"]["joined"], len(r["d"]["joined"])) == (32_031, "#VALUE!", "", 32_767)
    assert (r["b"]["array_text"], r["d"]["array_text"]) == ("#VALUE!", "#VALUE!")


def test_null_keys_are_equal(spark):
    a = spark.createDataFrame([(None, 1, 5.0), ("x", 1, 6.0), ("y", None, 7.0)], "k string, l int, v double")
    r = P.compare_tables(a, a.withColumn("v", F.col("v") + F.when(F.col("k") == "x", 1).otherwise(0)), ["k", "l"], ["v"]).collect()
    assert {(x.k, x.l, x.matched, x.detail) for x in r} == {(None, 1, True, None), ("x", 1, False, "v"), ("y", None, True, None)}
    extra = P.compare_tables(a.where("k = 'x'"), a, ["k", "l"], ["v"]).collect()
    assert {(x.k, x.matched) for x in extra} == {(None, None), ("x", True), ("y", None)}
    found = J.lookup_composite(a.select("k", "l"), a.withColumn("pos", F.lit(1)), ["k", "l"], "v", "pos").collect()
    assert {(x.k, x.l, x.v) for x in found} == {(None, 1, 5.0), ("x", 1, 6.0), ("y", None, 7.0)}


def test_names_are_written_as_listed(spark):
    texts = ["=sum(1)+mysum(2)", "=SUM (1)", "=Ceiling.Math(1)+ceiling(2)", "=_x.SUM(3)", "=sum.x(1)"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r.o for r in df.select(P.rewrite_tokens(F.col("t"), {"SUM": "_x.", "CEILING.MATH": "_x.", "CEILING": "_$y."}).alias("o")).collect()]
    assert out == ["=_x.SUM(1)+mysum(2)", "=SUM (1)", "=_x.CEILING.MATH(1)+_$y.CEILING(2)", "=_x.SUM(3)", "=sum.x(1)"]


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_related_items_with_tokens_that_all_share(spark, hot):
    rng = random.Random(hot)
    owns = {i: {"all", *(f"t{rng.randint(0, 25)}" for _ in range(rng.randint(0, 4))), *(["half"] if i % 2 else [])} for i in range(40)}
    groups = {f"g{i}": {*(f"t{rng.randint(0, 25)}" for _ in range(3)), *(["all"] if i % 3 else []), *(["half"] if i == 4 else [])} for i in range(12)}
    items = spark.createDataFrame([(t, i) for i, ts in owns.items() for t in ts] * 2 + [(None, 3), ("all", None)], "token string, item int")
    rank = lambda own, others: sorted(((-len(own & ts), j) for j, ts in others.items() if own & ts))
    expected = {(i, j, -s, n + 1) for i, ts in owns.items() for n, (s, j) in enumerate(rank(ts, {j: x for j, x in owns.items() if j != i})[:5])}
    assert {tuple(r) for r in P.related_items(items, "token", "item", 5, hot=hot).select("item", "other", "score", "place").collect()} == expected
    asked = spark.createDataFrame([(g, t) for g, ts in groups.items() for t in ts], "g string, token string")
    expected = {(g, j, -s, n + 1) for g, ts in groups.items() for n, (s, j) in enumerate(rank(ts, owns)[:6])}
    assert {tuple(r) for r in P.items_for_group(asked, items, "g", "token", "item", 6, hot=hot).select("g", "item", "score", "place").collect()} == expected


def test_columns_are_found_up_to_a_limit(spark):
    df = spark.createDataFrame([("a", 2, 1.0), ("a", 1, 2.0), ("b", 2, 4.0), ("b", None, 8.0)], "r string, c int, v double")
    t = T.pivot_totals(df, "r", "c", None, F.col("v"))
    assert t.columns == ["r", "1", "2", "total", "is_total"]
    assert {(x.r, x["1"], x["2"], x.total) for x in t.collect()} == {("a", 2.0, 1.0, 3.0), ("b", None, 4.0, 12.0), (None, 2.0, 5.0, 15.0)}
    assert T.transpose(df.where("c is not null and r = 'a'"), "c", ["v"]).columns == ["name", "1", "2"]
    assert T.distinct_values(df, "c", most=2) == [1, 2]
    with pytest.raises(ValueError, match="more than 1 "):
        T.distinct_values(df, "c", most=1)


def test_random_numbers_belong_to_rows(spark):
    df = spark.range(4000).select((F.col("id") % 1000).alias("g"), "id")
    once = {r.id: (r.rand, r.rand_between) for r in C.random_columns(df, ["id"], 9, 1, 6).collect()}
    again = {r.id: (r.rand, r.rand_between) for r in C.random_columns(df.repartition(7).orderBy(F.col("id").desc()), ["id"], 9, 1, 6).collect()}
    assert once == again and once != {r.id: (r.rand, r.rand_between) for r in C.random_columns(df, ["id"], 10, 1, 6).collect()}
    x = np.array([v[0] for v in once.values()])
    assert 0 <= x.min() and x.max() < 1 and abs(x.mean() - 0.5) < 0.02 and len(set(x)) == 4000
    counts = np.bincount([v[1] for v in once.values()], minlength=7)
    assert counts[0] == 0 and counts[1:].min() > 560 and counts[1:].max() < 780
    same = C.random_columns(spark.createDataFrame([("a", "bc"), ("ab", "c"), ("ab", "c"), (None, "c")], "p string, q string"), ["p", "q"], 1, 0, 1).collect()
    assert len({r.rand for r in same}) == 3
    picks = [C.random_pick(d, ["g"], ["id"], 3, n) for d in (df, df.repartition(5)) for n in (1, 2)]
    one, two, one_again, two_again = (sorted(tuple(r) for r in p.select("g", "id").collect()) for p in picks)
    assert one == one_again and two == two_again and set(one) <= set(two) and len(one) == 1000 and len(two) == 2000
    place = np.bincount([i // 1000 for _, i in one])
    assert place.min() > 190 and place.max() < 310
    cells = C.random_array(df.limit(50), ["id"], 2, 3, 4).collect()
    flat = [x for r in cells for row in r.random for x in row]
    assert len(cells[0].random) == 2 and len(cells[0].random[0]) == 3 and len(set(flat)) == 300 and 0 <= min(flat) and max(flat) < 1
    with pytest.raises(ValueError, match="RANDARRAY"):
        C.random_array(df, ["id"], 0, 1, 4)


def test_pattern_table(spark):
    rng = random.Random(8)
    letters = "abcABé.*?~\\"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(300)] + ["\\E\\Q", "x\ny", None]
    patterns = {"".join(rng.choice([*letters[:6], *"**??", "~*", "~?", "~~", "."]) for _ in range(rng.randint(0, 6))) for _ in range(300)} | {"*", "?", "??*", "*?", "", "~", "a~", "\\E*", "x?y", "zzz*"}
    table = spark.createDataFrame(list(enumerate(texts)), "pos long, t string").withColumn("value", F.col("pos") * 10)
    asked = spark.createDataFrame([(p,) for p in patterns] * 2 + [(None,)], "p string")

    def plain(pattern):
        out, i = [], 0
        while i < len(pattern):
            if pattern[i] == "~" and pattern[i + 1 : i + 2] in ("*", "?", "~"):
                i += 1
                out.append(f"[{pattern[i]}]")
            else:
                out.append({"[": "[[]"}.get(pattern[i], pattern[i]))
            i += 1
        hits = [10 * k for k, t in enumerate(texts) if t is not None and fnmatch.fnmatchcase(t.lower(), "".join(out).lower())]
        return min(hits, default=None)

    found = {r.p: r.value for r in J.lookup_patterns(asked, table, "p", "t", "pos", "value").collect()}
    assert found == {p: plain(p) for p in patterns}
    few = J.lookup_wildcard(["a*", "a*", "zzz?"], table, "t", "pos", "value").collect()
    assert sorted((r.pattern, r.value) for r in few if r.value is not None) == [("a*", plain("a*"))] * 2 and len(few) == 3


def test_fitted_smoothing(spark):
    t = np.arange(60)
    wave = 50 + 2 * t + 10 * np.sin(2 * np.pi * t / 6)
    noise = np.random.default_rng(1).normal(0, 1, 60)
    series = {"line": list(10.0 * (t[:6] + 1)), "wave": list(wave), "gap": [None if i in (7, 20) else float(v) for i, v in enumerate(3.0 * t)], "noisy": list(wave + noise), "short": [1.0, 2.0], "flat": [4.0] * 8}
    df = spark.createDataFrame([(k, i, None if v is None else float(v)) for k, vs in series.items() for i, v in enumerate(vs)], "k string, pos int, v double")
    found = {(r.k, r.step): (r.forecast, r.confint) for r in E.ets_forecasts(df, ["k"], "pos", "v", steps=6).collect()}
    assert {k for k, _ in found} == {"line", "wave", "gap", "noisy", "flat"}
    assert found["line", 1][0] == pytest.approx(70, abs=0.01) and found["gap", 2][0] == pytest.approx(183, abs=0.01) and found["flat", 6] == (pytest.approx(4), pytest.approx(0))
    true = 50 + 2 * (60 + np.arange(6)) + 10 * np.sin(2 * np.pi * (60 + np.arange(6)) / 6)
    assert [found["wave", h][0] for h in range(1, 7)] == pytest.approx(true, abs=1.5)
    assert all(abs(found["noisy", h][0] - true[h - 1]) < 5 for h in range(1, 7))
    widths = [found["noisy", h][1] for h in range(1, 7)]
    assert widths == sorted(widths) and 1 < widths[0] < 6
    stats = by(E.ets_stats(df, ["k"], "pos", "v"))
    assert {k: r["season"] for k, r in stats.items()} == {"line": 1, "wave": 6, "gap": 1, "noisy": 6, "flat": 1}
    n = stats["noisy"]
    y = np.array(series["noisy"])
    sse = lambda a, b, g: float((E.smooth(y, 6, a, b, g)["errors"] ** 2).sum())
    rng = random.Random(2)
    assert sse(n["alpha"], n["beta"], n["gamma"]) <= 1.01 * min(sse(rng.random(), rng.random(), rng.random()) for _ in range(3000))
    assert n["rmse"] == pytest.approx(math.sqrt(sse(n["alpha"], n["beta"], n["gamma"]) / 54)) and n["mase"] < 1


def test_smoothing_by_hand():
    """The state equations, written out for one series."""
    y, a, b, g, m = [3.0, 8.0, 5.0, 9.0, 6.0, 12.0, 7.0, 13.0, 9.0], 0.4, 0.3, 0.2, 2
    trend = (7.0 - 5.5) / 2
    level, season = 5.5 + trend / 2, [3 - 5.5 + trend / 2, 8 - 5.5 - trend / 2]
    errors = []
    for t in range(m, len(y)):
        e = y[t] - level - trend - season[t % m]
        errors.append(e)
        level, trend, season[t % m] = level + trend + a * e, trend + a * b * e, season[t % m] + g * (1 - a) * e
    found = E.smooth(np.array(y), m, a, b, g)
    assert found["errors"][:, 0] == pytest.approx(errors) and found["level"][0] == pytest.approx(level) and found["trend"][0] == pytest.approx(trend)


def test_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 4).alias("g"), (F.col("id") % 3).alias("h"), (F.col("id") % 7000).alias("v"))
    merged = {r.g: r.about_distinct for r in A.merged_distinct(A.distinct_sketches(df, ["g", "h"], "v"), ["g"]).collect()}
    exact = {r.g: r.n_distinct for r in A.distinct_if(df, ["g"], "v", F.lit(True)).collect()}
    assert all(abs(merged[g] - n) <= 0.0325 * n for g, n in exact.items()) and len(merged) == 4


@pytest.mark.parametrize(
    ("x", "source", "target", "expected"),
    [
        (100, "C", "F", 212), (1, "day", "hr", 24), (1, "hr", "mn", 60), (1, "stone", "kg", 6.35029318), (1, "kn", "km/h", 1.852), (1, "Nmi2", "m2", 1852**2), (2, "yd3", "ft3", 54), (1, "cm3", "l", 0.001), (1, "hl", "dal", 10),
        (1, "Mibyte", "bit", 8 * 2**20), (-40, "F", "C", -40), (0, "Reau", "K", 273.15), (80, "Reau", "C", 100), (1, "um", "nm", 1000), (1, "Morgen", "ar", 25), (1, "atm", "mmHg", 101325 / 133.322), (1, "kWh", "MJ", 3.6),
        (1, "in^2", "cm^2", 6.4516), (1, "m", "m2", None), (1, "kft", "m", None), (1, "mbit", "kbit", 1e-6), (3, "min", "sec", 180), (1, "pt", "cup", 2),
    ],
)
def test_units(spark, x, source, target, expected):
    from quiltgrid.functions.units import UNITS
    from quiltgrid.functions.values import convert

    if expected is None:
        assert source not in UNITS or UNITS[source][0] != UNITS[target][0]
        return
    (a, size, zero), (b, other, base) = UNITS[source], UNITS[target]
    assert a == b and (x * size + zero - base) / other == pytest.approx(expected, rel=1e-9)
    assert convert(F.lit(float(x)), source, target) is not None


def test_units_in_columns(spark):
    rows = [("1", "km", "mi"), ("x", "km", "mi"), (None, "km", "mi"), ("5", "km", "sec"), ("5", None, "km"), ("5", "none", "km"), ("32", "F", "C")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, v string, a string, b string")
    found = {r.id: r.converted for r in C.convert_units(df, "v", "a", "b").collect()}
    assert found == {0: pytest.approx(1 / 1.609344), 1: None, 2: None, 3: None, 4: None, 5: None, 6: pytest.approx(0)}


def test_dealt_rows_are_not_merged_again(spark):
    """Rows that compress well stay in as many tasks as their number asks for, below Spark's own number of partitions too."""
    from pyspark.sql import functions as F

    from quiltgrid import session

    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set(key, "200")
        rows = 20 * session.TASK_ROWS
        few = spark.range(200_000).select((F.col("id") % 2000).alias("k"), F.lit("same").alias("x"))
        sizes = session.dealt(few, rows, "k").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in sizes) == 200_000 and len(sizes) == 20
    finally:
        spark.conf.set(key, before)
