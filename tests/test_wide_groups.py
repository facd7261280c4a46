"""Operators on groups larger than a task may scan: the same rows as by windows, and plain Python beside them."""

import random

import pytest
from pyspark.sql import functions as F

from quiltgrid.operators import aggregates as A
from quiltgrid.operators import lookups as J
from quiltgrid.operators import scans as X
from quiltgrid.operators import windows as W


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def near(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x == y or all(p == q or p == pytest.approx(q, rel=1e-9, abs=1e-9) for p, q in zip(x, y, strict=True))


@pytest.fixture(scope="module")
def cells(spark):
    """One large group, small ones, a null key; numbers, text and blanks; ties."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        k = None if i % 50 == 7 else "small" if i % 9 == 0 else "large"
        rows.append((k, i * 7919 % 9001, rng.choice(["", None, "x", *(str(n) for n in range(-5, 12))])))
    return spark.createDataFrame(rows, "k string, pos long, v string").repartition(5).cache()


CASES = {
    "running": lambda df, keys, wide: W.running(df, keys, "v", "pos", spread=wide),
    "sum": lambda df, keys, wide: W.scan(df, keys, "pos", A.number("v"), "sum", spread=wide),
    "count": lambda df, keys, wide: W.scan(df, keys, "pos", F.col("v"), "count", spread=wide),
    "min": lambda df, keys, wide: W.scan(df, keys, "pos", A.number("v"), "min", spread=wide),
    "row_change": lambda df, keys, wide: W.row_change(df, keys, "v", "pos", spread=wide),
    "fill_down": lambda df, keys, wide: W.fill_down(df, keys, "v", "pos", spread=wide),
    "share": lambda df, keys, wide: W.share_of_total(df, keys, "v", "pos", spread=wide),
    "rank": lambda df, keys, wide: W.rank_rows(df, keys, "v", "pos", spread=wide),
    "rank_up": lambda df, keys, wide: W.rank_rows(df, keys, "v", "pos", ascending=True, spread=wide),
    "percent_rank": lambda df, keys, wide: W.percent_rank_at(df, keys, "v", spread=wide),
}
GROUPED = {
    "last_n": lambda df, keys, wide: W.last_n_agg(df, keys, "v", "pos", 4, 3, spread=wide),
    "order_stats": lambda df, keys, wide: A.order_stats(df, keys, "v", [0.1, 0.5], [0.3], [1, 5], spread=wide),
    "trim_mean": lambda df, keys, wide: A.trim_mean(df, keys, "v", 0.3, spread=wide),
    "npv": lambda df, keys, wide: A.npv(df.withColumn("day", F.date_add(F.lit("2020-01-01").cast("date"), F.col("pos").cast("int"))), keys, 0.01, "v", "pos", "day", spread=wide),
    "ranked": lambda df, keys, wide: A.aggregate_ranked(df, keys, "v", [(13, None), (14, 2), (16, 0.4), (18, 0.9)], "pos", spread=wide),
}


@pytest.mark.parametrize("name", CASES)
def test_ranges_give_what_windows_give(cells, name):
    for keys in (["k"], []):
        near(rows_of(CASES[name](cells, keys, True), "pos"), rows_of(CASES[name](cells, keys, False), "pos"))


@pytest.mark.parametrize("name", GROUPED)
def test_ranges_give_the_same_groups(cells, name):
    near(rows_of(GROUPED[name](cells, ["k"], True), "k"), rows_of(GROUPED[name](cells, ["k"], False), "k"))


def test_a_large_group_is_spread_without_being_asked(cells, monkeypatch):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "_scan_range" not in plan(W.fill_down(cells, ["k"], "v", "pos"))
    monkeypatch.setattr(X, "GROUP_ROWS", 100)
    filled = W.fill_down(cells, ["k"], "v", "pos")
    assert "_scan_range" in plan(filled)
    one_group = X.running_columns(cells, [], ["pos"], {"n": (F.lit(1), "count")})
    assert [r["n"] for r in one_group.orderBy("pos").select("n").collect()] == list(range(1, 901))


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("larger", [False, True])
@pytest.mark.parametrize("by", [["g"], []])
def test_as_of_lookup(spark, wide, larger, by):
    rng = random.Random(4)
    some = lambda: None if rng.random() < 0.05 else rng.randint(0, 400) / 2
    table = [(rng.choice(["a", "a", "a", None]), x, f"t{x}") for x in {some() for _ in range(90)}]
    asked = [(rng.choice(["a", "a", "b", None]), i, some()) for i in range(300)]
    found = J.lookup_approx(spark.createDataFrame(asked, "g string, id int, x double"), spark.createDataFrame(table, "g string, edge double, label string"), by, "x", "edge", ["label"], next_larger=larger, spread=wide)

    def plain(g, x):
        fits = [e for h, e, _ in table if x is not None and e is not None and (not by or h == g) and (e >= x if larger else e <= x)]
        best = (min if larger else max)(fits, default=None)
        return best, None if best is None else f"t{best}"

    assert {r.id: (r.edge, r.label) for r in found.collect()} == {i: plain(g, x) for g, i, x in asked}


def test_irr_of_many_groups(spark):
    rng = random.Random(5)
    rows, rates = [], {}
    for g in range(40):
        rate, n = rng.choice([-0.5, -0.05, 0.0, 0.1, 0.4, 2.5, 30.0]), rng.randint(2, 12)
        flows = [rng.uniform(1, 100) for _ in range(n - 1)]
        first = -sum(v / (1 + rate) ** (k + 1) for k, v in enumerate(flows))
        rates[g] = rate
        rows += [(g, k * 10 + j, v) for k, v in enumerate([first, *flows]) for j, v in ((0, v), (1, None))]
    df = spark.createDataFrame(rows, "g int, pos int, v double")
    for wide in (False, True):
        found = {r.g: r.irr for r in A.irr(df, ["g"], "v", "pos", days=False, spread=wide).collect()}
        assert found == {g: pytest.approx(r, rel=1e-9, abs=1e-9) for g, r in rates.items()}
