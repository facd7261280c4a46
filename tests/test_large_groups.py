"""Queries of findings at size, and the operators' paths for large inputs held against plain Python and DuckDB."""

import math
import random

import duck
import pytest
from pyspark.sql import functions as F

from quiltgrid import session
from quiltgrid.functions import values as V
from quiltgrid.operators import aggregates as A
from quiltgrid.operators import compat as P
from quiltgrid.plans import registry


@pytest.fixture(scope="module")
def many_parts(spark, tmp_path_factory):
    """The smallest tables' parts, repeated with shifted keys until a brand's names are longer than a cell holds."""
    path = tmp_path_factory.mktemp("many")
    part = spark.read.parquet(f"{duck.DATA}/part.parquet")
    part.crossJoin(spark.range(700).select(F.col("id").alias("_copy"))).withColumn("p_partkey", F.col("p_partkey") + F.col("_copy") * 1_000_000).drop("_copy").coalesce(1).write.parquet(f"{path}/part.parquet")
    return str(path)


def test_long_texts_are_joined_whole(spark, many_parts):
    import duckdb

    found = {r["p_brand"]: (r["joined"], r["array_text"]) for r in registry.queries()["a9_text_agg"](spark, many_parts).collect()}
    con = duckdb.connect()
    con.execute(f"create view part as select * from '{many_parts}/part.parquet/*.parquet'")
    expected = {r[0]: r[1:] for r in con.execute(registry.oracle_sql()["a9_text_agg"]).fetchall()}
    assert max(len(joined) for joined, _ in expected.values()) > 2 * A.CELL_CHARS
    assert found == expected


@pytest.mark.parametrize("skip_empty", [True, False])
def test_texts_without_a_limit_equal_those_that_fit(spark, skip_empty):
    rows = [(k, i, v) for k in ("a", None) for i, v in enumerate(["x", "", None, "y", "y", "z"])] + [("n", 1, None), ("e", 1, ""), ("e", 2, "")]
    df = spark.createDataFrame(rows, "k string, pos long, v string").repartition(4)
    for keys in (["k"], []):
        both = [sorted(A.text_agg(df, keys, "v", "pos", "|", skip_empty, cell_chars=c).collect(), key=repr) for c in (A.CELL_CHARS, None)]
        assert both[0] == both[1]


def _pairs_and_best(rows, asked, k, apart):
    items, best = {}, set()
    for token, item in rows:
        items.setdefault(item, set()).add(token)
    for key in {key for key, _ in asked}:
        own = {token for other, token in asked if other == key}
        scores = sorted((-len(own & theirs), item) for item, theirs in items.items() if own & theirs and not (apart and item == key))
        best |= {(key, item, -less, place + 1) for place, (less, item) in enumerate(scores[:k])}
    return best


@pytest.mark.parametrize("key_tokens", [2000, 3, 0])
@pytest.mark.parametrize("named", [False, True])
def test_best_of_lists_and_of_pairs(spark, named, key_tokens):
    """Keys counted in their row, pair by pair, and both."""
    rng = random.Random(6)
    name = (lambda i: f"i{i}") if named else (lambda i: i)
    rows = [(rng.randint(0, 25), name(rng.randint(0, 40))) for _ in range(150)] + [(99, name(77))] + [(t, name(7)) for t in range(12)]
    asked = [(name(rng.randint(0, 8)), rng.randint(0, 30)) for _ in range(40)] + [(name(50), 99), (name(51), 98)]
    kind = "string" if named else "long"
    items = spark.createDataFrame(rows, f"_t int, _item {kind}").select("_item", "_t")
    keys = spark.createDataFrame(asked, f"_key {kind}, _t int")
    found = P._top_shared(keys, items, 6, 1000, apart=False, key_tokens=key_tokens)
    assert {tuple(r) for r in found.collect()} == _pairs_and_best(rows, asked, 6, False)
    own = P._top_shared(items.withColumnRenamed("_item", "_key"), items, 5, 1000, apart=True, key_tokens=key_tokens)
    assert {tuple(r) for r in own.collect()} == _pairs_and_best(rows, [(i, t) for t, i in rows], 5, True)
    assert P._top_shared(keys.limit(0), items, 6, 1000, apart=False, key_tokens=key_tokens).count() == 0


def test_pairs_are_not_rows_and_tasks_grow_with_rows(spark, monkeypatch):
    """Items travel as lists, in as many tasks as their number asks for."""
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    items = spark.range(3000).select((F.col("id") % 100).alias("g"), (F.col("id") % 300).alias("t"), F.col("id").alias("i"))
    plan = P.items_for_group(items, items, "g", "t", "i")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(_items" in plan and "RepartitionByExpression [_t" in plan and "], 30" in plan
    assert "RepartitionByExpression [_key" in plan


def test_payments_are_not_summed_one_by_one(spark):
    plan = registry.queries()["c18_payments"](spark, duck.DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "sequence(" not in plan


def test_cumulated_interest_is_the_sum_of_its_payments(spark):
    rows = [(r, n, a, b, 1000.0 + n) for r in (0.0, 0.01, 0.3) for n in (1, 5) for a in (None, 0, 1, 2, 5) for b in (1, 2, 4, 5, 6)]
    df = spark.createDataFrame(rows, "r double, n int, a int, b int, v double")
    r, n, v = F.col("r"), F.col("n"), F.col("v")
    for start in (0, 1):
        one_by_one = F.aggregate(F.sequence("a", "b"), F.lit(0.0), lambda acc, k: acc + V.ipmt(r, k, n, v, 0.0, start))  # noqa: B023
        for found, expected in df.select(V.cumipmt(r, n, v, F.col("a"), F.col("b"), start), one_by_one).collect():
            assert found == (None if expected is None else pytest.approx(expected, rel=1e-9, abs=1e-8))


def test_rates_of_many_rows(spark):
    """The same as by halving the range of one row after another."""

    def plain(n, payment, pv, fv, start):
        def worth(r):
            factor = math.exp(min(-n * math.log1p(r), 600.0))
            return pv + payment * (n if r == 0 else (1 + r * start) * (1 - factor) / r) + fv * factor

        low, high = -0.99, 10.0
        if worth(low) * worth(high) > 0:
            return None
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (low, mid) if worth(low) * worth(mid) <= 0 else (mid, high)
        return (low + high) / 2

    rows = [(n, p, v, f) for n in (2.0, 24.0, 360.0) for p in (-900.0, -60.0, -5.0, 7.0) for v in (1000.0, -40.0) for f in (0.0, 50.0, -2000.0)]
    df = spark.createDataFrame([*rows, (None, -60.0, 1000.0, 0.0)], "n double, p double, v double, f double")
    for start in (0, 1):
        found = {tuple(r)[:4]: r["x"] for r in df.withColumn("x", V.rate(F.col("n"), F.col("p"), F.col("v"), F.col("f"), start)).collect()}
        assert found.pop((None, -60.0, 1000.0, 0.0)) is None
        assert found == {r: None if (x := plain(*r, start)) is None else pytest.approx(x, abs=1e-9) for r in rows}
        assert 10 < sum(x is not None for x in found.values()) < len(rows)


def test_lookups_are_counted_in_tasks_by_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    found = registry.queries()["j1_lookup_parts"](spark, duck.DATA)
    rows = spark.read.parquet(f"{duck.DATA}/lineitem.parquet").count()
    assert "RepartitionByExpression [l_partkey#" in (plan := found._jdf.queryExecution().optimizedPlan().toString()) and f"], {rows // 100}" in plan
    duck.check(found, registry.oracle_sql()["j1_lookup_parts"])
