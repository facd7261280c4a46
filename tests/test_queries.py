"""Every query against its SQL, or at least run, on the smallest tables."""

import duck
import pytest

from quiltgrid.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, duck.DATA)
    if name in ORACLES:
        duck.check(df, ORACLES[name])
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
