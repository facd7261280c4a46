"""Side-by-side comparison with DuckDB over the same Parquet files."""

import decimal
import math
import os

import duckdb

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir=DATA):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def check(df, sql, sf_dir=DATA):
    """Same columns and the same rows in any order."""
    names = sorted(df.columns)
    found = sorted(repr([plain(r[c]) for c in names]) for r in df.collect())
    cursor = connect(sf_dir).execute(sql)
    theirs = [c[0] for c in cursor.description]
    assert sorted(theirs) == names
    at = [theirs.index(c) for c in names]
    expected = sorted(repr([plain(r[i]) for i in at]) for r in cursor.fetchall())
    assert len(found) == len(expected)
    assert found == expected
