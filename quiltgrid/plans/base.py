"""How a module of queries registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_sql(sql: str, *columns: str, digits: int = 2) -> str:
    """Sums of doubles depend on the order of rows in their last digits: both sides round them."""
    return f"select * replace ({', '.join(f'round({c}, {digits}) as {c}' for c in columns)}) from ({sql})"


class Queries:
    def __init__(self) -> None:
        self.queries: dict = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def put(f):
            self.queries[name] = f
            if sql:
                self.oracles[name] = sql
            return f

        return put
