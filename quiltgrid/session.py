"""Sessions for tests and benchmarks, and tables written between jobs."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Rows that a task gets on average, at most, where rows are dealt out by their number.
TASK_ROWS = 500_000
#: Rows of texts that go to Python in one batch, at most.
BATCH_ROWS = 1000


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="spark-")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", memory))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.local.dir", scratch)
        .config("spark.checkpoint.dir", f"file://{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """A new path under the folder that all executors share, named by ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a local session gets a temporary one; on a
    cluster that would be a folder of one machine, so that it is an error.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="quiltgrid-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/quiltgrid-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Queries made and run within leave no shuffle files: these go when a query ends, not when the driver happens to collect its garbage.

    Only for results that nothing runs again. Spark knows the setting from 4.1; earlier ones ignore it.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` in the shared folder and read it back: the lineage ends at files that outlive an executor."""
    path = shared_dir(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends Python ``BATCH_ROWS`` rows at once at most: a batch is held several times, by the executor and its workers.

    A smaller number that the session has is kept.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of about that many rows, dealt out by ``keys``: what a task holds stays the same however many rows there are.

    The number is named, as Spark merges partitions of its own number up to many times these
    rows where they compress well; rows that one task may hold are left to Spark.
    """
    tasks, spark = math.ceil(rows / TASK_ROWS), df.sparkSession
    if tasks <= 1:
        return df.repartition(*keys)
    own = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(max(tasks, own), *keys)
