"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiltgrid.session import freed_shuffles, in_small_batches, materialize, shared_dir  # noqa: F401  used by the operators

#: The six ASCII white-space characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
#: Java pattern of a run of them.
BLANK_RUN = r"[\x20\x09-\x0D]+"
#: Rows that one hash bucket of ``ordered_totals`` holds on average, at most.
ROWS_PER_BUCKET = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that it is evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def count_words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANK_RUN))).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hash_digits(n_rows: int) -> int:
    """Hex digits of a uniform hash that split ``n_rows`` into small buckets."""
    digits = 2
    while n_rows / 16**digits > ROWS_PER_BUCKET:
        digits += 1
    return digits


def ordered_totals(df: DataFrame, key: str, order: str, place: str, weight: Column, digits: int, across_keys: bool) -> DataFrame:
    """Exclusive running total of ``weight`` as column ``before``.

    Rows are in order of (``key``, ``order``), where ``order`` is a hex hash of all
    that tells rows apart: rows of equal order must be interchangeable. The total
    starts anew with each key, or runs on if ``across_keys``. No task sees more than
    a hash bucket of a key: bucket sums are made by partial aggregation, and only
    those sums are accumulated over a key. An order that many rows share comes after
    its bucket's others, in buckets of its own by ``place``, a small number that is
    stored with each row.
    """
    rows = df.withColumn("_b", F.substring(order, 1, digits)).withColumn("_w", weight)
    full = rows.groupBy(key, "_b").agg(F.count("*").alias("_n")).where(F.col("_n") > 4 * ROWS_PER_BUCKET).drop("_n")
    hot = rows.join(full, [key, "_b"], "left_semi").groupBy(key, order).agg(F.count("*").alias("_n")).where(F.col("_n") > ROWS_PER_BUCKET)
    # A row for every ROWS_PER_BUCKET rows of ``df`` at most.
    hot = materialize(hot.select(key, order, F.lit(True).alias("_hot")))
    if not hot.isEmpty():
        rows = rows.join(hot, [key, order], "left").withColumn("_b", F.when(F.col("_hot"), F.concat("_b", F.lit("~"), order, F.lpad(F.col(place).cast("string"), 4, "0"))).otherwise(F.col("_b"))).drop("_hot")
    sums = rows.groupBy(key, "_b").agg(F.sum("_w").alias("_s"))
    by_bucket = Window.partitionBy(key).orderBy("_b")
    sums = sums.withColumn("_start", F.sum("_s").over(by_bucket) - F.col("_s"))
    if across_keys:
        keys = rows.groupBy(key).agg(F.sum("_w").alias("_k"))
        keys = keys.withColumn("_base", F.sum("_k").over(Window.orderBy(key)) - F.col("_k"))
        sums = sums.join(keys, key).withColumn("_start", F.col("_start") + F.col("_base"))
    inside = Window.partitionBy(key, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_local", F.sum("_w").over(inside) - F.col("_w"))
    return rows.join(sums.select(key, "_b", "_start"), [key, "_b"]).withColumn("before", F.col("_start") + F.col("_local")).drop("_b", "_w", "_start", "_local")


def told_apart(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` and the column that tells its rows apart: doc_id, or a stored row number where ids repeat or are null."""
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("n > 1 or doc_id is null").isEmpty():
        return docs, "doc_id"
    return materialize(docs.withColumn("_row", F.monotonically_increasing_id())), "_row"


def stored_place() -> Column:
    """A number below 1024 by where a row lies, to be stored with it: it spreads rows that are alike."""
    return F.pmod(F.monotonically_increasing_id(), F.lit(1024))
