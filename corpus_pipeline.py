"""A training corpus from ``documents``: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. Every stage's result is written as Parquet and
read again as the next one's input.

Defined cases: a document without a letter has no language and goes; rows that repeat a
doc_id, or have none, are documents of their own in every stage; columns that
``documents`` has besides are dropped by the first stage; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgrid.llm.common import freed_shuffles, shared_dir, table, told_apart, words_of
from quiltgrid.llm.op1_language_id import UNKNOWN, identify, learn
from quiltgrid.llm.op2_mixing import BLOCK_WORDS, blocks_of, plan_documents, times_taken, words_in
from quiltgrid.llm.op3_decontamination import drop_leaks
from quiltgrid.llm.op6_sharding import shard_documents
from quiltgrid.llm.op10_simhash import near_duplicates

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that was learned; ``lang`` becomes the predicted one."""
    docs = docs.select(*COLUMNS)
    found = identify(docs, learn(docs)).where(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the least doc_id.

    Rows that repeat an id, or have none, are documents of their own; of those in a
    group ids come before null, then the least hash.
    """
    docs, row = told_apart(docs.select(*COLUMNS))
    if row == "doc_id":
        kept = near_duplicates(docs).where("doc_id = group_id").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)
    groups = near_duplicates(docs.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "group_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*COLUMNS).alias("hash"), row)
    firsts = docs.select(row, order.alias("order")).join(groups, row).groupBy("group_id").agg(F.min("order").alias("o")).select(F.col(f"o.{row}").alias(row))
    return docs.join(firsts, row, "left_semi").select(*COLUMNS)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a row per copy: the words of a document's blocks that are taken that often.

    A copy of all blocks keeps the text as it is; other texts are the taken words,
    joined by spaces. Documents of which no word is taken go.
    """
    docs, row = told_apart(docs.select(*COLUMNS))
    planned = plan_documents(docs) if row == "doc_id" else plan_documents(docs, carry=(row,))
    pieces = F.transform(blocks_of(BLOCK_WORDS), lambda b: F.struct(times_taken(b).alias("times"), *(x.alias(n) for x, n in zip(words_in(b, BLOCK_WORDS), ("start", "n"), strict=True))))
    planned = planned.select(row, "size", pieces.alias("pieces"))
    copies = planned.withColumn("copy", F.explode(F.filter(F.array(F.lit(1), F.lit(2)), lambda c: F.exists("pieces", lambda p: p["times"] >= c))))
    copies = copies.select(row, F.filter("pieces", lambda p: p["times"] >= F.col("copy")).alias("taken"), F.exists("pieces", lambda p: p["times"] < F.col("copy")).alias("cut"))
    words = words_of(F.col("text"))
    part = F.element_at(F.transform(F.array(words), lambda w: F.array_join(F.flatten(F.transform("taken", lambda p: F.slice(w, (p["start"] + 1).cast("int"), p["n"].cast("int")))), " ")), 1)
    text = F.when(F.col("cut"), part).otherwise(F.col("text"))
    rows = docs.join(copies, row).withColumn("text", text)
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, size, text_crc32, hilbert, shard, slot) of every row of the mix."""
    return shard_documents(docs).drop("size_class")


STAGES = [
    ("language_id", by_language),
    ("simhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_leaks),
    ("source_mixing", mixed),
    ("hilbert_sharding", sharded),
]

#: Code lengths, tries and alignments are not expressible; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = shared_dir(spark)
        rows = stage(spark, docs, sf_dir)
        with freed_shuffles(spark):
            rows.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
