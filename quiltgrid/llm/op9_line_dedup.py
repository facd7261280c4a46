"""Line dedup by overlapping windows of three lines.

Every three consecutive lines of a document are hashed. A window that occurs again,
anywhere, is a repeat in all its occurrences but the first by (doc_id, hash of the
text, place). The
lines that repeats cover are removed; windows overlap, so what they cover is merged.

Scale: only hashes, ids and places are shuffled; a window's first occurrence is found
by partial aggregation, and the join back to its occurrences deals hot windows out by
Spark's skew joins. What comes together is one document's covered lines.

Defined cases: a null text stays null; texts of fewer than three lines have no
window; windows without any word are not counted; rows that repeat a doc_id, or have
none, are documents of their own if their texts differ, null ids first; rows equal in
id and text are one document, and each is returned; an empty table gives no rows; extra
columns are kept, whatever their names, those named n_lines or n_removed with the prefix ``_own_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgrid.llm.common import BLANKS, let, table

WINDOW = 3


def line_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, doc_hash, at, h1, h2): 128 bits of each window of lines, ``at`` being its first line from 0."""
    lines = F.split("text", "\n")
    starts = F.sequence(F.lit(0), F.size("lines") - window)
    some = docs.select("doc_id", F.xxhash64("text").alias("doc_hash"), lines.alias("lines")).where(F.size("lines") >= window)
    some = some.select("doc_id", "doc_hash", F.explode(F.transform(starts, lambda i: F.struct(i.alias("at"), F.slice("lines", i + 1, window).alias("w")))).alias("x"))
    some = some.where(F.exists("x.w", lambda line: F.btrim(line, F.lit(BLANKS)) != ""))
    return some.select("doc_id", "doc_hash", "x.at", F.xxhash64("x.w").alias("h1"), F.xxhash64(F.lit(1), "x.w").alias("h2"))


def repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, doc_hash, removed): places of the lines to remove, ascending, for documents that have any."""
    windows = line_windows(docs, window)
    place = F.struct("doc_id", "doc_hash", "at")
    firsts = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = windows.join(firsts, ["h1", "h2"]).where(place > F.col("first"))
    covered = F.flatten(F.transform(F.collect_set("at"), lambda i: F.sequence(i, i + (window - 1))))
    return again.groupBy("doc_id", "doc_hash").agg(F.array_sort(F.array_distinct(covered)).alias("removed"))


#: Columns that are added; the input's own ones of these names get a prefix.
ADDED = ("n_lines", "n_removed")


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated lines cut out of ``text``, and n_lines, n_removed."""
    # The input's columns travel as one, so that none of their names can meet one of ours.
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", F.xxhash64("text").alias("doc_hash"))
    found = repeated_lines(docs.select("doc_id", "text"), window).select(F.col("doc_id").alias("of_id"), F.col("doc_hash").alias("of_hash"), "removed")
    marked = own.join(found, (F.col("doc_hash") == F.col("of_hash")) & F.col("doc_id").eqNullSafe(F.col("of_id")), "left")
    lines = F.split("row.text", "\n")
    # Runs of lines between one removed line and the next, and after the last.
    since = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get("removed", k - 1) + 1)
    ends = F.concat("removed", F.array(F.col("n_lines")))
    cut = let(lines, lambda x: F.array_join(F.flatten(F.transform(ends, lambda end, k: F.slice(x, since(k) + 1, end - since(k)))), "\n"))
    out = marked.withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)))
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(cut)
    kept = [text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(f"_own_{c}" if c in ADDED else c) for c in docs.columns]
    return out.select(*kept, "n_lines", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"), F.md5("text").alias("text_md5"))


ORACLE_SQL = """
with l as (select doc_id, string_split(text, chr(10)) as lines from documents),
w as (select doc_id, lines, unnest(range(0, len(lines) - 2)) as pos from l where len(lines) >= 3),
w1 as (
  select doc_id, pos, lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] as t
  from w where regexp_matches(lines[pos + 1] || lines[pos + 2] || lines[pos + 3], '[^\\x20\\x09-\\x0D]')),
r as (select doc_id, pos, row_number() over (partition by t order by doc_id, pos) as nth from w1),
cov as (select distinct doc_id, unnest([pos, pos + 1, pos + 2]) as line from r where nth > 1),
rem as (select doc_id, list(line) as removed from cov group by doc_id)
select l.doc_id, coalesce(len(lines), 0)::bigint as n_lines, coalesce(len(removed), 0)::bigint as n_removed,
  md5(case when removed is null then array_to_string(lines, chr(10))
    else array_to_string(list_transform(list_filter(range(0, len(lines)), lambda i: not list_contains(removed, i)), lambda i: lines[i + 1]), chr(10)) end) as text_md5
from l left join rem using (doc_id)
"""
