"""Exact dedup by recipes of content-defined chunks.

A text is cut where its content says so: a chunk of at least ``LEAST_CHARS`` characters
ends before a window of characters whose kinds follow ``CUT``, or at ``MOST_CHARS``, so
that a passage keeps most of its chunks wherever it stands. Chunks are deduplicated to
identifiers, their 128-bit hashes, which are verified: of each hash the different chunks
are counted, and where there is more than one the identifier holds the chunk too. A
document's recipe is the ordered list of its chunks' identifiers; texts are equal when
their recipes are. Only different chunks, once a task, and recipes are shuffled, never
documents.

Scale: copies are combined before each shuffle (partial aggregation), so that a chunk or
a recipe that a third of the rows share is one row a task; the join of rows with their
group is by recipe, one row on one side, and hot recipes are dealt out by Spark's skew
joins. All of it is DataFrame functions.

Defined cases: a null text counts as empty; the recipe of an empty text is empty; of
equal texts the row with the largest doc_id stays, null being least, and of rows equal in
both, which can't be told apart, one; text that isn't valid UTF-8 is one chunk, compared
by its bytes; an empty table gives no rows; other columns than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgrid.llm.common import materialize, table

LEAST_CHARS, MOST_CHARS = 1024, 8192
#: Kinds of the window before which a chunk ends: one place in 2 ** 8 by chance.
CUT = "ooeoeeoe"


def kind_of(odd: bool) -> str:
    """Java pattern of about half of each alphabet, or of the rest: steps widen with the code points.

    The first 256 characters are listed one by one, which Java looks up in one table;
    only others are held against the list of ranges.
    """
    near = lambda first: "".join(f"\\x{c:02x}" for c in range(first, 0x100, 2))
    steps = ((0x110, 0x700, 0x10), (0x800, 0xD800, 0x400))
    far = "".join(f"\\x{{{c:x}}}-\\x{{{c + step - 1:x}}}" for start, end, step in steps for c in range(start, end, 2 * step))
    return f"(?:[{near(1)}]|(?![\\x00-\\xff])[{far}])" if odd else f"(?:[{near(0)}]|(?![\\x00-\\xff])[^{far}])"


def chunk_pattern(least: int = LEAST_CHARS, most: int = MOST_CHARS, cut: str = CUT) -> str:
    """Matches of it, one after the other, are the chunks of a text, without gaps."""
    window = "".join(kind_of(kind == "o") for kind in cut)
    return f"(?s).{{{least},{most}}}?(?={window}|\\z)|.{{{most}}}|.+"


def chunks_of(text: Column, pattern: str) -> Column:
    return F.when(F.is_valid_utf8(text), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array(text))


def hash128(chunk: Column) -> Column:
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(1), chunk).alias("b"))


def shared_hashes(docs: DataFrame, pattern: str, hashed: Callable[[Column], Column]) -> DataFrame:
    """(id): hashes that different chunks have."""
    chunks = docs.select(F.explode(chunks_of(F.col("text"), pattern)).alias("chunk"))
    return chunks.select(hashed(F.col("chunk")).alias("id"), "chunk").distinct().groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")


def recipes(docs: DataFrame, pattern: str | None = None, hashed: Callable[[Column], Column] = hash128) -> DataFrame:
    """(row, doc_id, text_sha256, recipe) of every row, written: ``recipe`` lists verified identifiers of its chunks."""
    pattern = pattern or chunk_pattern()
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.withColumns({"row": F.monotonically_increasing_id(), "text_sha256": F.sha2("text", 256)})
    shared = materialize(shared_hashes(docs, pattern, hashed))
    if shared.isEmpty():
        recipe = F.transform(chunks_of(F.col("text"), pattern), hashed)
        return materialize(rows.select("row", "doc_id", "text_sha256", recipe.alias("recipe")))
    chunks = rows.select("row", "doc_id", "text_sha256", F.posexplode_outer(chunks_of(F.col("text"), pattern)).alias("at", "chunk")).withColumn("id", hashed(F.col("chunk")))
    known = chunks.join(shared.withColumn("_shared", F.lit(True)), "id", "left")
    part = F.when(F.col("at").isNotNull(), F.struct("at", F.struct("id", F.when(F.col("_shared"), F.col("chunk")).alias("chunk")).alias("id")))
    lists = known.groupBy("row", "doc_id", "text_sha256").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return materialize(lists.select("row", "doc_id", "text_sha256", F.transform("parts", lambda p: p["id"]).alias("recipe")))


def exact_groups(docs: DataFrame, pattern: str | None = None, hashed: Callable[[Column], Column] = hash128) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row: the row that stays of its equal texts."""
    rows = recipes(docs, pattern, hashed)
    groups = rows.groupBy("recipe").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("last"))
    # Written: both sides of the join are then plain exchanges, of which Spark splits hot ones.
    groups = materialize(groups.where("n > 1"))
    found = rows.join(groups.withColumnRenamed("recipe", "of"), F.col("recipe") == F.col("of"), "left")
    alone = F.col("n").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("last.doc_id"))
    kept = alone | (F.col("row") == F.col("last.row"))
    return found.select("doc_id", keep_id.alias("keep_id"), F.coalesce("n", F.lit(1)).alias("group_size"), kept.alias("kept"), "text_sha256")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
with d as (select doc_id, coalesce(text, '') as text from documents),
g as (select text, max(doc_id) as keep_id, count(*) as group_size from d group by text)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256 from d join g using (text)
"""
