"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised into 2 ** BITS levels of about equal row counts; the
levels' cell has an index on the curve; rows are ordered by (index, md5 of id and
text checksum) and the order is cut into runs whose counts differ by one at most (law
``rows``). Neighbours on the curve agree in most dimensions, so that the minima
and maxima of a run's files prune on any of them.

Scale: rows of a cell are ordered inside buckets of their id's hash, so that a
cell with a third of all rows is spread as well; only counts by level, cell and
bucket are accumulated. A dimension may have any number of values: they are sorted by
ranges, and only a sum for each range comes to one place. Texts are read once, for their size and checksum.

Defined cases: a null text has no bytes and the checksum of an empty one; null
dimensions form the last level; rows that repeat an id, or have none, get places of
their own; an empty table gives no rows; extra columns are ignored, and written with
the shards but for one named like a column of ``PLACES``, which gets the prefix ``_own_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiltgrid.llm.common import hash_digits, materialize, ordered_totals, stored_place, table

SHARDS = 16
BITS = 4
DIMENSIONS = ("lang", "source", "size")


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Place on the curve of a cell, by J. Skilling's transposition (AIP Conf. Proc. 707, 2004)."""
    x, n = list(point), len(point)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations and reflections of each level
        low = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray encoding
        x[i] ^= x[i - 1]
    flip = 0
    q = top
    while q > 1:
        if x[n - 1] & q:
            flip ^= q - 1
        q >>= 1
    index = 0
    for level in reversed(range(bits)):
        for v in x:
            index = index << 1 | ((v ^ flip) >> level & 1)
    return index


def _levels(df: DataFrame, dim: str, bits: int) -> DataFrame:
    """(value, level) of each value of ``dim``: equal shares of the rows that ``n`` counts, in the order of values, null last.

    Values are grouped first, then sorted by ranges: a range's task accumulates its
    own, and only the ranges' sums are accumulated in one place.
    """
    values = df.groupBy(F.col(dim).alias("_v")).agg(F.sum("n").alias("_n"))
    ranged = materialize(values.repartitionByRange(F.col("_v").asc_nulls_last()).withColumn("_p", F.spark_partition_id()))
    sums = ranged.groupBy("_p").agg(F.sum("_n").alias("_s"))
    sums = sums.select("_p", (F.sum("_s").over(Window.orderBy("_p")) - F.col("_s")).alias("_start"), F.sum("_s").over(Window.partitionBy()).alias("_total"))
    inside = F.sum("_n").over(Window.partitionBy("_p").orderBy(F.col("_v").asc_nulls_last())) - F.col("_n")
    before = F.col("_start") + F.col("_inside")
    # A row per range of the writing job, whatever the input.
    placed = ranged.withColumn("_inside", inside).join(F.broadcast(sums), "_p")
    return placed.select(F.col("_v").alias(f"_v_{dim}"), F.floor(before * (1 << bits) / F.col("_total")).cast("int").alias(f"_level_{dim}"))


def hilbert_shards(rows: DataFrame, dims: tuple[str, ...], n_shards: int = SHARDS, bits: int = BITS, key: tuple[str, ...] = ("doc_id", "text_crc32")) -> DataFrame:
    """``rows`` with ``hilbert``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    ``rows`` should be narrow: they are shuffled. They have a ``stored_place``; of
    one cell, those equal in ``key`` are interchangeable. dims * bits is 15 at most.
    """
    if len(dims) * bits > 15:
        raise ValueError("more than 15 bits of cells")
    side = 1 << bits
    cells = [0] * side ** len(dims)
    for code in range(len(cells)):
        cells[code] = hilbert_index(tuple(code >> (bits * i) & (side - 1) for i in range(len(dims))), bits)
    # Levels and curve are found for the different combinations of values, which rows then look up once.
    kinds = materialize(rows.groupBy(*dims).agg(F.count("*").alias("n")))
    code, placed = F.lit(0), kinds
    for i, dim in enumerate(dims):
        placed = placed.join(_levels(kinds, dim, bits), F.col(dim).eqNullSafe(F.col(f"_v_{dim}")))
        code = code + F.shiftleft(F.col(f"_level_{dim}"), bits * i)
    hilbert = F.get(F.array(*map(F.lit, cells)), code).alias("hilbert")
    placed = materialize(placed.select(*(F.col(d).alias(f"_of_{d}") for d in dims), hilbert))
    out = rows.join(placed, [F.col(d).eqNullSafe(F.col(f"_of_{d}")) for d in dims]).select(*rows.columns, "hilbert")
    out = out.withColumn("_order", F.md5(F.concat_ws(":", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key))))
    total = kinds.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = ordered_totals(out, "hilbert", "_order", "_place", F.lit(1).cast("long"), hash_digits(total), across_keys=True)
    shard = F.expr(f"(before * {n_shards}L) div {max(total, 1)}L").cast("int")
    first = F.expr(f"(shard * {total}L + {n_shards - 1}L) div {n_shards}L")
    return out.withColumn("shard", shard).withColumn("slot", F.col("before") - first).drop("before", "_order", "_place")


def document_facts(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, lang, source, size_class, size, text_crc32): what sharding needs of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    return docs.select("doc_id", "lang", "source", size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.floor(4 * F.log2(size)).cast("int").alias("size_class"), *more)


def shard_documents(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Facts of each document with its curve index, shard and slot."""
    facts = materialize(document_facts(docs).withColumn("_place", stored_place()))
    return hilbert_shards(facts, ("lang", "source", "size_class"), n_shards)


#: Columns that ``write_shards`` adds; ``shard`` names the folders.
PLACES = ("hilbert", "shard", "slot")


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS) -> None:
    """Write all rows of ``docs`` as one Parquet folder per shard, each file in curve order.

    The rows are numbered in the shared folder first, so that rows of one id, or of
    none, stay apart. Tasks take ranges of the order: a shard may have a few files.
    """
    # The input's columns travel as one, so that none of their names can meet one of ours.
    whole = F.struct(*(F.col(f"`{c}`").alias(f"_own_{c}" if c in PLACES else c) for c in docs.columns))
    own = materialize(docs.select("doc_id", "lang", "source", "text", whole.alias("row_of_docs")).withColumn("_row", F.monotonically_increasing_id()))
    facts = materialize(document_facts(own, "_row").withColumn("_place", F.pmod("_row", F.lit(1024))))
    placed = hilbert_shards(facts, ("lang", "source", "size_class"), n_shards, key=("doc_id", "text_crc32", "_row")).select("_row", *PLACES)
    rows = own.select("_row", "row_of_docs").join(placed, "_row").select("row_of_docs.*", *PLACES)
    rows.repartitionByRange(n_shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")
