"""Mix sources to target weights in equal-token blocks by Sainte-Lague apportionment.

The words of each source, documents in a seeded order, are one stream that is cut
into blocks of ``block_words``. Blocks go to sources by highest quotients
target / (2 * given + 1). The method is house-monotone, so the mix's shards take
consecutive runs of the same awards and each has integer quotas per source. A
source's blocks are taken in a seeded permuted order, each once before any twice.

Scale: one pass reads the texts for their word counts; the stream offsets are sums
over hash buckets, so that a source with a third of all rows is spread; only one
row per source reaches the driver, and blocks are never listed in one place, as
the permutation is computed, not sorted.

Defined cases: null and blank texts have no words and none are taken; a null source
is a source like any other, the last one; rows that repeat an id, or have none, are
documents of their own, in the seeded order of id and text; equal rows are
interchangeable; a source without words has target 0; a mix smaller than half a block is one block; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgrid.llm.common import count_words, hash_digits, materialize, ordered_totals, stored_place, table, told_apart, words_of

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2
BLOCK_WORDS = 64
SHARDS = 16
SEED = 42
#: Steps of the permutation: primes, the first that doesn't divide the number of blocks.
STEPS = (611953, 746773, 868019)


def targets(sizes: list[int], weights: list[int], share: float = SHARE, cap: float = CAP) -> list[float]:
    """Shares of share * sum(sizes) by weight; what a cap cuts off is shared anew."""
    total = share * sum(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (cap * sizes[i] / weights[i], i))
    level, capped, open_weight = 0.0, 0, sum(weights)
    for i in order:  # sources fill up in this order as the level rises
        level = (total - capped) / open_weight
        if cap * sizes[i] > weights[i] * level:
            break
        capped += cap * sizes[i]
        open_weight -= weights[i]
    return [float(min(cap * s, w * level)) for s, w in zip(sizes, weights, strict=True)]


def sainte_lague(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients vote / (2 * seats + 1); ties to the earlier; none gets over ``most``."""
    if sum(most) <= seats:
        return list(most)
    low, high = 0.0, max(votes, default=0.0) * 2 + 1  # divisors: more seats are given below
    given = lambda d: [min(m, math.floor(v / d + 0.5)) if v else 0 for v, m in zip(votes, most, strict=True)]
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (low, middle) if sum(given(middle)) <= seats else (middle, high)
    out = given(high)
    quotients = [(-v / (2 * g + 1), i) for i, (v, g, m) in enumerate(zip(votes, out, most, strict=True)) if v and g < m]
    heapq.heapify(quotients)
    while quotients and sum(out) < seats:
        _, i = heapq.heappop(quotients)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(quotients, (-votes[i] / (2 * out[i] + 1), i))
    return out


def plan_mix(sources: list[tuple[str | None, int]], block_words: int = BLOCK_WORDS, shards: int = SHARDS, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = SEED) -> list[dict]:
    """A row per source of (name, words): its target and quotas, and how its blocks are permuted."""
    sources = sorted(sources, key=lambda s: (s[0] is None, s[0] or ""))
    sizes = [s for _, s in sources]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, cap) if any(sizes) else [0.0] * len(sizes)
    blocks = [-(-s // block_words) for s in sizes]
    most = [cap * b for b in blocks]
    house = max(1, round(sum(goal) / block_words)) if any(sizes) else 0
    by_shard = [sainte_lague(goal, house * (k + 1) // shards, most) for k in range(shards)]
    out = []
    for i, (name, size) in enumerate(sources):
        n = max(1, blocks[i])
        step = next(p for p in STEPS if n % p)
        out.append({"name": name, "source_size": size, "target": goal[i], "blocks": n, "quota": by_shard[-1][i], "step": step, "first": seed * (i + 1) % n, "quotas": [x[i] for x in by_shard]})
    return out


PLAN = "name string, source_size long, target double, blocks long, quota long, step long, first long, quotas array<long>"


def place_in_order(block: Column) -> Column:
    """A block's place in its source's permuted order."""
    return (block * F.col("step") + F.col("first")) % F.col("blocks")


def times_taken(block: Column) -> Column:
    whole = F.expr("quota div blocks")
    return whole + (place_in_order(block) < F.col("quota") % F.col("blocks")).cast("long")


def plan_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED, carry: tuple[str, ...] = (), **options) -> DataFrame:
    """(doc_id, source, size, before) of every document with its source's plan, and its columns ``carry``.

    ``before``: words of its source's stream that stand before the document.
    """
    sizes = materialize(docs.select("doc_id", "source", *carry, count_words(F.col("text")).alias("size"), F.md5("text").alias("_text"), stored_place().alias("_place")))
    stats = sizes.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("rows")).collect()
    plan = docs.sparkSession.createDataFrame([tuple(r.values()) for r in plan_mix([(r["source"], r["words"]) for r in stats], block_words, seed=seed, **options)], PLAN)
    name = lambda c: F.when(c.isNull(), "n").otherwise(F.concat(F.lit("s"), c))  # noqa: E731  a join key without nulls
    rows = sizes.withColumn("_key", name(F.col("source"))).withColumn("_order", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("_text"))))
    rows = ordered_totals(rows, "_key", "_order", "_place", F.col("size"), hash_digits(sum(r["rows"] for r in stats)), across_keys=False)
    return rows.join(plan.withColumn("_key", name(F.col("name"))).drop("name"), "_key").drop("_key", "_order", "_text", "_place")


def blocks_of(block_words: int) -> Column:
    """The blocks that a planned document's words lie in; none if it has no words."""
    first, last = F.expr(f"before div {block_words}L"), F.expr(f"(before + size - 1) div {block_words}L")
    return F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def words_in(block: Column, block_words: int) -> tuple[Column, Column]:
    """The part of a planned document's words that lies in a block: first word (from 0) and count."""
    start = F.greatest(block * block_words - F.col("before"), F.lit(0).cast("long"))
    end = F.least((block + 1) * block_words - F.col("before"), F.col("size"))
    return start, end - start


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): words of each document that the mix takes."""
    planned = plan_documents(docs, block_words, **options)
    taken = F.aggregate(blocks_of(block_words), F.lit(0).cast("long"), lambda n, b: n + words_in(b, block_words)[1] * times_taken(b))
    return planned.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS, **options) -> DataFrame:
    """The mix itself: a row per taken piece of a document, with its text.

    (doc_id, source, block, copy, shard, first_word, n_words, text); ``copy``
    counts the times that a block is taken, from 0. Rows that repeat an id, or have none,
    are documents of their own.
    """
    docs = docs.select("doc_id", "source", "text")
    docs, row = told_apart(docs)
    planned = plan_documents(docs, block_words, carry=(row,), **options) if row != "doc_id" else plan_documents(docs, block_words, **options)
    pieces = planned.withColumn("block", F.explode(blocks_of(block_words)))
    start, count = words_in(F.col("block"), block_words)
    pieces = pieces.withColumn("copy", F.explode(F.when(times_taken(F.col("block")) > 0, F.sequence(F.lit(0).cast("long"), times_taken(F.col("block")) - 1))))
    place = place_in_order(F.col("block")) + F.col("copy") * F.col("blocks")
    shard = F.size(F.filter(F.col("quotas"), lambda q: q <= place))
    pieces = pieces.select(F.col(row).alias("of"), "doc_id", "source", "block", "copy", shard.alias("shard"), start.alias("first_word"), count.alias("n_words"))
    text = F.array_join(F.slice(words_of(F.col("text")), (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int")), " ")
    return pieces.join(docs.select(F.col(row).alias("of"), "text"), "of").select("doc_id", "source", "block", "copy", "shard", "first_word", "n_words", text.alias("text"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
with d as (
  select doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::bigint as size, md5(concat_ws(':', '42', doc_id, md5(text))) as o
  from documents),
s0 as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as i, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
  from d group by source),
s1 as (
  select *, 2 * source_size as cap, 1.5 * sum(source_size) over () as total, sum(w) over () as all_w,
    coalesce(sum(2 * source_size) over below, 0) as capped, coalesce(sum(w) over below, 0) as capped_w
  from s0 window below as (order by 2 * source_size / w, i rows between unbounded preceding and 1 preceding)),
s2 as (select *, (total - capped)::double / (all_w - capped_w) as level from s1),
lev as (select coalesce(min_by(level, 2 * source_size / w) filter (where cap > w * level), max_by(level, 2 * source_size / w)) as level from s2),
s3 as (select source, source_size, i, least(cap::double, w * lev.level) as target, greatest(1, (source_size + 63) // 64) as blocks, (source_size + 63) // 64 * 2 as most from s1, lev),
awards as (select source, target / (2 * k - 1) as quotient, i, k from s3, lateral (select unnest(range(1, most + 1)) as k) where target > 0),
won as (select source, count(*) as quota from (select source, row_number() over (order by quotient desc, i, k) as place from awards) where place <= (select greatest(1, round(sum(target) / 64)) from s3) group by source),
plan as (
  select s3.*, coalesce(quota, 0) as quota, case when blocks % 611953 <> 0 then 611953 else 746773 end as step, 42 * i % blocks as first
  from s3 left join won on s3.source is not distinct from won.source),
placed as (select *, sum(size) over (partition by source order by o, doc_id rows between unbounded preceding and current row) - size as before from d),
pieces as (select doc_id, source, unnest(range((before // 64)::bigint, ((before + size - 1) // 64 + 1)::bigint)) as block, before, size from placed where size > 0),
taken as (
  select doc_id, sum((least((block + 1) * 64 - before, size) - greatest(block * 64 - before, 0)) * (quota // blocks + case when (block * step + first) % blocks < quota % blocks then 1 else 0 end)) as taken
  from pieces join plan on pieces.source is not distinct from plan.source group by doc_id)
select d.doc_id, d.size, p.source_size, p.target, coalesce(taken.taken, 0)::bigint as taken
from d join plan p on d.source is not distinct from p.source left join taken using (doc_id)
"""
