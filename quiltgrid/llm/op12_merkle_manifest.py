"""Merkle manifest of a dataset, with a proof of membership for each row.

Each row is a leaf. The leaves of a language are put in order and numbered; every
``FANOUT`` consecutive nodes of a level are hashed to one of the next. A block is an
aligned range of ``FANOUT`` ** ``LEVELS`` nodes and keeps each of its levels as one hex
string: a parent is the hash of a fixed-width substring of it, and the siblings of a node
are the substrings that flank it in its run. The blocks' tops are the nodes of the next
round; after the last, a language has one node, its subroot. The subroots in order of
language are the nodes of one more such tree, whose top is the root. Proofs then go
down: each block hands its children what lies above it.

Scale: texts are read once and never shuffled; what is ordered, grouped and joined are
digests. Numbers come from ranges of the order and their counts, blocks hold a bounded
number of nodes, and a round has 1 / 512 of the rows of the one before: no task or driver
sees a level. The root alone comes to the driver.

Defined cases: a null value counts as ``-``, a null language is a group of its own and
comes first, null ids come first in a language; rows that repeat an id are in order of
their leaf, rows equal in all columns are leaves each; an empty table has no root and
gives no rows; other columns than the five are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiltgrid.llm.common import ascii_lower, materialize, stored_place, table

FANOUT, LEVELS = 8, 3
BLOCK = FANOUT**LEVELS
#: Hex digits of a digest.
WIDE = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(*values: Column) -> Column:
    """Digest of the values, each with its length in UTF-8 bytes."""
    part = lambda v: F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))
    return F.sha2(F.concat(*(part(v.cast("string")) for v in values)), 256)


def tampered_text() -> Column:
    """The text with A-Z lower-cased."""
    text = F.col("text")
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(ascii_lower(text))  # lower() is the faster one


def leaves_of(docs: DataFrame) -> DataFrame:
    """(k, doc_id, leaf, changed, place): the key of the language, the leaf after tampering where 3 divides the id's CRC, and a small number that spreads equal rows."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rest = [F.col(c) for c in COLUMNS[:-1]]
    key = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang")))
    return docs.select(key.alias("k"), "doc_id", leaf_of(*rest, F.col("text")).alias("leaf"), F.when(hit, leaf_of(*rest, tampered_text())).alias("changed"), stored_place().alias("place"))


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df``, which has a column k, with the place ``i`` of each row in its k from 0, in this order, and the number ``n`` of k's rows."""
    ranged = df.repartitionByRange("k", *order).sortWithinPartitions("k", *order).withColumn("_at", F.monotonically_increasing_id())
    ranged = materialize(ranged)  # both reads below must see the same ranges
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = ranged.groupBy("k", part.alias("_p")).agg(F.count("*").alias("_n"), F.min(place).alias("_first"))
    by_key = Window.partitionBy("k")  # a row per range that has rows of the key
    counts = counts.withColumns({"_shift": F.sum("_n").over(by_key.orderBy("_p")) - F.col("_n") - F.col("_first"), "n": F.sum("_n").over(by_key)})
    out = ranged.withColumn("_p", part).join(counts.select("k", "_p", "_shift", "n"), ["k", "_p"])
    return out.withColumn("i", place + F.col("_shift")).drop("_at", "_p", "_shift")


def _parents(level: Column) -> Column:
    """The next level of a block: a digest of each run of digests."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / (FANOUT * WIDE)).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda r: F.sha2(F.substr(level, r * (FANOUT * WIDE) + 1, F.lit(FANOUT * WIDE)), 256)), "").cast("binary")


def blocks_of(nodes: DataFrame) -> DataFrame:
    """(k, b, n, height, kids, s0 .. , top) of nodes (k, i, n, node, own): levels are hex strings, as bytes for substrings to be found at once."""
    kids = F.array_sort(F.collect_list(F.struct("i", "node", "own")))
    blocks = nodes.groupBy("k", F.floor(F.col("i") / BLOCK).alias("b"), "n").agg(kids.alias("kids"))
    height = F.lit(LEVELS)  # of the block: fewer levels only where it is its key's only one
    for h in range(LEVELS - 1, -1, -1):
        height = F.when(F.col("n") <= FANOUT**h, h).otherwise(height)
    blocks = blocks.withColumns({"height": height, "s0": F.array_join(F.transform("kids", lambda c: c["node"]), "").cast("binary")})
    for h in range(1, LEVELS + 1):
        blocks = blocks.withColumn(f"s{h}", F.when(F.col("height") >= h, _parents(F.col(f"s{h - 1}"))))
    top = F.coalesce(*(F.col(f"s{h}") for h in range(LEVELS, -1, -1)))
    return blocks.withColumn("top", top.cast("string")).drop(f"s{LEVELS}")


def _segments(place: Column) -> Column:
    """The siblings left and right of a block's node at this place and of the nodes above it, level by level."""
    out = []
    for h in range(LEVELS):
        node = F.floor(place / FANOUT**h)
        nth = node % FANOUT
        cut = lambda first, n, h=h: F.substr(F.col(f"s{h}"), (first * WIDE + 1).cast("int"), (n * WIDE).cast("int")).cast("string")
        out.append(F.when(F.col("height") > h, F.struct(cut(node - nth, nth).alias("left"), cut(node + 1, FANOUT - 1 - nth).alias("right"))))
    return F.filter(F.array(*out), lambda s: s.isNotNull())


def fold_up(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks over nodes (k, i, n, node, own), and the top (k, top) of each key; ``most`` is the largest n."""
    rounds = []
    while True:
        rounds.append(materialize(blocks_of(nodes)))
        if most <= BLOCK:
            return rounds, rounds[-1].select("k", "top")
        most = -(-most // BLOCK)
        nodes = rounds[-1].select("k", F.col("b").alias("i"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("node"), F.lit(None).cast("int").alias("own"))


def hand_down(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(k, i, node, own, path, subroot) of the first round's nodes; ``above`` has the path and subroot (k, path, subroot) of each top."""
    found = above.withColumn("i", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        both = blocks.join(found.select("k", F.col("i").alias("b"), "path", "subroot"), ["k", "b"])
        kid = F.transform("kids", lambda c: F.struct(c["i"].alias("i"), c["node"].alias("node"), c["own"].alias("own"), F.concat(_segments(c["i"] - F.col("b") * BLOCK), F.col("path")).alias("path")))
        found = both.select("k", "subroot", F.explode(kid).alias("c")).select("k", "subroot", "c.*")
    return found


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, changed, subroot, root, path) of every row; ``path`` lists (left, right) siblings from the leaf to the root."""
    leaves = materialize(leaves_of(docs))
    nodes = numbered(leaves, ["doc_id", "leaf", "place"]).select("k", "i", "n", F.col("leaf").alias("node"), F.struct("doc_id", "changed").alias("own"))
    rounds, tops = fold_up(nodes, nodes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0])
    langs = numbered(tops.select(F.lit("").alias("k"), F.col("k").alias("of"), "top"), ["of"])
    langs = langs.select("k", "i", "n", F.col("top").alias("node"), F.col("of").alias("own"))
    upper, root = fold_up(langs, langs.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0])
    found = root.first()
    none = F.array().cast("array<struct<left:string,right:string>>")
    tops = hand_down(upper, root.select("k", none.alias("path"), F.col("top").alias("subroot")))
    rows = hand_down(rounds, tops.select(F.col("own").alias("k"), "path", F.col("node").alias("subroot")))
    return rows.select("own.doc_id", F.col("node").alias("leaf"), "own.changed", "subroot", F.lit(found["top"] if found else None).cast("string").alias("root"), "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest(table(spark, sf_dir, "documents"))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    out = found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE_SQL = """
with recursive crc as (
  select list_transform(range(256), lambda v: list_reduce(list_concat([v], range(8)), lambda c, j: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
texts as (
  select doc_id, source, lang, n_chars, text,
    case when xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 3 = 0
      then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as other
  from documents, crc),
heads as (
  select doc_id, lang, text, other, concat_ws('', coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')) as head
  from texts),
leaves as (
  select doc_id, coalesce('=' || lang, '') as k, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf, sha256(head || coalesce(strlen(other) || ':' || other, '-')) as changed
  from heads),
placed as (select *, row_number() over (partition by k order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by k) as n from leaves),
tree as (
  select 0 as lvl, k, i, n, leaf as h from placed
  union all
  select lvl + 1, k, i // 8, max(n + 7) // 8, sha256(string_agg(h, '' order by i)) from tree where n > 1 group by lvl, k, i // 8),
subroots as (select k, h as subroot, row_number() over (order by k) - 1 as i, count(*) over () as n from tree where n = 1),
top as (
  select 0 as lvl, i, n, subroot as h from subroots
  union all
  select lvl + 1, i // 8, max(n + 7) // 8, sha256(string_agg(h, '' order by i)) from top where n > 1 group by lvl, i // 8),
steps as (
  select doc_id, leaf, p.k, s.lvl, string_agg(s.h, '' order by s.i) filter (s.i < (p.i >> (3 * s.lvl))) as l, string_agg(s.h, '' order by s.i) filter (s.i > (p.i >> (3 * s.lvl))) as r
  from placed p join tree s on s.k = p.k and s.n > 1 and s.i // 8 = (p.i >> (3 * (s.lvl + 1))) group by all),
upper_steps as (
  select p.k, 1000 + s.lvl as lvl, string_agg(s.h, '' order by s.i) filter (s.i < (p.i >> (3 * s.lvl))) as l, string_agg(s.h, '' order by s.i) filter (s.i > (p.i >> (3 * s.lvl))) as r
  from subroots p join top s on s.n > 1 and s.i // 8 = (p.i >> (3 * (s.lvl + 1))) group by all),
every as (
  select doc_id, leaf, lvl, coalesce(l, '') as l, coalesce(r, '') as r from steps
  union all
  select doc_id, leaf, lvl, coalesce(l, ''), coalesce(r, '') from upper_steps join placed using (k)),
paths as (select doc_id, leaf, list({'l': l, 'r': r, 'h': ''} order by lvl) as path from every group by all),
found as (
  select p.doc_id, p.leaf, subroot, (select h from top where n = 1) as root, coalesce(path, []) as path,
    list_reduce(list_concat([{'l': '', 'r': '', 'h': changed}], coalesce(path, [])), lambda a, x: {'l': '', 'r': '', 'h': sha256(x.l || a.h || x.r)}).h as folded_root
  from placed p join subroots using (k) left join paths q on q.doc_id is not distinct from p.doc_id and q.leaf = p.leaf)
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) as proof_sha256, folded_root, folded_root = root as verified
from found
"""
