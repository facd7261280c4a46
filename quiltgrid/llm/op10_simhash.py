"""SimHash near-duplicates by a self-join of binary tries.

Two fingerprints that differ in at most ``budget`` of 64 bits agree on one of
``budget`` + 1 blocks of bits. Spark deals distinct fingerprints out by (block,
value); a task sorts each group, which makes it a binary trie, and walks pairs of
nodes down together, adding up the bits in which they differ and dropping a pair
of nodes once the budget is exceeded. A pair is reported in the first block on
which it agrees, so that it is counted once.

Scale: copies with equal fingerprints are one row before any pair is sought. A
group over ``GROUP_ROWS`` is dealt out again by the same argument on the bits that
its members don't share yet; as members differ, four rounds bound every group.
Tasks send on a spanning forest of the links and each fingerprint's number of
links, not all pairs. Components of the forest are found by alternating stars.

Defined cases: a null or blank text has fingerprint zero; fewer words than a
shingle are one shingle; repeated rows are copies of one another; a null doc_id
never names a component unless it stands alone; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgrid.llm.common import freed_shuffles, in_small_batches, materialize, table

SHINGLE_WORDS = 3
SEED = 42
BUDGET = 2
#: A group with more rows is dealt out again.
GROUP_ROWS = 1024
#: Rows that a task joins at once; a group is never cut.
CHUNK_ROWS = 1 << 15


# Fingerprints


#: For each byte, its bits as eight one-byte lanes of a number.
LANES = sum(((np.arange(256, dtype=np.uint64) >> np.uint64(j)) & np.uint64(1)) << np.uint64(8 * j) for j in range(8))


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``counts`` hashes: bits set in over half of a run; zero for an empty run."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full].astype(np.int64)
    pieces = (n + 254) // 255  # a lane counts to 255
    owner = np.repeat(np.arange(len(n)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(np.cumsum(n) - n, pieces) + 255 * nth
    first_piece = np.cumsum(pieces) - pieces
    columns = hashes.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        sums = np.add.reduceat(LANES[columns[:, k]], starts).view(np.uint8).reshape(-1, 8)
        totals = np.add.reduceat(sums.astype(np.int64), first_piece, axis=0)
        for j in range(8):
            out[full] |= (2 * totals[:, j] > n).astype(np.uint64) << np.uint64(8 * k + j)
    return out


def mixed(hashes: np.ndarray, table_no: int) -> np.ndarray:
    """Another hash of the same features, by the finaliser of splitmix64; table 0 has the hashes as they are."""
    if not table_no:
        return hashes
    x = hashes + np.uint64(0x9E3779B97F4A7C15 * table_no & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> list[bytes]:
    """Shingles of ``width`` words, A-Z lower-cased and joined by spaces; fewer words are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    if width == 1:
        return words
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


def hash_shingles(texts: list[str | None], width: int, distinct: bool, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles of all texts, and how many each text has."""
    import xxhash

    digest, found, counts = xxhash.xxh64_intdigest, [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = shingles(text, width)
        if distinct:
            own = set(own)
        counts[i] = len(own)
        found.append(np.fromiter((digest(s, seed) for s in own), np.uint64, len(own)))
    return (np.concatenate(found) if found else np.empty(0, np.uint64)), counts


def _slices(texts: list, most_chars: int = 1_000_000):
    """Runs of texts of limited length together, so that a task's arrays stay small."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > most_chars:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every document; ``fp`` is the 64 bits as a signed number."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for a, b in _slices(texts):
                fp = majority_bits(*hash_shingles(texts[a:b], width, False))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_small_batches(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


# Joining tries


def trie_pairs(group: np.ndarray, fp: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one group whose fingerprints differ in at most ``budget`` bits.

    Rows are sorted by (group, fp) and distinct, so that a node of a trie is a
    range of rows. The front holds pairs of nodes of one level.
    """
    n = len(fp)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.empty(0, np.int64)
    ends = np.r_[starts[1:], n]
    wide = ends - starts > 1
    alo, ahi = starts[wide], ends[wide]
    blo, bhi, err = alo.copy(), ahi.copy(), np.zeros(len(alo), np.int8)
    left, right = [], []
    for level in range(63, -1, -1):
        if not len(alo):
            break
        ones = np.r_[0, np.cumsum((fp >> np.uint64(level)) & np.uint64(1))].astype(np.int64)
        amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        same = alo == blo
        other = ~same
        parts = [
            (alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err),
            (alo, amid, bmid, bhi, err + 1), (amid[other], ahi[other], blo[other], bmid[other], err[other] + 1),
        ]
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*parts, strict=True))
        live = (err <= budget) & (ahi > alo) & (bhi > blo) & ~((alo == blo) & (ahi - alo < 2))
        alo, ahi, blo, bhi, err = alo[live], ahi[live], blo[live], bhi[live], err[live]
        leaf = (ahi - alo == 1) & (bhi - blo == 1)  # one fingerprint each: the rest of both paths at once
        x, y = alo[leaf], blo[leaf]
        near = np.bitwise_count(fp[x] ^ fp[y]) <= budget
        left.append(x[near])
        right.append(y[near])
        keep = ~leaf
        alo, ahi, blo, bhi, err = alo[keep], ahi[keep], blo[keep], bhi[keep], err[keep]
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Positions of edges that join the same rows as all edges do, the cheapest first (Boruvka)."""
    label, kept = np.arange(n), []
    at = np.argsort(cost, kind="stable")
    a, b = a[at], b[at]
    while len(at):
        la, lb = label[a], label[b]
        apart = la != lb
        at, a, b, la, lb = at[apart], a[apart], b[apart], la[apart], lb[apart]
        if not len(at):
            break
        best = np.full(n, len(at))
        rank = np.arange(len(at))
        np.minimum.at(best, la, rank)
        np.minimum.at(best, lb, rank)
        chosen = np.unique(best[best < len(at)])
        kept.append(at[chosen])
        x, y = la[chosen], lb[chosen]
        while True:
            low = np.minimum(label[x], label[y])
            if (label[x] == low).all() and (label[y] == low).all():
                break
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]
    return np.concatenate(kept) if kept else np.empty(0, np.int64)


def best_edges(n: int, a: np.ndarray, b: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Positions of the cheapest edge of each row that has one."""
    at = np.argsort(cost, kind="stable")
    best = np.full(n, len(at))
    np.minimum.at(best, a[at], np.arange(len(at)))
    np.minimum.at(best, b[at], np.arange(len(at)))
    return at[np.unique(best[best < len(at)])]


def block_masks(taken: int, budget: int) -> list[int]:
    """The bits that ``taken`` lacks, in ``budget`` + 1 blocks, each together with ``taken``."""
    free = [i for i in range(63, -1, -1) if not taken >> i & 1]
    cuts = [len(free) * k // (budget + 1) for k in range(budget + 2)]
    return [taken | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _earlier(path: tuple[int, ...], budget: int) -> list[int]:
    """Masks on which a pair must not agree, for it to belong to the masks of ``path``."""
    out, taken = [], 0
    for mask in path:
        blocks = block_masks(taken, budget)
        out += blocks[: blocks.index(mask)]
        taken = mask
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(prints: DataFrame, budget: int = BUDGET, sketch_bits: int | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links among ``prints`` (tab, node, fp, weight, sketch) of one ``tab``: a forest and degrees.

    Rows (node, other, links): ``other`` names a linked node of the forest, or is
    null in a row that gives the weight of the nodes that ``node`` links to. Nodes
    of a tab must have different fingerprints. With ``sketch_bits``, a link also
    needs sketches that differ in at most so many bits, and equal fingerprints
    may occur (they then are neighbours in the trie).
    """
    rows, paths, out = prints.withColumn("path", F.lit(0)), [(0,)], None
    keys = ["tab", "path", "value"]
    for last in (False, False, False, True):
        paths = [(*p, m) for p in paths for m in block_masks(p[-1], budget)]
        masks = F.array(*(F.lit(_signed(p[-1])) for p in paths))
        deeper = F.array(*(F.col("path") * (budget + 1) + i for i in range(budget + 1)))
        rows = rows.withColumn("path", F.explode(deeper)).withColumn("value", F.col("fp").bitwiseAND(F.get(masks, F.col("path"))))
        hot = None
        if not last:
            hot = materialize(rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > group_rows).drop("n"))
            if hot.isEmpty():
                hot = None
        part = materialize(_joined(rows if hot is None else rows.join(hot, keys, "left_anti"), paths, budget, sketch_bits))
        out = part if out is None else out.unionByName(part)
        if hot is None:
            break
        rows = rows.join(hot, keys, "left_semi").drop("value")
    return out


def _joined(rows: DataFrame, paths: list[tuple[int, ...]], budget: int, sketch_bits: int | None) -> DataFrame:
    earlier = [np.array(_earlier(p[1:], budget), np.uint64) for p in paths]
    keys = ["tab", "path", "value"]

    def links(chunk):
        """Links of whole groups: columns tab, path, value, node, fp, weight, sketch."""
        fp = chunk["fp"].view(np.uint64)
        order = np.lexsort((fp, *(chunk[k] for k in reversed(keys))))
        path, fp, node = chunk["path"][order], fp[order], chunk["node"][order]
        group = np.r_[0, np.cumsum(np.any([chunk[k][order][1:] != chunk[k][order][:-1] for k in keys], axis=0))]
        a, b = trie_pairs(group, fp, budget)
        own = np.ones(len(a), bool)
        diff = fp[a] ^ fp[b]
        for p in np.unique(path[a]):
            at = np.flatnonzero(path[a] == p)
            for e in earlier[p]:
                own[at] &= (diff[at] & e) != 0
        a, b, diff = a[own], b[own], diff[own]
        cost = np.bitwise_count(diff).astype(np.int64)
        if sketch_bits is not None and len(a):
            sketch = chunk["sketch"][order]
            near = np.zeros(len(a), np.int64)
            for k in range(sketch.shape[1]):
                near += np.bitwise_count(sketch[a, k] ^ sketch[b, k])
            ok = (near <= sketch_bits) & (node[a] != node[b])
            a, b, cost = a[ok], b[ok], near[ok]
        forest = spanning_forest(len(fp), a, b, cost)
        if sketch_bits is not None:  # links will be verified: each row's best is sent as well
            forest = np.unique(np.r_[forest, best_edges(len(fp), a, b, cost)])
        weight = chunk["weight"][order]
        degree = np.bincount(a, weight[b], len(fp)) + np.bincount(b, weight[a], len(fp))
        linked = np.flatnonzero(degree)
        return node[a[forest]], node[b[forest]], node[linked], degree[linked].astype(np.int64)

    def run(batches):
        import pyarrow as pa

        def columns(batch):
            out = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*keys, "node", "fp", "weight")}
            if sketch_bits is not None:
                flat = b"".join(batch.column("sketch").to_pylist())
                out["sketch"] = np.frombuffer(flat, np.uint64).reshape(batch.num_rows, -1)
            return out

        def result(chunk):
            x, y, node, degree = links(chunk)
            nodes, others = np.r_[x, node], pa.concat_arrays([pa.array(y, pa.int64()), pa.nulls(len(node), pa.int64())])
            return pa.RecordBatch.from_arrays([pa.array(nodes), others, pa.array(np.r_[np.zeros(len(x), np.int64), degree])], ["node", "other", "links"])

        held: list[dict] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(columns(batch))
            if sum(len(h["fp"]) for h in held) < CHUNK_ROWS:
                continue
            whole = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
            change = np.flatnonzero(np.any([whole[k][1:] != whole[k][:-1] for k in keys], axis=0))
            if not len(change):
                held = [whole]
                continue
            cut = change[-1] + 1  # the last group may go on
            yield result({c: v[:cut] for c, v in whole.items()})
            held = [{c: v[cut:] for c, v in whole.items()}]
        if held:
            yield result({c: np.concatenate([h[c] for h in held]) for c in held[0]})

    fields = [*keys, "node", "fp", "weight", *(["sketch"] if sketch_bits is not None else [])]
    return rows.select(*fields).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "node long, other long, links long")


# Components


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v): the least node of its component.

    Alternating large and small stars (Kiveris et al., 2014): in each, every node
    hands its neighbours its least neighbour. Minima are pre-aggregated and joined
    back, so that no neighbourhood is held in one place.
    """
    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(found) == mark or not found[0]:
            break
        mark = tuple(found)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = materialize(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


def simhash_groups(docs: DataFrame, width: int = SHINGLE_WORDS, budget: int = BUDGET) -> DataFrame:
    """(doc_id, fp, component_id, n_links) of every document.

    ``component_id`` is the least doc_id that links reach, ``n_links`` the number of
    other documents whose fingerprints differ in at most ``budget`` bits.
    """
    own = materialize(fingerprints(docs, width))
    prints = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("weight")))
    links = near_links(prints.select(F.lit(0).alias("tab"), F.col("fp").alias("node"), "fp", "weight"), budget)
    degree = links.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    member = components(links.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    # Nodes that are their component's least one have no row of their own yet.
    member = materialize(member.unionByName(member.select(F.col("component").alias("node"), "component").distinct()))
    names = prints.join(member, F.col("fp") == F.col("node")).groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_print = (
        prints.join(member.join(names, "component").select(F.col("node").alias("fp"), "component_id"), "fp", "left")
        .join(degree.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", F.coalesce("component_id", "least_id").alias("component_id"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    return own.join(of_print, "fp").select("doc_id", "fp", "component_id", "n_links")


# Near copies of whole texts, verified


SIMILAR_WORDS, SIMILARITY = 5, 0.8
#: Fingerprints of single words, by independent hashes, in each of which near copies may
#: meet; and how many bits of 64 may differ. Four in ten of the bits of fingerprints of
#: ``SIMILAR_WORDS`` words can differ at similarity 0.8, so that no small budget finds near
#: copies there. These tables find most copies with scattered changes, cheaply; whatever
#: they leave apart is sought by prefixes of shingles, which lose no pair.
TABLES, TABLE_BUDGET = 8, 3
#: A longer fingerprint of shingles, and its differing bits that a link may have: texts of
#: similarity 0.8 differ in 77 +- 8 bits.
SKETCH_WORDS, SKETCH_BITS = 8, 96
#: Documents in which shingles are counted, the least count of a common one, and how many are told to tasks.
COMMON_DOCS, COMMON_LEAST, COMMON_MOST = 20_000, 4, 100_000
#: Rounds in which the rows of a shingle are compared with one of them only, before all pairs are.
STAR_ROUNDS = 2


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and counts of shingles that documents of a sample share."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _slices(texts):
                yield pa.RecordBatch.from_arrays([pa.array(hash_shingles(texts[a:b], SIMILAR_WORDS, True)[0].view(np.int64))], ["gram"])

    step = max(1, docs.count() // COMMON_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).select("text")
    with freed_shuffles(docs.sparkSession):
        counts = in_small_batches(sample).mapInArrow(run, "gram long").groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON_LEAST)
        rows = counts.orderBy(F.desc("n"), "gram").limit(COMMON_MOST).collect()
    grams, n = np.array([r.gram for r in rows], np.int64).view(np.uint64), np.array([r.n for r in rows], np.int64)
    order = np.argsort(grams)
    return grams[order], n[order]


def needed(n: np.ndarray, similarity: float) -> np.ndarray:
    """The least number of a text's ``n`` shingles that a text of this similarity shares."""
    return np.ceil(similarity * n - 1e-9).astype(np.int64)


def prefixes(grams: np.ndarray, n: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each text, the rarest first, and how many they are.

    All texts have their shingles in one order, so that two of this similarity share
    one of their first n - ``needed`` + 1, whatever that order is.
    """
    rank = np.zeros(len(grams), np.int64)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], grams), len(common[0]) - 1)
        rank = np.where(common[0][at] == grams, common[1][at], 0)
    sizes = np.minimum(n, n - needed(n, similarity) + 1)
    order = np.lexsort((grams, rank, np.repeat(np.arange(len(n)), n)))
    nth = np.arange(len(grams)) - np.repeat(np.cumsum(n) - n, n)
    return grams[order[nth < np.repeat(sizes, n)]], sizes


def text_sketches(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, digest, fps, sketch, n_grams, rare): equal digests mean equal sets of shingles."""
    common = common_shingles(docs)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for a, b in _slices(texts):
                words, n = hash_shingles(texts[a:b], 1, True)
                fps = np.stack([majority_bits(mixed(words, k), n) for k in range(TABLES)], 1)
                grams, m = hash_shingles(texts[a:b], SIMILAR_WORDS, True)
                sketch = np.stack([majority_bits(mixed(grams, k), m) for k in range(SKETCH_WORDS)], 1)
                ends = np.cumsum(m)
                total = lambda x: np.diff(np.r_[np.uint64(0), np.cumsum(x, dtype=np.uint64)][np.r_[0, ends]])  # noqa: E731  wraps
                digest = np.stack([total(grams), total(mixed(grams, 99)), m.astype(np.uint64)], 1)
                binary = lambda x: pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())
                lists = lambda x, sizes: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(x.view(np.int64)))
                columns = [binary(digest), lists(fps.ravel(), np.full(b - a, TABLES)), binary(sketch), pa.array(m), lists(*prefixes(grams, m, similarity, common))]
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), *columns], ["doc_id", "digest", "fps", "sketch", "n_grams", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_small_batches(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, digest binary, fps array<long>, sketch binary, n_grams long, rare array<long>")


def _grouped(rows: DataFrame, member: DataFrame) -> DataFrame:
    """``rows`` with the component ``comp`` of their node."""
    return rows.join(member, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")


def _likely(pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs (u, v) that share enough of their first shingles, of ``pairs`` (u, v, nu, nv, n): sizes and how many they share.

    What they share besides lies behind the first shingles of the one whose first
    shingles end first, so that there is a bound on all that they share.
    """
    rest = F.ceil(F.greatest("nu", "nv") * similarity - 1e-9) - 1
    return pairs.where(F.col("n") + rest >= _least_shared("nu", "nv", similarity)).select("u", "v")


def _least_shared(na: str, nb: str, similarity: float):
    """The least number of shingles that texts of these sizes share if they are similar."""
    return F.ceil((F.col(na) + F.col(nb)) * (similarity / (1 + similarity)) - 1e-6)


def _alike(similarity: float):
    """Condition on sizes na and nb, without which texts can't be similar."""
    return F.least("na", "nb") >= F.greatest("na", "nb") * similarity - 1e-6


def _star_pairs(rows: DataFrame, similarity: float, turn: int) -> DataFrame:
    """Pairs of each row with one row of its shingle, in another component."""
    lead = F.min_by(F.struct(F.col("node").alias("b"), F.col("n_grams").alias("nb"), F.col("comp").alias("cb")), F.xxhash64("node", F.lit(turn))).alias("r")
    leads = rows.groupBy("gram").agg(lead).select("gram", "r.*")
    met = rows.select("gram", F.col("node").alias("a"), F.col("n_grams").alias("na"), F.col("comp").alias("ca")).join(leads, "gram")
    met = met.where("ca <> cb").where(_alike(similarity))
    u, v = F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")
    nu, nv = F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")), F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na"))
    return _likely(met.groupBy(u, v, nu.alias("nu"), nv.alias("nv")).agg(F.count("*").alias("n")), similarity)


def _cross_pairs(rows: DataFrame, reps: DataFrame, similarity: float, group_rows: int = GROUP_ROWS) -> DataFrame:
    """All pairs of rows that may be similar and are of different components.

    Similar texts share so many shingles that the first one shared has enough of both
    texts behind it, the place of a shingle being its number in the one order of all:
    rows of a shingle meet only where that holds. Rows outside a shingle's largest
    component meet all others. Both are dealt out in chunks, and a task joins two
    chunks at once, never a whole shingle.
    """
    sizes = rows.groupBy("gram", "comp").agg(F.count("*").alias("n")).groupBy("gram")
    sizes = sizes.agg(F.max_by("comp", F.struct("n", "comp")).alias("most"), F.max("n").alias("n_most"), F.sum("n").alias("n"), F.count("*").alias("comps")).where("comps > 1")
    few = F.ceil((F.col("n") - F.col("n_most")) / group_rows)
    sizes = sizes.select("gram", "most", few.alias("few"), F.ceil(F.col("n_most") / group_rows).alias("many"))
    rows = rows.join(sizes, "gram").withColumn("minor", F.col("comp") != F.col("most"))
    hashed = F.xxhash64("node")
    rows = rows.withColumn("chunk", F.when(F.col("minor"), F.pmod(hashed, F.col("few"))).otherwise(F.col("few") + F.pmod(hashed, F.col("many"))))
    left = rows.where("minor").select("gram", F.col("chunk").alias("i"), F.explode(F.sequence("chunk", F.col("few") + F.col("many") - 1)).alias("j"), F.col("node").alias("a"), F.col("n_grams").alias("na"), F.col("place").alias("pa"), F.col("comp").alias("ca"))
    right = rows.select("gram", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("chunk"), F.col("few") - 1))).alias("i"), F.col("chunk").alias("j"), F.col("node").alias("b"), F.col("n_grams").alias("nb"), F.col("place").alias("pb"), F.col("comp").alias("cb"))
    behind = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= _least_shared("na", "nb", similarity)
    met = left.join(right, ["gram", "i", "j"]).where("ca <> cb and (i <> j or a < b)").where(behind)
    met = materialize(met.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    first = reps.select("node", "n_grams", "rare").join(met.select(F.explode(F.array("u", "v")).alias("node")), "node", "left_semi")
    both = met.join(first.select(F.col("node").alias("u"), F.col("n_grams").alias("nu"), F.col("rare").alias("ru")), "u")
    both = both.join(first.select(F.col("node").alias("v"), F.col("n_grams").alias("nv"), F.col("rare").alias("rv")), "v")
    return _likely(both.select("u", "v", "nu", "nv", F.size(F.array_intersect("ru", "rv")).alias("n")), similarity)


def distinct_prints(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A row (tab, node, fp, weight, sketch) for each fingerprint of each table, and links (u, v) to it.

    Texts with the same words have equal fingerprints, however many they are: each
    is linked with the least node of its fingerprint, and that one alone is joined.
    """
    rows = reps.select("node", "sketch", F.posexplode("fps").alias("tab", "fp"))
    prints = rows.groupBy("tab", "fp").agg(F.min_by(F.struct("node", "sketch"), "node").alias("r"), F.count("*").alias("weight"))
    prints = materialize(prints.select("tab", "r.node", "fp", "weight", "r.sketch"))
    least = prints.where("weight > 1").select("tab", "fp", F.col("node").alias("u"))
    ties = rows.select("tab", "fp", F.col("node").alias("v")).join(least, ["tab", "fp"]).where("u <> v").select("u", "v")
    return prints, ties


def complete_links(links: DataFrame, reps: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """(node, component): components of verified ``links`` (u, v) and of all similar pairs between them.

    Pairs of one component are never compared. Rounds of stars join what is left of
    large groups; the last round takes all pairs of different components.
    """
    member = materialize(components(links))
    rows = _grouped(reps.select("node", "n_grams", "rare"), member).select("node", "n_grams", "comp", F.posexplode("rare").alias("place", "gram"))
    live = rows.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("gram")
    shared = materialize(rows.drop("comp").join(live, "gram"))
    tried = None
    for turn in range(STAR_ROUNDS + 1):
        own = _grouped(shared, member)
        pairs = _star_pairs(own, similarity, turn) if turn < STAR_ROUNDS else _cross_pairs(own, reps, similarity)
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["u", "v"], "left_anti"))
        if pairs.isEmpty():
            continue
        found = materialize(_verified(pairs, docs, similarity))
        tried = pairs if tried is None else tried.unionByName(pairs)
        if not found.isEmpty():
            member = materialize(_merged(member, found))
    return member


def _merged(member: DataFrame, links: DataFrame) -> DataFrame:
    """``member`` (node, component) after ``links`` (u, v) join some of its components.

    Only the graph whose nodes are components is searched; a component's least node
    has no row in ``member`` before, so that its row comes from that graph.
    """
    ends = links.select(F.col("u").alias("node"), "v").join(member, "node", "left").select(F.coalesce("component", "node").alias("u"), F.col("v").alias("node"))
    ends = ends.join(member, "node", "left").select("u", F.coalesce("component", "node").alias("v"))
    joined = materialize(components(ends))
    moved = member.join(joined.select(F.col("node").alias("component"), F.col("component").alias("least")), "component", "left")
    return moved.select("node", F.coalesce("least", "component").alias("component")).unionByName(joined)


def _verified(edges: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """The ``edges`` (u, v) between documents whose shingle sets have at least this Jaccard similarity."""
    ends = edges.select(F.explode(F.array("u", "v")).alias("doc_id"))
    texts = docs.select("doc_id", "text").join(ends, "doc_id", "left_semi")  # the rest of the texts isn't shuffled
    pairs = edges.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("a")), "u").join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("b")), "v")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            near = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = set(shingles(a, SIMILAR_WORDS)), set(shingles(b, SIMILAR_WORDS))
                both = len(x & y)
                near.append(both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(near, pa.bool_()))

    return in_small_batches(pairs).select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, group_id) of every document with an id; groups are named by their least doc_id.

    Documents link if the similarity of their sets of ``SIMILAR_WORDS``-word
    shingles, computed from both whole texts, is ``similarity`` or more. Texts
    without words are equal. Ids must be whole numbers; ``common.told_apart`` gives rows some.
    """
    docs = docs.where("doc_id is not null")
    own = materialize(text_sketches(docs, similarity))
    first = F.min_by(F.struct("doc_id", "fps", "sketch", "n_grams", "rare"), "doc_id").alias("r")
    reps = materialize(own.groupBy("digest").agg(first).select("digest", F.col("r.doc_id").cast("long").alias("node"), "r.fps", "r.sketch", "r.n_grams", "r.rare"))
    prints, ties = distinct_prints(reps)
    links = near_links(prints, TABLE_BUDGET, SKETCH_BITS).where("other is not null")
    edges = materialize(links.select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).unionByName(ties).distinct())
    member = complete_links(materialize(_verified(edges, docs, similarity)), reps, docs, similarity)
    names = reps.select("digest", "node").join(member, "node", "left").select("digest", F.coalesce("component", "node").alias("group_id"))
    return own.select("doc_id", "digest").join(names, "digest").select("doc_id", "group_id")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_links")
