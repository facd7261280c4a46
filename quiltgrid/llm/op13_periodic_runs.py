"""Periodic runs of words, by suffix trees with constant-time longest common extensions.

A run is a stretch of consecutive words with smallest period q that is at least
``least`` words and two periods long and that no neighbouring word extends. Every run
holds a Lyndon word of one of two opposite orders of words at which the next smaller
suffix begins one period later. So each place and the next smaller suffix of each order
make a candidate, which the longest common extensions to the right (tree of the words)
and to the left (tree of their reversal) make a run or not. The trees are Ukkonen's, an
extension is the depth of two leaves' lowest common ancestor, found as the least depth
between them in the Euler tour. Collapsing a run keeps its first period.

Trees are built where runs can be. A run of 12 words or more with two periods repeats
each of its words within a gram of 6 words that lies one period away, at most half the
run. Stretches of words that such grams cover, repeated within half the stretch, hold
all runs whole; grams are compared by hash, so that a stretch may be too much, never
too little.

Scale: a document is worked on where it lies, whole; nothing is shuffled. Memory of a
task is that of a slice of ``SLICE`` bytes of text, or of one longer document.

Defined cases: a null, empty or blank text has no words and no run, its collapsed text
is empty; rows that repeat an id, or have none, are worked on each; an empty table gives
no rows; other columns than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quiltgrid.llm.common import table, words_of

LEAST = 12
SLICE = 8 << 20
RUN = "struct<start:bigint,length:bigint,period:bigint>"
FAR = np.int64(1 << 60)


class SuffixTree:
    """Ukkonen's suffix tree of numbers from 1, which a 0 is added to; ``order`` has the places of the suffixes, ascending."""

    def __init__(self, numbers: list[int]):
        s = [*numbers, 0]
        wide, n = max(s) + 1, len(s)
        begin, end, link = [0] * (2 * n), [n] * (2 * n), [0] * (2 * n)  # of the edge into a node; 0 is the root
        leaves, child = [], {}  # nodes of the suffixes; nodes by that above and the edge's first number
        found, size = child.get, 1
        node = edge = length = todo = 0
        for i, c in enumerate(s):
            last = 0
            todo += 1
            while todo:
                if not length:
                    edge = i
                key = node * wide + s[edge]
                below = found(key)
                if below is None:
                    child[key] = size
                    if last:
                        link[last], last = node, 0
                else:
                    at, stop = begin[below], end[below]
                    span = (stop if stop <= i else i + 1) - at
                    if length >= span:
                        edge, length, node = edge + span, length - span, below
                        continue
                    turn = s[at + length]
                    if turn == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    child[key], begin[size], end[size], begin[below] = size, at, at + length, at + length
                    child[size * wide + turn], child[size * wide + c] = below, size + 1
                    if last:
                        link[last] = size
                    last, size = size, size + 1
                begin[size] = i
                leaves.append(size)
                size, todo = size + 1, todo - 1
                if node:
                    node = link[node]
                elif length:
                    edge, length = i - todo + 1, length - 1
        suffix = [-1] * size
        for k, leaf in enumerate(leaves):
            suffix[leaf] = k
        self._tour(n, wide, child, begin, end, suffix)

    def _tour(self, n: int, wide: int, child: dict, begin: list, end: list, suffix: list) -> None:
        """The depth of a node before each of its children, in order of the tour, and where the leaves come between them."""
        keys = np.fromiter(child.keys(), np.int64, len(child))
        by_key = np.argsort(keys)
        kids = np.fromiter(child.values(), np.int64, len(child))[by_key].tolist()
        first = np.searchsorted(keys[by_key], np.arange(len(suffix) + 1) * wide).tolist()
        tour, seen, self.order = [], [0] * n, []
        path = [(iter(kids[: first[1]]), 0)]
        while path:
            below, depth = path[-1]
            for c in below:
                tour.append(depth)
                leaf = suffix[c]
                if leaf < 0:
                    path.append((iter(kids[first[c] : first[c + 1]]), depth + end[c] - begin[c]))
                    break
                seen[leaf] = len(tour)
                self.order.append(leaf)
            else:
                path.pop()
        self.seen, self.least = np.array(seen), [np.array(tour, np.int32)]  # the least of each 2 ** k from each place
        while len(self.least[-1]) > 1 << len(self.least) - 1:
            half = 1 << len(self.least) - 1
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of what the suffixes from ``i`` and from ``j``, other places, have in common."""
        a, b = np.minimum(self.seen[i], self.seen[j]), np.maximum(self.seen[i], self.seen[j])
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(level).tolist():
            m = level == k
            out[m] = np.minimum(self.least[k][a[m]], self.least[k][b[m] - (1 << k)])
        return out


def lyndon_roots(order: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(places, place of the next suffix that is smaller, or greater): the longest Lyndon words of both orders."""
    rank = [0] * len(order)
    for k, i in enumerate(order):
        rank[i] = k
    begin, after, low, high = [], [], [], []
    for j, r in enumerate(rank):
        while low and rank[low[-1]] > r:
            begin.append(low.pop())
            after.append(j)
        while high and rank[high[-1]] < r:
            begin.append(high.pop())
            after.append(j)
        low.append(j)
        high.append(j)
    return np.array(begin, np.int64), np.array(after, np.int64)


def runs_of(words: list, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of every run of a sequence, by start, then period."""
    n, known = len(words), {}
    numbers = [known.setdefault(w, len(known) + 1) for w in words]
    tree = SuffixTree(numbers)
    i, j = lyndon_roots(tree.order)
    half = 2 * (j - i) <= n
    i, j = i[half], j[half]
    stop = j + tree.lce(i, j)
    del tree  # one tree at a time
    start = i - SuffixTree(numbers[::-1]).lce(n - i, n - j)
    found = np.stack([start, j - i, stop - start], axis=1)
    return np.unique(found[found[:, 2] >= np.maximum(least, 2 * found[:, 1])], axis=0)[:, [0, 2, 1]]


def stretches(words: np.ndarray, text: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the stretches that may hold runs of ``words``, hashes of which those of one ``text`` lie together.

    Texts lie apart by a place whose ``text`` is -1.
    """
    q = least // 2
    if len(words) < q:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gram = np.zeros(len(words) - q + 1, np.uint64)
    for k in range(q):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(gram)]
    at = np.flatnonzero((text[: len(gram)] == text[q - 1 :]) & (text[: len(gram)] >= 0))
    key = gram[at] + (text[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    by_key = np.argsort(key, kind="stable")
    key, place = key[by_key], at[by_key]
    step = np.where(key[1:] == key[:-1], place[1:] - place[:-1], FAR)
    near = np.full(len(at), FAR)
    near[by_key[1:]] = step
    near[by_key[:-1]] = np.minimum(near[by_key[:-1]], step)
    while True:
        heads = np.flatnonzero(np.diff(at, prepend=-FAR) > q)
        size = at[np.append(heads[1:], len(at)) - 1] + q - at[heads] if len(at) else at
        kept = near <= np.repeat(np.where(size < least, 0, size // 2), np.diff(np.append(heads, len(at))))
        if kept.all():
            return at[heads], at[heads] + size
        at, near = at[kept], near[kept]


def _slices(texts: list) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in slices."""
    some, size = [], 0
    for text in texts:
        some.append((text or b"").split())  # of bytes: at the six ASCII white-space characters
        size += len(text or b"")
        if size >= SLICE:
            yield some
            some, size = [], 0
    if some:
        yield some


def slice_runs(texts: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """The runs of each text's words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    words, text = np.zeros(int(sizes.sum()) + len(texts), np.uint64), np.full(int(sizes.sum()) + len(texts), -1, np.int64)
    for k, (start, some) in enumerate(zip(starts.tolist(), texts, strict=True)):
        words[start : start + len(some)] = np.fromiter(map(hash, some), np.int64, len(some)).view(np.uint64)
        text[start : start + len(some)] = k
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for first, end in zip(*(x.tolist() for x in stretches(words, text, least)), strict=True):
        k = int(text[first])
        own = first - int(starts[k])
        found[k].append(runs_of(texts[k][own : own + end - first], least) + np.array([own, 0, 0]))
    return [np.concatenate(f) if f else np.empty((0, 3), np.int64) for f in found]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but those that a run has after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) of each row: (start, length, period) of all runs in order, and the text without their repeats."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("runs", T._parse_datatype_string(f"array<{RUN}>")), T.StructField("collapsed", T.StringType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = 0
            for texts in _slices(batch.column("text").to_pylist()):
                found = slice_runs(texts, least)
                each = np.concatenate(found)
                parts = pa.StructArray.from_arrays([pa.array(each[:, k], pa.int64()) for k in range(3)], ["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), parts)
                short = pa.array([collapsed(t, f).decode("utf-8", "replace") for t, f in zip(texts, found, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)).cast(to_arrow_type(id_type)), lists, short], schema.fieldNames())
                at += len(texts)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents repeat some of their words to their end, as the query's contract says."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = words_of(F.col("text"))
    rows = docs.select("doc_id", "text", F.when(crc % 10 == 0, words).alias("_w"), F.floor(crc / 10).alias("_g")).withColumn("_n", F.size("_w").cast("long"))
    rows = rows.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    rows = rows.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    rest = (F.col("_n") - F.col("_a")).cast("int")
    again: Column = F.flatten(F.array_repeat(F.slice("_w", (F.col("_a") + 1).cast("int"), F.col("_p")), F.ceil(rest / F.col("_p")).cast("int")))
    text = F.array_join(F.concat(F.slice("_w", 1, F.col("_a").cast("int")), F.slice(again, F.lit(1), rest)), " ")
    return rows.select("doc_id", F.when(F.col("_a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # Runs are in order of start and period: of the longest, the first comes first.
    longest = F.array_max(F.transform("runs", lambda r: r["length"]))
    best = F.get(F.filter("runs", lambda r: r["length"] == longest), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period"))
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
