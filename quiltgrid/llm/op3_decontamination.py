"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are normalised (lower case, runs of other characters than
letters and digits become one space). An item is cut into overlapping pieces, so
that a long enough part of it is found too. A piece of m characters that occurs
with at most e edits shares at least m - q + 1 - q * e of its q-grams with the text
on diagonals (place in text minus place in piece) at most e apart; grams that many
pieces hold may be left out if the bound is lowered by their number. Tasks count
shared q-grams in overlapping bands of diagonals, keep bands that reach the bound,
and align those inside a band of diagonals; at most e edits make a leak.

Texts of a slice lie apart by more characters, which no piece has, than a match may
skip: what stands beside a text neither adds to its leaks nor takes from them.

Scale: the documents are scanned where they lie, whole, in slices; no gram of them
is shuffled. The benchmark is broadcast in blocks of about ``BLOCK_CHARS``: a larger
benchmark means more scans, not a larger broadcast. A text's shared grams are counted
in overlapping runs of at most about ``MOST_SHARED``, however common its grams are.

Defined cases: null or empty texts have no leaks; items with fewer than ``Q``
characters after normalising are no evidence and are ignored; of equal items each
is reported, those without an id too, null ids as one item; repeated documents are reported each; empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quiltgrid.llm.common import in_small_batches, materialize, table

Q = 10
PIECE, STRIDE = 100, 50
EDIT_RATE = 0.06
#: Grams that more pieces than this hold are left out, as far as the bound stays at ``LEAST_SHARED``.
COMMON, LEAST_SHARED = 4, 12
BLOCK_CHARS = 1_000_000
SLICE = 1 << 18
#: Shared grams that are counted at once, but for those of one match's length of text.
MOST_SHARED = 1 << 21
FILTER_BITS = 22
BASE, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
OTHER = re.compile(r"[\W_]+")


def normalised(text: str | None) -> str:
    return OTHER.sub(" ", (text or "").lower()).strip()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Polynomial hash of the ``q`` characters from each place on."""
    out, width, power = codes.astype(np.uint64), 1, BASE
    for bit in bin(q)[3:]:  # double the width, then add one character where q's bit is set
        out = out[:-width] * np.uint64(power) + out[width:] if len(out) > width else out[:0]
        width, power = 2 * width, power * power & MASK
        if bit == "1":
            out = out[: max(0, len(codes) - width)] * np.uint64(BASE) + codes[width:]
            width, power = width + 1, power * BASE & MASK
    return (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


class Index:
    """Pieces of a block of benchmark items, and where each q-gram occurs in them."""

    def __init__(self, items: list[tuple[int, str | None]], q: int = Q, rate: float = EDIT_RATE):
        owners, pieces = [], []
        for item, text in items:
            text = normalised(text)
            if len(text) < q:
                continue
            last = max(0, len(text) - PIECE)
            for at in sorted({*range(0, last, STRIDE), last}):
                owners.append(item)
                pieces.append(_codes(text[at : at + PIECE]))
        self.owners, n = owners, len(pieces)
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.codes = np.zeros((n, PIECE), np.uint32)
        for i, p in enumerate(pieces):
            self.codes[i, : len(p)] = p
        self.edits = np.minimum((rate * self.length).astype(np.int64), (self.length - q) // q)
        self.reach = int(self.edits.max(initial=0))
        grams = [gram_hashes(p, q) for p in pieces]
        piece = np.repeat(np.arange(n), np.array([len(g) for g in grams], np.int64))
        place = np.concatenate([np.arange(len(g)) for g in grams]) if n else np.empty(0, np.int64)
        gram = np.concatenate(grams) if n else np.empty(0, np.uint64)
        self.shared = self.length - q + 1 - q * self.edits
        _, which, holders = np.unique(gram, return_inverse=True, return_counts=True)
        holders = holders[which] if n else holders
        rank = np.lexsort((-holders, piece))  # the commonest of each piece first
        nth = np.arange(len(rank)) - np.repeat(np.cumsum(np.bincount(piece, minlength=n)) - np.bincount(piece, minlength=n), np.bincount(piece, minlength=n))
        spare = np.maximum(self.shared - LEAST_SHARED, 0)
        left_out = rank[(nth < spare[piece[rank]]) & (holders[rank] > COMMON)]
        self.shared = self.shared - np.bincount(piece[left_out], minlength=n)
        kept = np.ones(len(gram), bool)
        kept[left_out] = False
        order = np.argsort(gram[kept], kind="stable")
        self.piece, self.place = piece[kept][order].astype(np.int32), place[kept][order].astype(np.int32)
        self.gram, self.first, self.count = np.unique(gram[kept][order], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.gram >> np.uint64(64 - FILTER_BITS)] = True

    def candidates(self, codes: np.ndarray, q: int = Q) -> tuple[np.ndarray, np.ndarray]:
        """(piece, diagonal) of each cell of ``reach`` + 1 diagonals from which a band that meets the bound starts."""
        gram = gram_hashes(codes, q)
        at = np.flatnonzero(self.filter[gram >> np.uint64(64 - FILTER_BITS)])
        if not len(at) or not len(self.gram):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        found = np.minimum(np.searchsorted(self.gram, gram[at]), len(self.gram) - 1)
        real = self.gram[found] == gram[at]
        at, found = at[real], found[real]
        edges, end = [], len(at)
        total, start = np.cumsum(self.count[found]), 0
        reach = 2 * PIECE + 4 * self.reach  # what one match spans, and more
        while start < end:  # runs of places overlap by a match's length, so that each match lies within one
            stop = max(int(np.searchsorted(total, MOST_SHARED + (total[start - 1] if start else 0))), int(np.searchsorted(at, at[start] + 2 * reach))) + 1
            edges.append((start, min(stop, end)))
            start = end if stop >= end else int(np.searchsorted(at, at[stop] - reach))
        cells = np.unique(np.concatenate([self._cells(len(codes), at[a:b], found[a:b]) for a, b in edges])) if edges else np.empty(0, np.int64)
        span, cell = self._span(len(codes))
        return cells // span, cells % span - PIECE // cell * cell - cell

    def _span(self, n: int) -> tuple[int, int]:
        """Room for the diagonals of a piece in ``n`` characters, a multiple of the width of a cell, which is given too."""
        cell = self.reach + 1
        return -(-(n + 4 * PIECE) // cell) * cell, cell

    def _cells(self, n_chars: int, at: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Cells, as piece * span + diagonal, of the shared grams ``found`` at these places."""
        n = self.count[found]
        k = np.repeat(self.first[found] - np.cumsum(n) + n, n) + np.arange(n.sum())
        piece, (span, cell) = self.piece[k].astype(np.int64), self._span(n_chars)
        key = np.sort(piece * span + np.repeat(at, n) - self.place[k] + PIECE // cell * cell + cell)
        inside = np.searchsorted(key, key + self.reach, "right") - np.arange(len(key))
        return np.unique(key[inside >= self.shared[key // span]] // cell) * cell

    def align(self, codes: np.ndarray, piece: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each piece within its band of diagonals, and where that match ends."""
        lead, width = self.reach, 4 * self.reach + 1
        padded = np.concatenate([np.zeros(2 * PIECE, np.uint32), codes, np.zeros(3 * PIECE + width, np.uint32)])
        start = diagonal - lead + 2 * PIECE
        offset = np.arange(width)
        cost = np.zeros((len(piece), width), np.int32)  # before the first character: a match may start anywhere
        out, end = np.full(len(piece), 1 << 20), np.zeros(len(piece), np.int64)
        for j in range(PIECE):
            same = padded[start[:, None] + offset + j] == self.codes[piece, j][:, None]
            step = cost + ~same
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)  # a character of the piece that the text lacks
            cost = np.minimum.accumulate(step - offset, axis=1) + offset  # characters that only the text has
            done = np.flatnonzero(self.length[piece] == j + 1)
            best = cost[done].argmin(1)
            out[done], end[done] = cost[done, best], diagonal[done] - lead + best + j + 1
        return out, end

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text's number, item, edits, end in the normalised text), the least edits of each text and item."""
        apart = 4 * self.reach + 2
        codes = _codes(("\0" * apart).join(texts))
        piece, diagonal = self.candidates(codes)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum([0, *(sizes + apart)])
        for i in range(0, len(piece), 20_000):
            p = piece[i : i + 20_000]
            edits, end = self.align(codes, p, diagonal[i : i + 20_000])
            ok = np.flatnonzero(edits <= self.edits[p])
            owner = np.searchsorted(starts, end[ok] - 1, "right") - 1
            for o, x, e, at in zip(owner.tolist(), p[ok].tolist(), edits[ok].tolist(), np.minimum(end[ok] - starts[owner], sizes[owner]).tolist(), strict=True):
                key = (o, self.owners[x])
                found[key] = min(found.get(key, (e, at)), (e, at))
        return [(*k, *v) for k, v in sorted(found.items(), key=lambda f: (f[0][0], f[0][1] is not None, f[0][1] if f[0][1] is not None else 0))]


def _indexes(benchmark: DataFrame, block_chars: int) -> Iterator[tuple[object, bool]]:
    """A broadcast index of each block of the benchmark, and whether it is the only one."""
    chars = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    for block in range(blocks):
        own = benchmark.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).select("item_id", "text")
        yield benchmark.sparkSession.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in own.collect()])), blocks == 1


def _slices(texts) -> Iterator[tuple[int, list[str]]]:
    """Runs of about ``SLICE`` normalised characters of an Arrow array, each with its first place."""
    at = 0
    while at < len(texts):
        some, size, start = [], 0, at
        while at < len(texts) and (size < SLICE or not some):
            some.append(normalised(texts[at].as_py()))
            size += len(some[-1])
            at += 1
        yield start, some


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, edits, end_char): each item that leaks into each document, at its best match."""
    id_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("item_id", item_type), T.StructField("edits", T.LongType()), T.StructField("end_char", T.LongType())])

    def scan(index):
        def run(batches):
            import pyarrow as pa

            for batch in batches:
                for start, some in _slices(batch.column("text")):
                    rows = index.value.leaks(some)
                    found = batch.column("doc_id").take(pa.array([start + r[0] for r in rows], pa.int64()))
                    rest = [pa.array([r[k] for r in rows], kind) for k, kind in ((1, to_arrow_type(item_type)), (2, pa.int64()), (3, pa.int64()))]
                    yield pa.RecordBatch.from_arrays([found, *rest], schema.fieldNames())

        return in_small_batches(docs).select("doc_id", "text").mapInArrow(run, schema)

    found = []
    for index, alone in _indexes(benchmark, block_chars):
        found.append(scan(index) if alone else materialize(scan(index)))
        if not alone:  # one block at a time is in memory
            index.unpersist()
    return reduce(DataFrame.unionByName, found)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` without any leak, where they lie; whatever their ids are, each row is judged by its text."""

    def scan(docs, index):
        def run(batches):
            import pyarrow as pa

            for batch in batches:
                leaking = {start + r[0] for start, some in _slices(batch.column("text")) for r in index.value.leaks(some)}
                yield batch.filter(pa.array([i not in leaking for i in range(batch.num_rows)], pa.bool_()))

        return in_small_batches(docs).mapInArrow(run, docs.schema)

    for index, alone in _indexes(benchmark, block_chars):
        docs = scan(docs, index) if alone else materialize(scan(docs, index))
        if not alone:
            index.unpersist()
    return docs


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
