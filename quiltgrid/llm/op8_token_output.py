"""Token-ID output, compressed by a Re-Pair grammar for each shard.

Documents are dealt out by ranges of doc_id and sorted; a task encodes them, appends
the end id to each and cuts its ids into shards of about ``SHARD_IDS``. A shard's
ids are compressed by repeatedly replacing frequent pairs of symbols by
nonterminals; each round takes the most frequent pairs that can't overlap one
another, and rounds go on until no pair is frequent. In a run of one symbol, pairs
are replaced from the left. A shard is one row of a Parquet folder: rules, the remaining sequence and
the length of each symbol's expansion, from which any document is decoded without
the rest of its shard.

Texts are encoded by the tokenizers library, special tokens included. The
pre-tokenizer of byte-level BPE begins a new piece at each single space between two
other characters, at the first of line feeds, and at a mark after a letter, so a text
with no other white space is cut there and each of a slice's different parts is
encoded once; other texts, and all texts of another kind of tokenizer, are encoded as
they are. A worker remembers short parts and looks them up by hash.

Scale: one shuffle, of the texts by id; shards bound what a task holds; starts are
summed in two steps, within a partition by its task and over partitions by one row
each. Rows of one id are spread by their text's hash, equal rows by where they lie.

Defined cases: a null or empty text has the end id alone; null ids come first;
repeated ids follow one another in order of their texts' hashes; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import os
import string
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiltgrid.llm.common import shared_dir, table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SHARD_IDS = 1_000_000
#: Pairs considered in a round of replacement, and the least count of a pair.
PAIRS, LEAST_COUNT = 4096, 16
#: Marks, as a power of two, by which places of chosen pairs are sought before they are compared.
MARK_BITS = 16
#: Encoded pieces of texts, of at most LONGEST bytes, that a worker remembers during a query (about 50 bytes each), fewer than 2 ** PLACE_BITS.
MEMORY, LONGEST = 1_000_000, 64
#: Bits of a remembered piece's number beside those of its hash.
PLACE_BITS = 24
#: Characters of documents that are encoded together, but for the last one's.
TOGETHER = 1 << 22
#: White space but for spaces and line feeds, in a pattern's brackets.
OTHER_BLANKS = "\t\r\x0b\x0c\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Texts are not cut where there are double spaces, spaces beside line feeds or ends, or any other white space.
UNCUT = f"  |\n | \n|^ | $|[{OTHER_BLANKS}]"
#: Bytes: ASCII marks, ASCII letters, and of the letters from U+00C0 to U+00FF the first and the later one.
SPACE, LINE_FEED, FIRST_BYTE = 0x20, 0x0A, 0xC3
STOP, LETTER, LATER_BYTE = (np.isin(np.arange(256), list(some)) for some in (string.punctuation.encode(), string.ascii_letters.encode(), {*range(0x80, 0xC0)} - {0x97, 0xB7}))

SHARD_SCHEMA = "part int, nth int, before long, n_ids long, first_id long, last_id long, doc_ids array<long>, lengths array<long>, first_rule int, rules binary, symbols binary, expansion binary"


class Places:
    """Different strings in order of their coming, and where a string is among them.

    A sorted table of hashes, each with its string's number below it, is kept and added
    to, where a set would be made anew of all strings for each search. Whatever a hash
    finds is compared as a string.
    """

    def __init__(self):
        import pyarrow as pa

        self.strings, self.table = pa.array([], pa.large_string()), np.empty(0, np.uint64)

    def __len__(self) -> int:
        return len(self.strings)

    @staticmethod
    def _hashes(some) -> np.ndarray:
        return np.fromiter(map(hash, some.to_numpy(zero_copy_only=False)), np.int64, len(some)).view(np.uint64) >> PLACE_BITS << PLACE_BITS

    def find(self, some) -> np.ndarray:
        """The number of each of ``some``; -1 if it is not there."""
        import pyarrow as pa
        import pyarrow.compute as pc

        out, keys = np.full(len(some), -1), self._hashes(some)
        at = np.searchsorted(self.table, keys)
        within = np.flatnonzero(at < len(self.table))
        entry = self.table[at[within]]
        like = entry >> PLACE_BITS == keys[within] >> PLACE_BITS
        within, place = within[like], (entry[like] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        same = pc.equal(self.strings.take(pa.array(place)), some.take(pa.array(within))).to_numpy(zero_copy_only=False)
        out[within[same]] = place[same]
        return out

    def add(self, new):
        import pyarrow as pa

        numbers = np.arange(len(self.strings), len(self.strings) + len(new), dtype=np.uint64)
        self.table = np.sort(np.concatenate([self.table, self._hashes(new) | numbers]))
        self.strings = pa.concat_arrays([self.strings, new])


class Encoder:
    """Ids of texts by the tokenizers library, many texts at once.

    As a broadcast value it is made once a worker, so that tasks of one query share
    the tokenizer and the pieces already encoded; only its path is sent.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        self.path, self.end_id, self.tokenizer = path, end_id, None

    def __getstate__(self) -> dict:
        return {"path": self.path, "end_id": self.end_id, "tokenizer": None}

    def open(self):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        if self.tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
            self.tokenizer = Tokenizer.from_file(self.path)
            rule, vocabulary = self.tokenizer.pre_tokenizer, self.tokenizer.get_vocab()
            self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
            self.cuts = self.tokenizer.normalizer is None and isinstance(rule, ByteLevel) and rule.use_regex and not rule.add_prefix_space and isinstance(self.tokenizer.model, BPE) and not any(set(" \n") & set(t) for t in self.special)
            self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
            for token, i in vocabulary.items():  # byte-level tokens have a character for each byte
                self.n_bytes[i] = len(token)
            self.pieces, self.ids, self.sizes = Places(), np.empty(0, "<u4"), np.empty(0, np.int64)
        return self.tokenizer

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each has."""
        found = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.empty(0, "<u4"), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def _learn(self, new, space: str = " ") -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces after that white space, encoded as short texts; bytes that tokens stand for tell them apart."""
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pa.LargeListArray.from_arrays(pa.array([*range(0, len(new), 100), len(new)], pa.int64()), new)
        some = pc.binary_join(lists, pa.scalar(space, new.type)).to_pylist()
        ids, _ = self._encode([space + s for s in some])
        ends = np.cumsum(pc.binary_length(new).to_numpy(zero_copy_only=False) + 1)
        cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends, "right")
        return ids, np.diff(cuts, prepend=0)

    def _encode_parts(self, new) -> tuple[np.ndarray, np.ndarray]:
        """The same of parts: those that begin with white space and have no other may follow one another in one text."""
        import pyarrow as pa
        import pyarrow.compute as pc

        found, order, apart = [], [], np.ones(len(new), bool)
        for space in " \n" if self.cuts else "":
            own = pc.match_substring_regex(new, f"^{space}[^ \n{OTHER_BLANKS}]+$")
            for token in self.special:
                own = pc.and_not(own, pc.match_substring(new, token))
            found.append(self._learn(pc.utf8_slice_codeunits(new.filter(own), 1), space))
            order.append(np.flatnonzero(own.to_numpy(zero_copy_only=False)))
            apart[order[-1]] = False
        found.append(self._encode(new.filter(pa.array(apart)).to_numpy(zero_copy_only=False).tolist()))
        order.append(np.flatnonzero(apart))
        ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        back = np.argsort(np.concatenate(order))
        return joined(ids, sizes, back), sizes[back]

    def _uncut(self, texts) -> np.ndarray:
        import pyarrow.compute as pc

        if not self.cuts:
            return np.ones(len(texts), bool)
        out = pc.match_substring_regex(texts, UNCUT)
        for token in self.special:
            out = pc.or_(out, pc.match_substring(texts, token))
        return out.to_numpy(zero_copy_only=False)

    def _parts(self, texts):
        """The parts of all texts in order as one Arrow array, and how many each text has."""
        import pyarrow as pa

        bounds, data = _buffers(texts)
        cut = np.zeros(len(data), bool)
        cut[1:] = (data[1:] == SPACE) | (data[1:] == LINE_FEED) & (data[:-1] != LINE_FEED) | STOP[data[1:]] & LETTER[data[:-1]]
        cut[2:] |= STOP[data[2:]] & LATER_BYTE[data[1:-1]] & (data[:-2] == FIRST_BYTE)
        cut &= ~np.repeat(self._uncut(texts), np.diff(bounds))
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        at = np.flatnonzero(cut)
        parts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data))
        return parts, np.diff(np.searchsorted(at, bounds))

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the Arrow array ``texts``, the end id after each, and how many each has with it."""
        import pyarrow as pa
        import pyarrow.compute as pc

        self.open()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        parts, n_parts = self._parts(texts)
        known = parts.dictionary_encode()
        entry = self.pieces.find(known.dictionary)
        new = np.flatnonzero(entry < 0)
        ids, sizes = self.ids, self.sizes
        if len(new):
            words = known.dictionary.take(pa.array(new))
            more, more_sizes = self._encode_parts(words)
            entry[new] = len(sizes) + np.arange(len(new))
            ids, sizes = np.concatenate([ids, more]), np.concatenate([sizes, more_sizes])
            kept = np.flatnonzero(pc.binary_length(words).to_numpy(zero_copy_only=False) <= LONGEST)
            if len(self.sizes) + len(kept) <= MEMORY:  # early parts are the frequent ones and stay
                self.pieces.add(words.take(pa.array(kept)))
                self.ids, self.sizes = np.concatenate([self.ids, joined(more, more_sizes, kept)]), np.concatenate([self.sizes, more_sizes[kept]])
        # This slice's different parts, and the end id.
        ids, sizes = np.append(joined(ids, sizes, entry), np.uint32(self.end_id)), np.append(sizes[entry], 1)
        ends = np.cumsum(n_parts)
        which = np.insert(known.indices.to_numpy(zero_copy_only=False), ends, len(entry))
        n = np.cumsum(sizes[which])[ends + np.arange(len(ends))]
        return joined(ids, sizes, which), np.diff(n, prepend=0)


def _buffers(strings) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings of a large Arrow array begin and end among its bytes, and these."""
    bounds = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset :][: len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    data = strings.buffers()[2]
    return bounds - bounds[0], np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.empty(0, np.uint8)


def joined(data: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``which`` of ``data``, whose runs have these sizes, one after another."""
    n = sizes[which]
    start = (np.cumsum(sizes) - sizes)[which] - (np.cumsum(n) - n)
    total = int(n.sum())
    kind = np.int32 if max(total, len(data)) < 1 << 31 else np.int64
    at = np.repeat(start.astype(kind), n)
    at += np.arange(total, dtype=kind)
    return data[at]


def _often(own: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs ``own`` occur ``least`` times, in ascending order, and how often."""
    own = np.sort(own)
    if len(own) < least:
        return own[:0], np.empty(0, np.int64)
    # Where a pair occurs often enough, the place ``least`` - 1 further holds it too.
    often = own[: len(own) - least + 1][own[: len(own) - least + 1] == own[least - 1 :]]
    often = often[np.r_[True, often[1:] != often[:-1]][: len(often)]]  # sorted as it is
    return often, np.searchsorted(own, often, "right") - np.searchsorted(own, often)


def frequent_pairs(own: np.ndarray, least: int, most: int) -> np.ndarray:
    """The ``most`` commonest of the pairs ``own`` that occur ``least`` times, the commonest first."""
    often, count = _often(own, least)
    return often[np.argsort(-count, kind="stable")[:most]]


def compress(ids: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (left, right), the remaining symbols, and the length of each rule's expansion.

    A pair of known symbols never gets commoner by a replacement. So places whose pair is
    too rare are not counted again until one of its symbols is replaced.
    """
    seq, rules = ids.astype(np.uint32), [np.empty((0, 2), np.int64)]
    spans, live = np.ones(first_rule, np.int64), np.ones(len(ids), bool)
    while len(seq) > 1:
        at = np.flatnonzero(live[:-1])
        left, right = seq[at], seq[at + 1]
        if len(spans) <= 1 << 16:  # a pair of symbols is one number, the narrower the faster
            low, own = 16, left << np.uint32(16) | right
        else:
            low, own = 32, left.astype(np.uint64) << np.uint64(32) | right
        twin = np.flatnonzero(left == right)
        counted = own
        if len(twin):  # in a run of equal symbols, every second pair counts: the others overlap it
            run = np.cumsum(np.diff(at[twin], prepend=-2) > 1)
            nth = np.arange(len(twin)) - np.flatnonzero(np.diff(run, prepend=0))[run - 1]
            apart = np.ones(len(own), bool)
            apart[twin[nth & 1 == 1]] = False
            counted = own[apart]
        often, count = _often(counted, LEAST_COUNT)
        lefts, rights, chosen = set(), set(), []
        for p in often[np.argsort(-count, kind="stable")[:PAIRS]].tolist():  # a symbol is a left one, a right one or in its own pair: chosen pairs never overlap
            a, b = p >> low, p & (1 << low) - 1
            if a not in rights and b not in lefts and (a != b or a not in lefts and a not in rights):
                lefts.add(a)
                rights.add(b)
                chosen.append(p)
        if not chosen:
            break
        chosen = np.sort(np.array(chosen, own.dtype))
        mark = np.zeros(1 << MARK_BITS, np.uint8)
        place = lambda pairs: (pairs.astype(np.uint32) ^ (pairs >> low).astype(np.uint32)) * np.uint32(2654435761) >> np.uint32(32 - MARK_BITS)  # noqa: E731, B023
        mark[place(often)] = 1
        mark[place(chosen)] = 2
        slot = np.zeros(1 << MARK_BITS, np.int64)
        slot[place(chosen)] = np.arange(len(chosen))
        spot = place(own)
        kind = mark[spot]
        live[at[kind == 0]] = False
        some = np.flatnonzero(kind == 2)
        if len(twin):
            some = some[apart[some]]
        pairs, rule = own[some], slot[spot[some]]
        other = np.flatnonzero(chosen[rule] != pairs)  # not chosen, or of two chosen pairs with one mark
        rule[other] = np.minimum(np.searchsorted(chosen, pairs[other]), len(chosen) - 1)
        hit = chosen[rule] == pairs
        some, rule = at[some[hit]], rule[hit]
        kept = np.ones(len(seq), bool)
        kept[some + 1] = False
        seq[some] = len(spans) + rule
        live[some] = live[np.maximum(some - 1, 0)] = True
        seq, live = seq[kept], live[kept]
        new = np.stack([chosen >> low, chosen & (1 << low) - 1], 1).astype(np.int64)
        rules.append(new)
        spans = np.concatenate([spans, spans[new].sum(1)])
    return np.concatenate(rules).astype("<u4"), seq.astype("<u4"), spans[first_rule:].astype("<u4")


def _expand_rules(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """The ids that the rules stand for, one after another; each pass undoes a level of rules."""
    out = np.arange(first_rule, first_rule + len(rules))
    while len(out) and (big := out >= first_rule).any():
        n = 1 + big.astype(np.int64)
        starts = np.cumsum(n) - n
        wide = np.empty(n.sum(), np.int64)
        pair = rules[out[big] - first_rule]
        wide[starts[~big]] = out[~big]
        wide[starts[big]], wide[starts[big] + 1] = pair[:, 0], pair[:, 1]
        out = wide
    return out


class Shard:
    """A shard's row, unpacked once, from which any range of its ids is decoded."""

    def __init__(self, row: dict):
        unpack = lambda name: np.frombuffer(row[name], "<u4").astype(np.int64)
        first, spans, symbols = row["first_rule"], unpack("expansion"), unpack("symbols")
        rules = unpack("rules").reshape(-1, 2)
        # Symbols as runs of one table: an id for itself, then what rules stand for.
        self.data = np.concatenate([np.arange(first), _expand_rules(rules, first)]).astype("<u4")
        self.sizes = np.concatenate([np.ones(first, np.int64), spans])
        self.symbols, self.ends = symbols, np.cumsum(self.sizes[symbols])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``: only the symbols over that range are expanded."""
        if start >= stop:
            return np.empty(0, "<u4")
        a, b = np.searchsorted(self.ends, start, "right"), np.searchsorted(self.ends, stop, "left") + 1
        before = self.ends[a - 1] if a else 0
        return joined(self.data, self.sizes, self.symbols[a:b])[start - before : stop - before]


def token_shards(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """A row per shard, in order of (part, nth): ids of documents in ascending order of doc_id."""
    encoder = docs.sparkSession.sparkContext.broadcast(Encoder(tokenizer_path, end_id))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, encode, nth, before = TaskContext.get().partitionId(), encoder.value, 0, 0
        size = max(end_id, *encode.open().get_vocab().values()) + 1  # a vocabulary may have gaps
        ids, lengths, owners = np.empty(0, "<u4"), np.empty(0, np.int64), []

        def shard(n_docs: int):
            nonlocal ids, lengths, owners, nth, before
            n = int(lengths[:n_docs].sum())
            rules, symbols, expansion = compress(ids[:n], size)
            own = owners[:n_docs]
            known = [i for i in own if i is not None]
            row = {"part": part, "nth": nth, "before": before, "n_ids": n, "first_id": min(known, default=None), "last_id": max(known, default=None), "doc_ids": own, "lengths": lengths[:n_docs], "first_rule": size, "rules": rules.tobytes(), "symbols": symbols.tobytes(), "expansion": expansion.tobytes()}
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            ids, lengths, owners, nth, before = ids[n:], lengths[n_docs:], owners[n_docs:], nth + 1, before + n
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], list(row))

        for some in _together(batches):
            more, sizes = encode(some.column("text"))
            ids, lengths = np.concatenate([ids, more]), np.concatenate([lengths, sizes])
            owners += some.column("doc_id").to_pylist()
            while len(ids) >= shard_ids:
                yield shard(int(np.searchsorted(np.cumsum(lengths), shard_ids)) + 1)
        if len(ids):
            yield shard(len(owners))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"), F.pmod(F.monotonically_increasing_id(), F.lit(1024)).alias("_place"))
    dealt = rows.repartitionByRange("doc_id", "_hash", "_place").sortWithinPartitions("doc_id", "_hash")
    return dealt.select("doc_id", "text").mapInArrow(run, SHARD_SCHEMA)


def _together(batches):
    """Batches cut and joined to about ``TOGETHER`` characters."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held, n_held = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            end = min(batch.num_rows, at + 1 + int(np.searchsorted(ends[at:], TOGETHER - n_held + (ends[at - 1] if at else 0))))
            held.append(batch.slice(at, end - at))
            n_held += int(ends[end - 1] - (ends[at - 1] if at else 0))
            at = end
            if n_held >= TOGETHER:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n_held = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def read_document(shards: DataFrame, doc_id: int) -> list[int]:
    """The ids of one document, by random access: shards are skipped by their ids' range, and only the symbols over the document are expanded."""
    own = shards.where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id) & F.array_contains("doc_ids", doc_id))
    row = own.orderBy("part", "nth").first().asDict()
    place = row["doc_ids"].index(doc_id)
    start = sum(row["lengths"][:place])
    return Shard(row).ids(start, start + row["lengths"][place]).tolist()


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from its shard."""
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    # A row per partition of the writing job, whatever the input.
    placed = shards.join(F.broadcast(parts), "part")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for shard in batch.to_pylist():
                at, rows, data = 0, [], memoryview(Shard(shard).ids(0, shard["n_ids"]).tobytes())
                for doc_id, n in zip(shard["doc_ids"], shard["lengths"], strict=True):
                    rows.append((doc_id, shard["part_start"] + shard["before"] + at, n, zlib.crc32(data[4 * at : 4 * (at + n)])))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_dir(spark)
    token_shards(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)).write.parquet(path)
    return read_documents(spark.read.schema(SHARD_SCHEMA).parquet(path))
