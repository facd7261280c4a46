"""Language ID by prediction by partial matching (PPM).

Training counts, per language, how often each byte follows each context of up to
``ORDER`` bytes in lower-cased text, over whole labelled documents. Statistics are
then frozen: a byte costs -log2 of its probability in the longest context that the
language's tree holds, or an escape (method C) and its cost in the next shorter
one, down to one in 256. A text's code length is the exact sum over its bytes; the
language with the shortest code is predicted.

Scale: training takes about ``TRAIN_DOCS`` different documents a language (expected;
those whose texts have the least hashes), however large the input is and however
often an id or a text is repeated. Of the trees only what was counted is kept, about
12 bytes for each context of a language and as much for each symbol in it: whatever
the alphabet and the number of languages, no more than 24 * (ORDER + 1) bytes for each
byte that was learned from. The trees alone are broadcast. Every document is scored
whole, where it lies: scoring moves no rows. Each of a slice's different contexts is
looked up once.

Defined cases: null texts and texts without a letter (Unicode category L) are ``und``,
score 0; the score is the posterior probability of the language, all being equally
likely before; ties go to the first language by code point; without any labelled
document all is ``und``; a null id is not held out; repeated rows are scored each, and
learned from once; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgrid.llm.common import in_small_batches, table

ORDER = 3
#: Different labelled texts that a language is learned from, as expected.
TRAIN_DOCS = 1500
#: Text bytes that are scored at once.
SLICE = 1 << 19
PAD = b"\n" * ORDER
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of lower-cased texts with padding before each; starts and ends of the texts."""
    parts = [t.lower().encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(x for p in parts for x in (PAD, p)), np.uint8)
    ends = np.cumsum(sizes + ORDER)
    return data, ends - sizes, ends


def count_grams(sample: DataFrame) -> DataFrame:
    """(lang, gram, n): counts of ORDER + 1 bytes, packed in a number, in texts of ``sample``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                data, starts, ends = _packed(texts)
                x = data.astype(np.int64)
                gram = np.zeros(max(0, len(x) - ORDER), np.int64)
                for k in range(ORDER + 1):
                    gram = gram << 8 | x[k : len(x) - ORDER + k]
                own = np.zeros(len(x) + 1, np.int64)  # positions that padding doesn't hold
                np.add.at(own, starts, 1)
                np.add.at(own, ends, -1)
                gram, n = np.unique(gram[np.cumsum(own)[ORDER : len(x)] > 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])

    return in_small_batches(sample).select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def training_sample(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(lang, text): about ``train_docs`` different labelled texts of each language, by the texts' hashes."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    labelled = labelled.select("lang", "text", F.xxhash64("text").alias("_hash"))
    different = labelled.groupBy("lang", "_hash").agg(F.lit(1).alias("one"))
    share = different.groupBy("lang").agg((F.lit(float(train_docs)) / F.count("*")).alias("share"))
    place = F.col("_hash") / F.lit(float(1 << 64)) + 0.5
    # One row per language, so that the small side is the one that is moved.
    return labelled.join(F.broadcast(share), "lang").where(place < F.col("share")).dropDuplicates(["lang", "_hash"]).select("lang", "text")


class Trees:
    """Each language's context tree, as sorted arrays for each order from 0 to ``ORDER``.

    A key is a language's number with up to ``ORDER`` + 1 bytes: a context and a
    symbol, with its cost in bits, or a context alone, with the cost of its escape.
    """

    def __init__(self, langs: np.ndarray, grams: np.ndarray, counts: np.ndarray, n_langs: int):
        self.n_langs, self.symbols, self.contexts = n_langs, [], []
        for order in range(ORDER + 1):
            key, at = np.unique(langs.astype(np.int64) << 32 | grams & (1 << 8 * (order + 1)) - 1, return_inverse=True)
            n = np.bincount(at, counts, len(key))
            context, at = np.unique((key >> 32) << 32 | (key & 0xFFFFFFFF) >> 8, return_inverse=True)
            size, kinds = np.bincount(at, n, len(context)), np.bincount(at, minlength=len(context))
            self.symbols.append((key, (np.log2(size + kinds)[at] - np.log2(n)).astype(np.float32)))
            self.contexts.append((context, (np.log2(size + kinds) - np.log2(kinds)).astype(np.float32)))

    @staticmethod
    def _found(table: tuple[np.ndarray, np.ndarray], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, values = table
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return keys[at] == key, values[at]

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each of ``grams`` after the others, in each language."""
        out = np.empty((len(grams), self.n_langs), np.float32)
        for lang in range(self.n_langs):
            bits, open_ = np.zeros(len(grams), np.float32), np.arange(len(grams))
            for order in range(ORDER, -1, -1):  # what an order doesn't hold goes on to the shorter one
                base = np.int64(lang) << 32
                own = grams[open_] & (1 << 8 * (order + 1)) - 1
                seen, cost = self._found(self.symbols[order], base | own)
                bits[open_[seen]] += cost[seen]
                open_, own = open_[~seen], own[~seen]
                seen, cost = self._found(self.contexts[order], base | own >> 8)
                bits[open_] += np.where(seen, cost, 0)
            bits[open_] += 8
            out[:, lang] = bits
        return out


def code_lengths(texts: list[str], model: Trees) -> np.ndarray:
    """Bits of each text in each language; texts are not empty."""
    import pandas as pd

    data, starts, ends = _packed(texts)
    x = data.astype(np.uint32)
    gram = np.zeros(len(x) - ORDER, np.uint32)
    for k in range(ORDER + 1):
        gram = gram << np.uint32(8) | x[k : len(x) - ORDER + k]
    which, different = pd.factorize(gram)
    bits = np.vstack([model.costs(different.astype(np.int64))[which], np.zeros((1, model.n_langs), np.float32)])  # so that the last end is a place
    edges = np.stack([starts - ORDER, ends - ORDER], 1).ravel()
    return np.add.reduceat(bits, edges, axis=0, dtype=np.float64)[::2]


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[str], Trees] | None:
    """The languages and their trees; the rows collected are bounded by the sample."""
    found = count_grams(training_sample(docs, train_docs)).toPandas()
    if not len(found):
        return None
    names = sorted(found["lang"].unique())
    number = {n: i for i, n in enumerate(names)}
    return names, Trees(found["lang"].map(number).to_numpy(), found["gram"].to_numpy(), found["n"].to_numpy(), len(names))


def identify(docs: DataFrame, model: tuple[list[str], Trees] | None) -> DataFrame:
    """``docs`` with lang_pred and score, from their text alone; columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        names, trees = shared.value or ([], None)

        def scored(texts: list[str]):
            bits = code_lengths(texts, trees)
            best = bits.argmin(1)
            odds = np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
            return [names[i] for i in best], 1 / odds

        for batch in batches:
            texts = batch.column("text").to_pylist()
            pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            able = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if names else []
            at = 0
            while at < len(able):
                end, size = at, 0
                while end < len(able) and (size < SLICE or end == at):
                    size += len(texts[able[end]])
                    end += 1
                for i, p, s in zip(able[at:end], *scored([texts[i] for i in able[at:end]]), strict=True):
                    pred[i], score[i] = p, s
                at = end
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score)], [*batch.schema.names, "lang_pred", "score"])

    from pyspark.sql import types as T

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return in_small_batches(docs).mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
