"""Runs of words against brute force, and the query's contract on whole tables."""

import hashlib
import random
import re
import zlib

import duck
import numpy as np
import pytest

from quiltgrid.llm import op13_periodic_runs as per
from quiltgrid.llm import registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(w):
    fail = [0] * (len(w) + 1)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k]
        k += w[i] == w[k]
        fail[i + 1] = k
    return len(w) - fail[len(w)]


def plain_runs(w, least=12):
    """Every stretch of equal words q apart that is long enough and has no smaller period."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and smallest_period(w[i : j + q]) == q:
                out.append((i, j + q - i, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(set(out), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def shaped(rng):
    """Few words, periodic pieces with flaws, powers of powers, and runs that overlap."""
    w = []
    while len(w) < rng.choice((0, 5, 11, 12, 30, 120)):
        root = [rng.choice("abc") for _ in range(rng.randint(1, 7))]
        piece = root * rng.randint(1, 9)
        w += piece[: rng.randint(1, len(piece))]
        if rng.random() < 0.3:
            w.append(rng.choice("abcdefgh"))
        if rng.random() < 0.1:
            w += w
    return w


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_sequences(seed):
    rng = random.Random(seed)
    for _ in range(60):
        w = shaped(rng)
        expected = plain_runs(w)
        if w:
            assert [tuple(r) for r in per.runs_of(w).tolist()] == expected
        found = per.slice_runs([[x.encode() for x in w], [], [b"z"] * 13])
        assert [tuple(r) for r in found[0].tolist()] == expected
        assert not len(found[1])
        assert found[2].tolist() == [[0, 13, 1]]


def test_tree_extensions_and_order():
    rng = random.Random(5)
    w = [rng.randint(1, 3) for _ in range(150)]
    tree = per.SuffixTree(w)
    assert tree.order == sorted(range(151), key=lambda i: [*w[i:], 0])
    i, j = np.array([(a, b) for a in range(151) for b in range(151) if a != b]).T

    def common(a, b):
        k = 0
        while max(a, b) + k < 150 and w[a + k] == w[b + k]:
            k += 1
        return k

    assert tree.lce(i, j).tolist() == [common(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True)]


def test_query_on_the_table(spark):
    found = registry.queries()["op13_periodic_runs"](spark, duck.DATA)
    docs = spark.read.parquet(f"{duck.DATA}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(tuple(r) for r in found.collect()) == sorted(plain_row(r.doc_id, r.text) for r in docs)


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(3000)) + " " + " ".join(["tick tock"] * 20_000)
    # Repeats far apart, white space that isn't ASCII, a shared run of two texts, copies of rows.
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "x y " * 12), (5, "x x\x1cx " * 11), (6, "a b c d e f g " * 2 + "h " + "a b c d e f g"), (7, long), (7, long), (None, "one two " * 9), (None, None), (8, "go " * 12), (9, "go " * 11), (10, "é \U0001f600 " * 6)]
    docs = spark.createDataFrame([(t, i, "n", 5, [(1, 2, 3)]) for i, t in rows], "text string, doc_id long, collapsed string, start long, runs array<struct<start:long,length:long,period:long>>").repartition(3)
    found = {}
    for r in per.periodic_runs(docs).collect():
        found.setdefault(r.doc_id, []).append(([tuple(x) for x in r.runs], r.collapsed))
    for i, t in rows:
        w = WORD.findall(t or "")
        runs = plain_runs(w) if len(w) < 10_000 else [(3000, 40_000, 2)]
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        assert (runs, " ".join(x for k, x in enumerate(w) if k not in gone)) in found[i]
    assert len(found[7]) == 2 and len(found[None]) == 2
    assert per.periodic_runs(docs.limit(0)).count() == 0
