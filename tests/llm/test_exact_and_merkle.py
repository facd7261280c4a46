"""Chunk recipes and Merkle manifests: brute force, forced collisions, block borders and the defined cases."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quiltgrid.llm import op11_exact_dedup as exact
from quiltgrid.llm import op12_merkle_manifest as merkle

# 11


def texts_of(seed, n):
    rng = random.Random(seed)
    words = [f"{rng.choice('aeiouкитябж語éß')}{rng.choice('strand ')}{k}" for k in range(400)]
    whole = [" ".join(rng.choice(words) for _ in range(rng.choice((3, 40, 900)))) for _ in range(n)]
    return whole + whole[::3] + [w + " " for w in whole[::4]] + ["", None, " "]


def chunks(spark, texts, pattern=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.c for r in df.select("i", exact.chunks_of(F.col("text"), pattern or exact.chunk_pattern()).alias("c")).orderBy("i").collect()]


def test_chunks_tile_the_text_and_follow_its_content(spark):
    texts = [t for t in texts_of(1, 12) if t] + ["a" * 30_000, "\n" * 9000, "\U0001f600\u0000 " * 4000, "x" * 1024, "x" * 1023, "x" * 8193]
    for text, found in zip(texts, chunks(spark, texts), strict=True):
        assert "".join(found) == text
        assert all(exact.LEAST_CHARS <= len(c) <= exact.MOST_CHARS for c in found[:-1])
    long = " ".join(f"{random.Random(i).randint(0, 10**6):x}" for i in range(20_000))
    one, moved = chunks(spark, [long, "Something new stands before. " + long])
    assert len(set(one) & set(moved)) > 0.8 * len(one) > 30


def plain_groups(rows):
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    out = []
    for t, ids in by_text.items():
        last = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, last, len(ids), sha) for i in ids]
    return sorted(out, key=repr), len(by_text)


@pytest.mark.parametrize("weak", [False, True])
def test_groups(spark, weak):
    """With a hash of a few values nearly all chunks share theirs, and the identifiers hold the chunks."""
    texts = texts_of(2, 30)
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, texts[3]), (None, texts[5]), (None, None), (None, "alone")]
    docs = spark.createDataFrame([(t, i, 7, "r", True) for i, t in rows], "text string, doc_id long, row long, recipe string, kept boolean").repartition(3)
    few = lambda c: F.struct((F.length(c) % 3).alias("a"))
    pattern = exact.chunk_pattern(64, 512)
    found = exact.exact_groups(docs, pattern, few if weak else exact.hash128).collect()
    expected, n_groups = plain_groups(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == expected
    assert sum(r.kept for r in found) == n_groups
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_exact_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_groups(none).count() == 0
    # Bytes that aren't UTF-8 would look alike as text.
    raw = spark.createDataFrame([(1, bytearray(b"\xff")), (2, bytearray(b"\xfe")), (3, bytearray(b"\xff"))], "doc_id long, b binary").select("doc_id", F.col("b").cast("string").alias("text"))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in exact.exact_groups(raw).collect()} == {(1, 3, 2), (2, 2, 1), (3, 3, 2)}


# 12


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """(root, siblings of each node level by level) by the definition."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, at in zip(paths, own, strict=True):
            run = at // 8 * 8
            p.append((nodes[run:at], nodes[at + 1 : run + 8]))
        nodes = [sha("".join(nodes[a : a + 8])) for a in range(0, len(nodes), 8)]
        own = [at // 8 for at in own]
    return nodes[0], paths


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda la: (la is not None, (la or "").encode()))
    inside = {}
    for la in order:
        ranked = sorted(langs[la], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        inside[la] = (ranked, *tree([leaf(r) for r in ranked]))
    root, upper = tree([inside[la][1] for la in order])
    out = []
    for la, above in zip(order, upper, strict=True):
        ranked, subroot, paths = inside[la]
        for r, path in zip(ranked, paths, strict=True):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = re.sub("[A-Z]+", lambda m: m[0].lower(), r[4]) if hit and r[4] is not None else r[4]
            node, proof = leaf((*r[:4], text)), ""
            for left, right in path + above:
                node = sha("".join(left) + node + "".join(right))
                proof += "".join(left) + "".join(right)
            out.append((r[0], leaf(r), subroot, root, sha(proof), node, node == root))
    return sorted(out, key=repr)


def manifest_of(spark, rows, monkeypatch, tmp_path):
    docs = spark.createDataFrame([(t, i, s, la, n, 4, "k") for i, s, la, n, t in rows], "text string, doc_id long, source string, lang string, n_chars long, i int, k string").repartition(5)
    path = f"{tmp_path}/documents.parquet"
    docs.write.parquet(path)
    return sorted((tuple(r) for r in merkle.op12_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)


def test_manifest_of_odd_rows(spark, monkeypatch, tmp_path):
    rows = [(i, "S", "en", i, f"Text {i}") for i in range(70)] + [(100 + i, None, f"l{i:02}", None, "É ABC lower") for i in range(9)]
    rows += [(500, "a", None, 1, None), (None, "a", None, 2, "NULL id"), (None, "a", None, 3, "Null id"), (7, "S", "fr", 1, "One"), (7, "S", "fr", 2, "Two"), (8, "S", "fr", 2, "Same"), (8, "S", "fr", 2, "Same"), (9, "", "", 0, ""), (11, "x", "ü", 5, "W " * 60_000), (12, "x", "\U0001f600", 5, "q"), (13, "x", "￮", 5, "q")]
    assert manifest_of(spark, rows, monkeypatch, tmp_path) == plain_manifest(rows)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 511, 512, 513, 600])
def test_block_borders(spark, n, monkeypatch, tmp_path):
    rows = [(i * 3, "s", "en", i, f"A{i}") for i in range(n)]
    assert manifest_of(spark, rows, monkeypatch, tmp_path) == plain_manifest(rows)


def test_many_rounds(spark, monkeypatch, tmp_path):
    """Blocks of eight nodes: four rounds for 700 rows, two for 20 languages."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(i, "s", f"l{i % 19:02}" if i > 640 else "en", i, f"A{i}") for i in range(700)]
    assert manifest_of(spark, rows, monkeypatch, tmp_path) == plain_manifest(rows)


def test_no_rows(spark, monkeypatch, tmp_path):
    assert manifest_of(spark, [], monkeypatch, tmp_path) == []
