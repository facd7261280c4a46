"""The corpus pipeline, stage by stage, against brute force."""

import collections

import duck
import pytest

import corpus_pipeline as cp
from quiltgrid.llm import op3_decontamination as dec
from quiltgrid.llm import op10_simhash as sim
from quiltgrid.llm.op2_mixing import mix_documents
from quiltgrid.llm.common import shared_dir


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of documents and of each stage's result."""
    docs = spark.read.parquet(f"{duck.DATA}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in cp.STAGES:
        path = shared_dir(spark)
        stage(spark, docs, duck.DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
        if name != "hilbert_sharding":
            assert docs.columns == list(cp.COLUMNS)
    return out


def test_language(stages):
    true = {r.doc_id: r.lang for r in stages["documents"]}
    kept = {r.doc_id: r.lang for r in stages["language_id"]}
    assert {i for i in true if any(c.isalpha() for c in next(r.text for r in stages["documents"] if r.doc_id == i) or "")} == set(kept)
    assert sum(true[i] == kept[i] for i in kept) / len(kept) > 0.97


def test_near_copies(stages):
    rows = {r.doc_id: r.text for r in stages["language_id"]}
    grams = {i: set(sim.shingles(t, 5)) for i, t in rows.items()}
    group = {i: i for i in rows}
    for a in sorted(rows):
        for b in sorted(rows):
            if b < a and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                x, y = group[a], group[b]
                group = {k: min(x, y) if g in (x, y) else g for k, g in group.items()}
    expected = {i for i, g in group.items() if i == g}
    kept = {r.doc_id for r in stages["simhash_near_dedup"]}
    assert kept == expected and len(expected) < len(rows)


def test_leaks(spark, stages):
    items = [dec.normalised(r.text) for r in spark.read.parquet(f"{duck.DATA}/benchmark.parquet").collect()]
    before = {r.doc_id: dec.normalised(r.text) for r in stages["simhash_near_dedup"]}
    leaking = {i for i, t in before.items() if any(x in t for x in items)}
    assert {r.doc_id for r in stages["benchmark_decontamination"]} == set(before) - leaking and leaking


def test_mix(stages):
    words = lambda t: (t or "").encode().split()
    before = {r.doc_id: r for r in stages["benchmark_decontamination"]}
    total = sum(len(words(r.text)) for r in before.values())
    taken = collections.Counter()
    for r in stages["source_mixing"]:
        own, source = words(r.text), words(before[r.doc_id].text)
        taken[r.doc_id] += len(own)
        assert own and len(own) <= len(source) and r.n_chars == len(r.text)
        assert not collections.Counter(own) - collections.Counter(source)
        assert len(own) < len(source) or r.text == before[r.doc_id].text
    assert all(n <= 2 * len(words(before[i].text)) for i, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * total) < 0.02 * total


def test_shards(stages):
    mixed = collections.Counter(r.doc_id for r in stages["source_mixing"])
    assert collections.Counter(r.doc_id for r in stages["hilbert_sharding"]) == mixed
    sizes = collections.Counter(r.shard for r in stages["hilbert_sharding"]).values()
    assert max(sizes) - min(sizes) <= 1 and len(sizes) == 16


def test_run_and_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard int"
    rows = [(1, "some words of a text in english here", "en", "a", 5, 1), (1, "some words of a text in english here", "en", "a", 5, 1), (2, None, "en", None, 0, 1), (3, "", None, "a", 0, 1), (None, "a text without any id at all", "en", "a", 3, 1), (4, "une phrase assez courte", "fr", None, 4, 1)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for _, stage in cp.STAGES:
            path = shared_dir(spark)
            stage(spark, docs, duck.DATA).write.parquet(path)
            docs = spark.read.parquet(path)
        left = {r.doc_id for r in docs.collect()}
        assert left <= {None, 1, 4} and bool(left) == bool(some)  # so few words make one block


def test_rows_of_one_id(spark):
    """Rows that repeat an id, or have none, are documents of their own: what stays depends neither on their order nor on partitions."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = [f"text number {k} " + " ".join(f"w{k}x{j}" for j in range(30)) for k in range(6)]
    rows = [(1, t, "en", "a", k) for k, t in enumerate(texts)] + [(None, texts[0], "en", "a", 9), (None, "no id " + texts[1], "fr", "a", 9), (None, "quite another one " * 8, "fr", "a", 9)]
    rows += [(2, "another text " * 9, "en", None, None), (3, "another text " * 9, None, "b", 1), (3, "another text " * 9, None, "b", 1)]
    kept = []
    for n in (1, 3, 4):
        docs = spark.createDataFrame(rows[n:] + rows[:n], schema).repartition(n)
        kept.append(sorted((repr(r.doc_id), r.text) for r in cp.without_near_copies(spark, docs, duck.DATA).collect()))
    assert kept[0] == kept[1] == kept[2] == sorted([*(("1", t) for t in texts), ("None", "quite another one " * 8), ("2", "another text " * 9)])
    three = spark.createDataFrame([(None, "one of three texts here", "en", "a", 1), (7, "second of all of them", "en", "a", 1), (7, "and what is the third", "en", "a", 1)], schema)
    assert cp.without_near_copies(spark, three, duck.DATA).count() == 3
    mixed = cp.mixed(spark, docs, duck.DATA).collect()
    of = collections.Counter()
    for r in mixed:
        of[r.doc_id, r.text.split()[0]] += len(r.text.split())
        assert any(i == r.doc_id and r.text in t for i, t, *_ in rows)
    plan = collections.Counter()
    for r in mix_documents(docs).collect():
        plan[r.doc_id] += r.taken
    assert {i: sum(n for (k, _), n in of.items() if k == i) for i in plan if plan[i]} == {i: n for i, n in plan.items() if n}


def test_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, size long, group_id long, copy int, shard int"
    docs = spark.createDataFrame([(i, f"the number {i} is one of those that we count here every day " + "and again " * i, "en", "ab"[i % 2], 1, "zz", 5, 1, 9, 9) for i in range(1, 9)], schema)
    for _, stage in cp.STAGES:
        path = shared_dir(spark)
        stage(spark, docs, duck.DATA).write.parquet(path)
        docs = spark.read.parquet(path)
    assert {r.doc_id for r in docs.collect()} <= set(range(1, 9)) and docs.count()
