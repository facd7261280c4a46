"""Rows that repeat, ids that are null, columns that clash; shards by brute force."""

import collections
import hashlib
import time
import zlib
from pathlib import Path

import duck
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quiltgrid.llm import op1_language_id as lang
from quiltgrid.llm import op2_mixing as mix
from quiltgrid.llm import op3_decontamination as dec
from quiltgrid.llm import op4_url_filter as url
from quiltgrid.llm import op6_sharding as shard
from quiltgrid.llm import op8_token_output as tok
from quiltgrid.llm import op9_line_dedup as lines
from quiltgrid.llm import op10_simhash as sim
from quiltgrid.llm.common import freed_shuffles, materialize, told_apart


def test_mix_of_repeated_ids(spark):
    """Each row's pieces come from its own text, as often as the plan takes them."""
    rows = [(7, "a", " ".join(f"{k}w{i}" for i in range(9))) for k in "xyz"] + [(7, "a", " ".join(f"xw{i}" for i in range(9)))] * 2 + [(None, "a", "n1 n2 n3"), (None, "b", "m1 m2 m3 m4"), (8, "b", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(2)
    plan = collections.Counter()
    for r in mix.mix_documents(docs, block_words=3).collect():
        plan[r.doc_id, r.source] += r.taken
    pieces = mix.mixed_blocks(docs, block_words=3).collect()
    words = collections.Counter()
    for r in pieces:
        words[r.doc_id, r.source] += len(r.text.split())
        assert len(r.text.split()) == r.n_words and any(i == r.doc_id and r.text in t for i, _, t in rows)
    assert words == +plan and sum(plan.values()) > 40


def test_rows_told_apart(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert told_apart(docs)[1] == "doc_id"
    for odd in (docs.union(docs), docs.selectExpr("nullif(doc_id, 2) doc_id", "text")):
        same, row = told_apart(odd)
        assert row == "_row" and same.select(row).distinct().count() == odd.count()


def test_leaks_of_items_without_id(spark):
    item, other = "the quick brown fox jumps over the lazy dog near the old river bank", "seven wise owls counted all of the silver coins upon the stone table"
    bench = spark.createDataFrame([(None, item), (4, other), (None, "short")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"Once {item}, and {other}!"), (2, "nothing of it is in here at all, only plain words"), (None, item)], "doc_id long, text string")
    found = sorted(((r.doc_id, r.item_id) for r in dec.find_leaks(docs, bench).collect()), key=repr)
    assert found == sorted([(1, None), (1, 4), (None, None)], key=repr)
    assert [r.doc_id for r in dec.drop_leaks(docs, bench).collect()] == [2]


def test_a_benchmark_of_many_blocks(spark):
    """Blocks are scanned one after the other: one Python operator a job, and the same leaks."""
    items = [(i, " ".join(hashlib.md5(f"{i}-{k}".encode()).hexdigest()[:5] for k in range(20))) for i in range(24)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(k, f"before it {items[k % 30][1]} and after" if k % 30 < 24 and k % 2 else f"only plain words number {k} " * 5) for k in range(60)], "doc_id long, text string")
    one = sorted(map(tuple, dec.find_leaks(docs, bench).collect()))
    many = sorted(map(tuple, dec.find_leaks(docs, bench, block_chars=200).collect()))
    assert one == many and len(one) == 24
    left = dec.drop_leaks(docs, bench, block_chars=200)
    assert left._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 0
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in dec.drop_leaks(docs, bench).collect()} == {k for k in range(60) if not (k % 30 < 24 and k % 2)}


def test_line_dedup_with_columns_of_any_name(spark):
    text = "one\ntwo\nthree\nfour"
    docs = spark.createDataFrame([(1, text, 77, "h", 5, 1.5, 9), (2, text, 78, "i", 6, 2.5, 8)], "doc_id long, text string, _n int, _hash string, _id int, `a.b` double, n_lines int")
    rows = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert rows[1].asDict() == {"doc_id": 1, "text": text, "_n": 77, "_hash": "h", "_id": 5, "a.b": 1.5, "_own_n_lines": 9, "n_lines": 4, "n_removed": 0}
    assert (rows[2]["_n"], rows[2]["_hash"], rows[2].text, rows[2].n_removed, rows[2]["_own_n_lines"]) == (78, "i", "", 4, 8)
    clash = docs.withColumnsRenamed({"_n": "row", "_hash": "removed", "_id": "doc_hash"})
    assert {r.doc_id: (r.row, r.removed, r.doc_hash) for r in lines.dedup_lines(clash).collect()} == {1: (77, "h", 5), 2: (78, "i", 6)}


def test_pages_that_repeat_count_once(spark):
    pages = [(1, "http://a.example.com/x"), (2, "http://b.example.com/y"), (3, "http://c.example.org/" + "z" * 100_000), (None, "http://a.example.com/")]
    outcomes = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 0), (9, 1)], "page_id long, good int")
    once = spark.createDataFrame(pages, "page_id long, url string")
    kept = lambda p, o: {(r.page_id, r.host): (r.labelled, r.good_rate, r.bound, r.verdict) for r in url.filter_urls(p, o).collect()}
    assert kept(once, outcomes) == kept(once.union(once), outcomes.union(outcomes))
    assert kept(once, outcomes)[1, "a.example.com"][0] == 2 and url.filter_urls(once.union(once), outcomes).count() == 8


def plain_shards(rows, n_shards=16, bits=4):
    """Levels, curve and cut of (doc_id, lang, source, text), all in one place."""
    facts = []
    for i, lang, source, text in rows:
        data = (text or "").encode()
        size = len(data) + 1
        facts.append((i, lang, source, size, zlib.crc32(data), (4 * size.bit_length() - 4) + sum(size / 2 ** (size.bit_length() - 1) >= 2 ** (q / 4) for q in (1, 2, 3))))
    levels = []
    for d in (1, 2, 5):
        values = sorted((f[d] for f in facts), key=lambda v: (v is None, v if v is not None else 0))
        first = {}
        for at, v in enumerate(values):
            first.setdefault(v, at * (1 << bits) // len(values))
        levels.append(first)
    code = lambda f: shard.hilbert_index(tuple(levels[k][f[d]] for k, d in enumerate((1, 2, 5))), bits)
    order = sorted(((code(f), hashlib.md5(f"{'' if f[0] is None else f[0]}:{f[4]}".encode()).hexdigest(), f) for f in facts), key=lambda x: x[:2])
    out, n = [], len(order)
    for at, (hilbert, _, f) in enumerate(order):
        k = at * n_shards // n
        out.append((f[0], f[3], f[4], hilbert, k, at - -(-k * n // n_shards)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("odd", [False, True])
def test_shards_by_brute_force(spark, odd):
    if odd:
        rows = [(i % 40 if i % 7 else None, None if i % 11 == 0 else f"l{i % 5}", None if i % 3 == 0 else "hot", None if i % 13 == 0 else f"text {i % 60} " * (i % 9) + ("long " * 30_000 if i == 50 else "")) for i in range(150)]
    else:
        rows = [(r.doc_id, r.lang, r.source, r.text) for r in spark.read.parquet(f"{duck.DATA}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    found = shard.shard_documents(docs).select("doc_id", "size", "text_crc32", "hilbert", "shard", "slot").collect()
    assert sorted(map(tuple, found), key=repr) == plain_shards(rows)


def test_written_shards_keep_own_columns(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t {i}", "en", "s", i, i + 5, "p") for i in range(40)], "doc_id long, text string, lang string, source string, _row long, shard long, _place string")
    shard.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r["_row"], r["_own_shard"], r["_place"]) for r in back.collect()) == [(i, i, i + 5, "p") for i in range(40)]


def test_texts_go_to_python_in_small_batches(spark):
    """A worker holds a slice of a small batch, however many rows a partition has; a session's smaller batches stay."""
    key, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", 2500
    docs = spark.range(rows).selectExpr("id as doc_id", "concat('a few words of text ', id) as text", "if(id % 2 = 0, 'en', 'de') as lang").repartition(1)
    bench = spark.createDataFrame([(1, "something else that is in no text")], "item_id long, text string")
    sizes = lambda batches: (b.select(["doc_id"]).slice(0, 1).set_column(0, "doc_id", pa.array([b.num_rows], pa.int64())) for b in batches)
    steps = [lambda: lang.identify(docs, None), lambda: dec.drop_leaks(docs, bench), lambda: dec.find_leaks(docs, bench), lambda: sim.fingerprints(docs), lambda: sim.text_sketches(docs)]
    before = spark.conf.get(key)
    try:
        for step in steps:
            spark.conf.set(key, before)
            step()
            got = [r.doc_id for r in docs.select("doc_id").mapInArrow(sizes, "doc_id long").collect()]
            assert sum(got) == rows and max(got) <= 1000
        spark.conf.set(key, 10)
        assert dec.drop_leaks(docs, bench).count() == rows and spark.conf.get(key) == "10"
    finally:
        spark.conf.set(key, before)
    texts = pa.array([f"{i} " * 5000 for i in range(100)])
    assert max(sum(map(len, some)) for _, some in dec._slices(texts)) < 300_000


def test_new_pieces_are_joined_without_a_string_each(monkeypatch):
    """Making a Python string of each new piece takes time and memory."""
    import tracemalloc

    import public_tokenizers

    encode, texts = tok.Encoder(public_tokenizers.path(tok.TOKENIZER)), []
    encode.open()
    pieces = pa.array([f"word{i}" for i in range(100_050)], pa.large_string())
    monkeypatch.setattr(encode, "_encode", lambda some: (texts.extend(some), (tok.np.zeros(1, "<u4"), None))[1])
    tracemalloc.start()
    try:
        encode._learn(pieces)
        assert tracemalloc.get_traced_memory()[1] < 8_000_000
    finally:
        tracemalloc.stop()
    assert "".join(texts) == "".join(f" word{i}" for i in range(100_050))
    assert tok.frequent_pairs(tok.np.array([5] * 3 + [7] * 2 + [9] * 4, tok.np.uint32), 3, 10).tolist() == [9, 5]
    assert tok.frequent_pairs(tok.np.array([5, 6, 7], tok.np.uint32), 3, 10).tolist() == []


def _counted_again_each_round(ids, first_rule):
    """The rules and symbols of pairs counted one by one, at all places in every round."""
    seq, rules = ids.tolist(), []
    while True:
        count, places, i = collections.Counter(), collections.defaultdict(list), 0
        while i + 1 < len(seq):
            pair, n = (seq[i], seq[i + 1]), 1
            if pair[0] == pair[1]:
                while i + n < len(seq) and seq[i + n] == seq[i]:
                    n += 1
                for k in range(i, i + n - 1, 2):
                    count[pair] += 1
                    places[pair].append(k)
                i += n - 1
            else:
                count[pair] += 1
                places[pair].append(i)
                i += 1
        lefts, rights, chosen = set(), set(), []
        for n, (a, b) in sorted((-n, p) for p, n in count.items() if n >= tok.LEAST_COUNT)[: tok.PAIRS]:
            if a not in rights and b not in lefts and (a != b or a not in lefts and a not in rights):
                lefts.add(a)
                rights.add(b)
                chosen.append((a, b))
        if not chosen:
            return rules, seq
        for p in sorted(chosen):
            for k in places[p]:
                seq[k], seq[k + 1] = first_rule + len(rules), None
            rules.append(p)
        seq = [x for x in seq if x is not None]


@pytest.mark.parametrize("first_rule", [100, 65530, 70000])
def test_grammar_is_that_of_all_pairs_counted_in_every_round(first_rule, monkeypatch):
    """Places of rare pairs are left out of later rounds, and no pair is lost by it."""
    rng, counted, plain = tok.np.random.default_rng(3), [], tok._often
    monkeypatch.setattr(tok, "_often", lambda own, least: (counted.append(len(own)), plain(own, least))[1])
    monkeypatch.setattr(tok, "PAIRS", 5)
    for ids in (rng.zipf(1.3, 4000) % 60, rng.integers(0, 3, 3000), tok.np.repeat(rng.integers(0, 4, 900), rng.integers(1, 9, 900)), tok.np.zeros(777, int), tok.np.arange(80)):
        counted.clear()
        rules, symbols, _ = tok.compress(ids.astype("<u4"), first_rule)
        assert ([tuple(r) for r in rules.tolist()], symbols.tolist()) == _counted_again_each_round(ids, first_rule)
        assert counted[-1] < len(symbols) / 2 or len(symbols) < 100

def _encoder_and_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tok.TOKENIZER)
    encode, library = tok.Encoder(path), Tokenizer.from_file(path)
    encode.open()

    def check(group):
        ids, sizes = encode(pa.array(group, pa.string()))
        own = [x.tolist() for x in tok.np.split(ids, tok.np.cumsum(sizes))[: len(group)]]
        assert own == [[*library.encode(x, add_special_tokens=False).ids, 2] for x in group]

    return encode, check


def test_words_are_encoded_once_whatever_marks_follow(monkeypatch):
    encode, check = _encoder_and_library()
    texts, plain = [], encode._encode
    monkeypatch.setattr(encode, "_encode", lambda some: (texts.extend(some), plain(some))[1])
    check(["so wendelor brindéé, wendelor, brindéé.\nSo wendelor; brindéé wendelor", "so brindéé! wendelor-brindéé"])
    check(["so brindéé: wendelor. wendelor,"])
    assert "".join(texts).count(" wendelor") == "".join(texts).count(" brindéé") == 1
    check(["long " + "x" * 500 + " y"])
    assert max(map(len, encode.pieces.strings.to_pylist())) <= tok.LONGEST  # long ones are not remembered
    marks = ["a.b c", "a's 's b's", "é, è. ×. ÷, ñ! 日, 日本.\n日", "e\u0301, e\u0301. b", "a\n\nb c.\n\n\nd e\n", "f\n\n", "g\n", "²,º.\u00aa;_a_ __a 1. a1, 1a,", "\u200b, a\ufeff. b", "\x00. a\x00, b"]
    for group in (marks, marks[::-1], ["".join(marks)]):
        check(group)


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    """What the table of hashes finds is compared as a string."""
    monkeypatch.setattr(tok.Places, "_hashes", staticmethod(lambda some: tok.np.zeros(len(some), tok.np.uint64)))
    encode, check = _encoder_and_library()
    for group in (["one two three"], ["three two one four", "two"], ["five one, two"]):
        check(group)
    assert encode.pieces.find(pa.array(["one", " nowhere"], pa.large_string())).tolist() == [0, -1]


def test_near_duplicates_leave_few_shuffle_files(spark):
    """Shuffle files of all rounds together would take several times the texts' disk."""
    top, key = Path(spark.sparkContext.getConf().get("spark.local.dir")), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    files = lambda: {p: p.stat().st_size for p in top.rglob("shuffle_*.data") if p.exists()}
    before, was = set(files()), spark.conf.get(key)
    left = lambda: sum(n for p, n in files().items() if p not in before)

    def soon(most):
        """Files are removed a moment after their query."""
        for _ in range(20):
            if left() <= most:
                return True
            time.sleep(0.5)
        return False

    counts = materialize(spark.range(10000).groupBy(F.col("id") % 7000).count())
    assert soon(0) and counts.count() == 7000 and spark.conf.get(key) == was
    before = set(files())
    docs = spark.read.parquet(f"{duck.DATA}/documents.parquet").where("doc_id < 2000")
    groups = sim.near_duplicates(docs)
    assert soon(docs.agg(F.sum(F.octet_length("text"))).first()[0] // 10)
    assert groups.count() == docs.count() and spark.conf.get(key) == was
    with pytest.raises(ZeroDivisionError), freed_shuffles(spark):
        assert spark.conf.get(key) == "true" and 1 / 0
    assert spark.conf.get(key) == was
