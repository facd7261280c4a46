"""The training-data operators: brute force, round trips, held-out accuracy, and the defined edge cases."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import duck
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quiltgrid.llm import common
from quiltgrid.llm import op1_language_id as lid
from quiltgrid.llm import op2_mixing as mix
from quiltgrid.llm import op3_decontamination as dec
from quiltgrid.llm import op4_url_filter as url
from quiltgrid.llm import op5_quality_rules as qual
from quiltgrid.llm import op6_sharding as shard
from quiltgrid.llm import op7_warc as warc
from quiltgrid.llm import op8_token_output as tok
from quiltgrid.llm import op9_line_dedup as lines
from quiltgrid.llm import op10_simhash as sim
from quiltgrid.llm import registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns that operators make themselves come with the input too.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, fp long, lang_pred string, n_lines long, taken long, kept boolean, digest binary, value string, path int, removed int, before long"
LONG = " ".join(f"word{i % 977} stone{i % 31}" for i in range(15000))


def docs_of(spark, rows):
    """rows: (doc_id, text, lang, source); the clashing columns are filled with nonsense."""
    full = [(i, t, la, s, 1, 99, 99, 99, "zz", 99, 99, True, b"x", "v", 9, 9, 9) for i, t, la, s in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [
        (1, "the cat sat on the mat\nand the dog\nran away to the hills", "en", "a"), (2, "the cat sat on the mat\nand the dog\nran away to the hills", "en", "b"), (3, None, "en", "a"), (4, "", None, None), (5, " \n\t ", "fr", "a"),
        (6, "12345 !!", None, "b"), (7, LONG, "en", "a"), (8, LONG + " end", "en", "a"), (9, "é", "fr", None), (9, "é", "fr", None), (None, "no id here at all", "en", "a"), (11, "a\x00b\x1c c　d  e <|endoftext|>", "en", "b"),
    ]
    return docs_of(spark, rows).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return docs_of(spark, [])


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, name):
    duck.check(registry.queries()[name](spark, duck.DATA), registry.oracle_sql()[name])


def real(spark, name="documents"):
    return spark.read.parquet(f"{duck.DATA}/{name}.parquet")


# 1


def test_language_accuracy_and_edges(spark, odd_docs, no_docs):
    rows = registry.queries()["op1_language_id"](spark, duck.DATA).collect()
    true = {r.doc_id: r.lang for r in real(spark).collect()}
    assert len(rows) == len(true)
    held = [r.lang_pred == true[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    model = lid.learn(odd_docs)
    found = collections.defaultdict(list)
    for r in lid.identify(odd_docs, model).collect():
        found[r.doc_id].append((r.lang_pred, r.score))
    assert sum(map(len, found.values())) == odd_docs.count()
    assert {i for i, v in found.items() if v[0][0] == "und"} == {3, 4, 5, 6}
    marks = docs_of(spark, [(1, "² ½ ① Ⅷ 12", None, None), (2, "ª", None, None), (3, "日", None, None)])  # only the last two have a letter
    assert [r.lang_pred == "und" for r in lid.identify(marks, model).orderBy("doc_id").collect()] == [True, False, False]
    assert lid.learn(no_docs) is None
    assert {r.lang_pred for r in lid.identify(odd_docs, None).collect()} == {"und"}
    assert lid.identify(no_docs, model).count() == 0


def test_code_lengths_by_hand():
    texts = {"x": ["abracadabra", "abc"], "y": ["banana band"]}
    names = sorted(texts)
    tree = {n: [collections.defaultdict(collections.Counter) for _ in range(4)] for n in names}
    grams = collections.Counter()
    for n, some in texts.items():
        for t in some:
            b = lid.PAD + t.encode()
            for i in range(3, len(b)):
                grams[n, int.from_bytes(b[i - 3 : i + 1], "big")] += 1
                for o in range(4):
                    tree[n][o][b[i - o : i]][b[i]] += 1

    def cost(n, b, i):
        bits = 0.0
        for o in (3, 2, 1, 0):
            seen = tree[n][o].get(b[i - o : i])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if b[i] in seen:
                return bits + math.log2((total + kinds) / seen[b[i]])
            bits += math.log2((total + kinds) / kinds)
        return bits + 8

    model = lid.Trees(np.array([names.index(n) for n, _ in grams]), np.array([g for _, g in grams]), np.array(list(grams.values())), 2)
    for text in ("abra", "banana", "zebra", "é\x00"):
        b = lid.PAD + text.encode()
        expected = [sum(cost(n, b, i) for i in range(3, len(b))) for n in names]
        assert lid.code_lengths([text], model)[0] == pytest.approx(expected, rel=1e-5)


def test_language_sample_is_bounded(spark):
    """Repeated ids, null ids and repeated texts count once; slices don't matter; ties go to the first."""
    rows = [(i, f"text number {k} of many", la, "a") for k in range(400) for i, la in ((None, "en"), (1, "fr"))]  # 1 isn't held out
    rows += [(None, "the same text again", "de", "a")] * 500
    docs = docs_of(spark, rows)
    found = collections.Counter(r.lang for r in lid.training_sample(docs, 50).collect())
    assert 20 < found["en"] < 90 and 20 < found["fr"] < 90 and found["de"] == 1
    model = lid.Trees(np.array([0, 1]), np.array([97, 97]), np.array([3, 3]), 2)
    texts = ["a" * 50, "ab" * 700, "zz"]
    bits = lid.code_lengths(texts, model)
    assert (bits[:, 0] == bits[:, 1]).all() and (bits.argmin(1) == 0).all()
    assert np.allclose(np.concatenate([lid.code_lengths([t], model) for t in texts]), bits)


def test_trees_stay_small():
    """All byte values, a hundred languages: what was counted is kept, at every order."""
    rng = np.random.default_rng(0)
    n = 200_000
    langs, grams = rng.integers(0, 100, n), rng.integers(0, 1 << 32, n)
    model = lid.Trees(langs, grams, np.ones(n, np.int64), 100)
    assert sum(a.nbytes for t in (*model.symbols, *model.contexts) for a in t) <= 24 * 4 * n
    seen = model.costs(grams[:50])[np.arange(50), langs[:50]]
    assert np.allclose(seen, 1)  # a context with one symbol, seen once


# 2


def test_mix_targets_and_quotas():
    assert mix.targets([100, 100, 100], [5, 2, 1]) == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert mix.targets([0, 10], [5, 2]) == [0.0, 15.0]
    seats = mix.sainte_lague([53.0, 24.0, 23.0], 7, [99, 99, 99])
    taken = [0, 0, 0]  # one by one
    for _ in range(7):
        i = max(range(3), key=lambda j: ([53.0, 24.0, 23.0][j] / (2 * taken[j] + 1), -j))
        taken[i] += 1
    assert seats == taken
    assert mix.sainte_lague([1.0, 1.0], 10, [2, 3]) == [2, 3]


def test_mix_properties(spark, odd_docs, no_docs):
    rows = mix.mix_documents(real(spark)).collect()
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 2 * mix.BLOCK_WORDS for s in size)
    pieces = mix.mixed_blocks(real(spark)).groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()
    assert {r.doc_id: r.n for r in pieces} == {r.doc_id: r.taken for r in rows if r.taken}
    odd = mix.mix_documents(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    assert {r.doc_id for r in odd if r.size == 0} == {3, 4, 5}
    assert mix.mix_documents(no_docs).count() == 0
    assert sorted(mix.mix_documents(odd_docs).collect(), key=str) == sorted(odd, key=str)


@pytest.mark.parametrize("bucket", [7, 100_000])
def test_repeated_ids_have_lasting_places(spark, monkeypatch, bucket):
    """One id for many texts, none at all, and many equal rows: reruns agree, however the input is dealt out."""
    monkeypatch.setattr(common, "ROWS_PER_BUCKET", bucket)
    rows = [(i, "word " * (k % 40), "en", "a") for k in range(300) for i in (5, None)] + [(9, "one and the same row " * 9, "en", "b")] * 400
    found, places = [], []
    for n in (1, 2, 7):
        docs = docs_of(spark, rows).repartition(n, F.rand(n))
        found.append(sorted(mix.mix_documents(docs).collect(), key=str))
        placed = shard.shard_documents(docs).collect()
        places.append(sorted([(r.doc_id, r.size, r.shard, r.slot) for r in placed], key=str))
        assert len({(r.shard, r.slot) for r in placed}) == len(rows)
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    assert places[0] == places[1] == places[2]
    assert max(collections.Counter(p[2] for p in places[0]).values()) <= -(-len(rows) // 16)


def test_written_shards_lose_nothing(spark, odd_docs):
    rows = [(None, "no id", "en", "a"), (1, "first", "en", "a"), (1, "second", "fr", "b"), (1, "second", "fr", "b"), (2, None, None, None)]
    for docs in (docs_of(spark, rows).drop("shard"), odd_docs.drop("shard")):
        path = common.shared_dir(spark)
        shard.write_shards(docs, path, 3)
        back = spark.read.parquet(path)
        key = lambda df: sorted(((r.doc_id, r.text, r.lang, r.source) for r in df.collect()), key=str)
        assert key(back) == key(docs)


def test_shards_prune_on_every_dimension(spark):
    """Of 16 shards, a value of a dimension lies in fewer than dealing out at random would reach."""
    placed = shard.shard_documents(real(spark)).select("lang", "source", "size_class", "shard").collect()
    for dim in ("lang", "source", "size_class"):
        by_value = collections.defaultdict(list)
        for r in placed:
            by_value[r[dim]].append(r.shard)
        spread = sum(len(set(x)) for x in by_value.values())
        rng = random.Random(1)
        assert spread <= 0.8 * sum(len({rng.randrange(16) for _ in x}) for x in by_value.values())


def test_mixed_text_is_the_taken_words(spark):
    docs = docs_of(spark, [(i, " ".join(f"d{i}w{j}" for j in range(40 * i)), "en", "ab"[i % 2]) for i in range(1, 8)])
    for r in mix.mixed_blocks(docs, 16).collect():
        assert r.text.split() == [f"d{r.doc_id}w{j}" for j in range(r.first_word, r.first_word + r.n_words)]


# 3


def edit_distance_within(piece, text):
    """Least edits of ``piece`` against any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(piece, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_leaks_against_brute_force():
    rng = random.Random(5)
    words = ["stone", "river", "cloud", "an", "of", "the", "green", "seven", "lamp", "paper"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(rng.randrange(12, 40))) for i in range(6)]
    index = dec.Index(items)
    texts = []
    for i in range(40):
        text = say(rng.randrange(0, 60))
        if i % 2:
            part = list(rng.choice(items)[1])
            for _ in range(rng.randrange(0, 9)):
                at = rng.randrange(len(part))
                part[at] = rng.choice(["x", "", part[at] + "q"])
            text = f"{text} {''.join(part)} {say(5)}"
        texts.append(dec.normalised(text))
    found = {(t, item) for t, item, _, _ in index.leaks(texts)}
    expected = set()
    for t, text in enumerate(texts):
        for p, owner in enumerate(index.owners):
            piece = [chr(c) for c in index.codes[p][: index.length[p]]]
            if edit_distance_within(piece, text) <= index.edits[p]:
                expected.add((t, owner))
    assert found == expected and expected


def test_leaks_whatever_the_neighbours(spark):
    """Neighbouring halves of a passage are no leak, cut ends are; order and batches change nothing."""
    rng = random.Random(8)
    say = lambda n: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passages = [say(14)[:80].strip() for _ in range(6)]
    index = dec.Index(list(enumerate(passages)))
    texts = []
    for p in passages:
        texts += [f"{say(4)} {p[:40]}", f"{p[40:]} {say(4)}", f"{say(4)} {p[:-4]}", f"{p[-4:]} {say(4)}", p[3:], p, ""]
    texts = [dec.normalised(t) for t in texts]
    alone = {t: index.leaks([t]) for t in texts}
    expected = {(t, i) for t in texts for i, p in enumerate(passages) if edit_distance_within(p, t) <= index.edits[i]}
    assert {(t, r[1]) for t, rows in alone.items() for r in rows} == expected and len(expected) >= 12
    for _ in range(20):
        rng.shuffle(texts)
        for size in (2, 7, len(texts)):
            for at in range(0, len(texts), size):
                some = texts[at : at + size]
                assert index.leaks(some) == [(k, *r[1:]) for k, t in enumerate(some) for r in alone[t]]


def test_leaks_in_runs_of_common_grams(monkeypatch):
    """Texts of one repeated passage are counted in overlapping runs, with the same result."""
    rng = random.Random(9)
    items = [(i, f"the same old words again and again and once more number {i % 3} " * 2) for i in range(40)]
    index = dec.Index(items)
    texts = [dec.normalised(" ".join(rng.choice(items)[1] if rng.random() < 0.5 else "other words stand between these" for _ in range(60))) for _ in range(5)]
    whole = index.leaks(texts)
    monkeypatch.setattr(dec, "MOST_SHARED", 1000)
    assert whole == index.leaks(texts) and whole


def test_leaks_edges(spark, odd_docs, no_docs):
    item = "a long benchmark passage that nobody would write twice by chance, would they?"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short"), (5, item.upper())], "item_id long, text string")
    docs = docs_of(spark, [(1, f"x {item} y", "en", "a"), (2, item.replace("nobody", "nobudy"), "en", "a"), (3, None, "en", "a"), (4, LONG + " " + item, "en", "a"), (5, item[:20], "en", "a"), (None, item, "en", "a"), (1, f"x {item} y", "en", "a")])
    found = collections.Counter((r.doc_id, r.item_id) for r in dec.find_leaks(docs, bench).collect())
    assert found == {(1, 1): 2, (1, 5): 2, (2, 1): 1, (2, 5): 1, (4, 1): 1, (4, 5): 1, (None, 1): 1, (None, 5): 1}
    assert collections.Counter((r.doc_id, r.item_id) for r in dec.find_leaks(docs, bench, block_chars=50).collect()) == found
    left = [dec.drop_leaks(docs, bench, n).collect() for n in (dec.BLOCK_CHARS, 50)]
    assert [sorted(r.doc_id for r in x) for x in left] == [[3, 5]] * 2 and dec.drop_leaks(docs, bench).columns == docs.columns
    assert dec.find_leaks(no_docs, bench).count() == 0 and dec.find_leaks(odd_docs, bench.limit(0)).count() == 0


# 4


def test_urls(spark):
    urls = ["HTTP://A.Example.COM/en/7x?q", "http://x.org/es/", None, "no scheme", "http://example.net/de/81#a", "http://net/de/", "http://planet/de/", "http://bad.io/x", "http://good.io/x\ny?z", "://h", "http://x.co.uk/"]
    pages = spark.createDataFrame([(i, u, "extra") for i, u in enumerate(urls)], "page_id long, url string, host string")
    many = pages.unionByName(spark.createDataFrame([(100 + i, "http://bad.io/x" if i % 2 else "http://good.io/", "e") for i in range(400)], pages.schema))
    outcomes = spark.createDataFrame([(100 + i, 0 if i % 2 else 1) for i in range(400)] + [(7, None)], "page_id long, good int")
    found = {r.page_id: r for r in url.filter_urls(many, outcomes).collect()}
    assert [(found[i].host, found[i].path) for i in range(5)] == [("a.example.com", "/en/7x"), ("x.org", "/es/"), ("", ""), ("", ""), ("example.net", "/de/81")]
    assert [found[i].rule for i in (0, 1, 2, 4, 5, 6)] == ["example.com/en/7", "org/es/", None, "example.net/de/8", "net/de/", None]
    assert [found[i].verdict for i in (0, 1, 4, 5, 7, 8)] == ["allow", "block", "block", "allow", "block", "allow"]
    assert found[8].path == "/x\ny" and (found[9].host, found[9].path) == ("h", "")
    suffix = pages.select("page_id", url.suffix_of(url.host_of(F.col("url"))).alias("s")).collect()
    assert {r.page_id: r.s for r in suffix}[10] == "co.uk"
    assert url.filter_urls(pages.limit(0), outcomes).count() == 0
    assert url.filter_urls(pages, outcomes.limit(0)).count() == len(urls)


# 5


def counts_by_hand(text):
    text = text or ""
    w = WORD.findall(text)
    windows = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    some = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in qual.SYMBOLS for c in text), len(some) - len(set(some)), len(covered)


def test_quality(spark, odd_docs, no_docs):
    docs = real(spark)
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = qual.judge_quality(docs).collect()
    for r in rows:
        assert counts_by_hand(text[r.doc_id]) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in real(spark, "labels").collect()}
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(good) / len(good) > 0.97
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0 and not r.base_failed]
    assert sum(bad) / len(bad) < 0.15
    odd = {r.doc_id: r for r in qual.judge_quality(odd_docs).collect()}
    assert not any(odd[i].kept for i in (3, 4, 5, 6)) and odd[7].n_words == 30000
    assert qual.judge_quality(no_docs).count() == 0


def label_model_by_hand(votes):
    """(share, accuracies on good and on bad rows, posterior of each row of votes), by EM over the rows themselves."""
    n = len(votes)
    share, g, b = qual.PRIOR_SHARE, [qual.PRIOR_GOOD] * len(votes[0]), [qual.PRIOR_BAD] * len(votes[0])

    def posterior(row):
        good, bad = share, 1 - share
        for v, x, y in zip(row, g, b, strict=True):
            if v == 1 and x > 1 - y or v == -1 and 1 - x < y:
                good *= {1: x, -1: 1 - x}[v]
                bad *= {1: 1 - y, -1: y}[v]
        return good / (good + bad)

    while True:
        p = [posterior(row) for row in votes]
        old = [share, *g, *b]
        share = (sum(p) + qual.WEIGHT_SHARE * n * qual.PRIOR_SHARE) / (n + qual.WEIGHT_SHARE * n)
        g, b = list(g), list(b)
        for i in range(len(g)):
            right = sum(x for x, row in zip(p, votes, strict=True) if row[i] == 1) + qual.WEIGHT_GOOD * n * qual.PRIOR_GOOD
            g[i] = right / (sum(x for x, row in zip(p, votes, strict=True) if row[i]) + qual.WEIGHT_GOOD * n)
            right = sum(1 - x for x, row in zip(p, votes, strict=True) if row[i] == -1) + qual.WEIGHT_BAD * n * qual.PRIOR_BAD
            b[i] = right / (sum(1 - x for x, row in zip(p, votes, strict=True) if row[i]) + qual.WEIGHT_BAD * n)
        if max(abs(x - y) for x, y in zip(old, [share, *g, *b], strict=True)) <= qual.TOLERANCE:
            return share, g, b, [posterior(row) for row in votes]


def test_quality_against_brute_force(spark):
    rows = qual.judge_quality(real(spark)).collect()
    votes = [tuple(r[f"vote_{rule[0]}"] for rule in qual.RULES) for r in rows]
    share, good, bad, posterior = label_model_by_hand(votes)
    for r, p in zip(rows, posterior, strict=True):
        assert r.p_good == pytest.approx(p, abs=1e-9)
        assert r.kept == (not r.base_failed and p >= qual.MIN_POSTERIOR)
    names = [f"vote_{rule[0]}" for rule in qual.RULES]
    patterns = spark.createDataFrame([(*k, n) for k, n in collections.Counter(votes).items()], ", ".join(f"{n} int" for n in names) + ", n long")
    model = qual.fit_label_model(patterns, names)
    assert model[0] == pytest.approx(share) and list(model[1].values()) == pytest.approx(good) and list(model[2].values()) == pytest.approx(bad)
    plain = sum(math.log(share * math.prod({1: x, -1: 1 - x, 0: 1}[v] for v, x in zip(row, good, strict=True)) + (1 - share) * math.prod({1: 1 - y, -1: y, 0: 1}[v] for v, y in zip(row, bad, strict=True))) for row in votes)
    assert qual.log_likelihood(patterns, *model) == pytest.approx(plain)
    start = (qual.PRIOR_SHARE, dict.fromkeys(names, qual.PRIOR_GOOD), dict.fromkeys(names, qual.PRIOR_BAD))
    assert qual.log_likelihood(patterns, *start) < qual.log_likelihood(patterns, *model)


def test_quality_of_repeated_rows(spark, odd_docs):
    twice = qual.judge_quality(odd_docs.unionByName(odd_docs)).groupBy("doc_id", "n_words", "kept").count().collect()
    assert all(r["count"] % 2 == 0 for r in twice) and sum(r["count"] for r in twice) == 2 * odd_docs.count()


def test_quality_model_finds_planted_accuracies(spark):
    rng = random.Random(1)
    names = [f"v{i}" for i in range(6)]
    votes = collections.Counter()
    for _ in range(20000):
        good = rng.random() < 0.85
        votes[tuple((1 if rng.random() < 0.995 else -1) if good else (-1 if rng.random() < 0.6 else 1) for _ in names)] += 1
    patterns = spark.createDataFrame([(*k, n) for k, n in votes.items()], ", ".join(f"{n} int" for n in names) + ", n long")
    share, on_good, on_bad = qual.fit_label_model(patterns, names)
    assert share == pytest.approx(0.85, abs=0.02)
    assert all(on_good[n] == pytest.approx(0.995, abs=0.005) and on_bad[n] == pytest.approx(0.6, abs=0.05) for n in names)


# 6


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (3, 4)])
def test_hilbert_neighbours(dims, bits):
    """Every cell once, and one step between neighbours on the curve."""
    side = 1 << bits
    cells = {}
    for code in range(side**dims):
        point = tuple(code >> (bits * i) & (side - 1) for i in range(dims))
        cells[shard.hilbert_index(point, bits)] = point
    assert sorted(cells) == list(range(side**dims))
    assert all(sum(abs(a - b) for a, b in zip(cells[i], cells[i + 1], strict=True)) == 1 for i in range(len(cells) - 1))


def test_shards(spark, odd_docs, no_docs):
    for docs in (real(spark), odd_docs):
        rows = shard.shard_documents(docs).collect()
        assert len(rows) == docs.count()
        slots = collections.defaultdict(list)
        for r in rows:
            slots[r.shard].append((r.slot, r.hilbert))
        sizes = [len(slots[k]) for k in range(16)]
        assert max(sizes) - min(sizes) <= 1
        for k in range(16):
            assert sorted(s for s, _ in slots[k]) == list(range(len(slots[k])))
        run = [h for k in range(16) for _, h in sorted(slots[k])]
        assert run == sorted(run)
    by_id = {r.doc_id: r for r in shard.shard_documents(odd_docs).collect()}
    assert by_id[3].size == 1 and by_id[3].text_crc32 == 0 and by_id[9].size == 3
    assert shard.shard_documents(no_docs).count() == 0


# 7


def test_warc_round_trip(spark):
    html = ["<a>é</a>", "same", "same", None, "", "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n", "same", "z" * 100000]
    pages = spark.createDataFrame([(i, None if i == 4 else f"http://h/{i}\r\nX: y", h, "extra") for i, h in enumerate(html)] + [(7, "http://again", "same", "e"), (None, "http://none", "q", "e")], "page_id long, url string, html string, digest string")
    from quiltgrid.llm.common import shared_dir

    path = shared_dir(spark)
    warc.write_warc(pages, path)
    captures = warc.assemble_transactions(warc.read_warc(spark, path))
    assert captures.count() == 10
    assert captures.where("request is null or answer is null or metadata is null").count() == 0
    rows = warc.resolve_revisits(captures).collect()
    found = collections.defaultdict(list)
    for r in rows:
        found[r.page_id].append(r)
    for i, h in enumerate(html):
        data = (h or "").encode()
        assert any(r.payload_bytes == len(data) and r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode() for r in found[i])
    assert {i: (found[i][0].record_type, found[i][0].refers_to) for i in range(7)} == {0: ("response", None), 1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("revisit", 3), 5: ("response", None), 6: ("revisit", 1)}
    assert sorted((r.record_type, r.refers_to) for r in found[7]) == [("response", None), ("revisit", 1)] and len(found[None]) == 1
    block = captures.where("answer.payload_bytes = 100000").first()["answer"]["block"]
    assert bytes(block).endswith(b"z" * 100000)
    nulls = shared_dir(spark)
    warc.write_warc(spark.createDataFrame([(None, "u", "p"), (2, "u", "p"), (1, "u", "p"), (None, "u", "q"), (None, "u", "q")], "page_id long, url string, html string"), nulls)
    rows = warc.resolve_revisits(warc.assemble_transactions(warc.read_warc(spark, nulls))).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in rows) == [(0, "response", 0), (0, "revisit", 0), (0, "revisit", 1), (1, "response", 0), (2, "revisit", 1)]
    empty = shared_dir(spark)
    warc.write_warc(pages.limit(0), empty)
    assert warc.read_warc(spark, empty).count() == 0


# 8


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tok.TOKENIZER)
    return path, Tokenizer.from_file(path)


def test_encoder_equals_the_library():
    path, t = tokenizer()
    plain = tok.Encoder(path)
    plain.open()
    plain.cuts = False  # as for a tokenizer of another kind
    texts = ["", " ", "a b", " a b ", "a  b", "a\tb c", "it's 's x", "a <|endoftext|> b", "a<|endoftext|>b c <|endof", "a　b c", "é è 1 2", "a\x1c b", "\na b\n c", "x" * 500 + " y", "ab é日本 c 日 b", "b", None]
    for encode in (tok.Encoder(path), plain):
        for group in [*([t] for t in texts), texts, texts[::-1], []]:
            ids, sizes = encode(pa.array(group, pa.string()))
            assert [x.tolist() for x in np.split(ids, np.cumsum(sizes))[: len(group)]] == [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in group]
            assert len(sizes) == len(group) and sizes.sum() == len(ids)


def test_encoder_with_a_full_memory(monkeypatch):
    path, t = tokenizer()
    monkeypatch.setattr(tok, "MEMORY", 5)
    encode = tok.Encoder(path)
    for text in ("a b c d", "one two three four five six", "a b six seven"):
        ids, sizes = encode(pa.array([text]))
        assert ids.tolist() == [*t.encode(text, add_special_tokens=False).ids, 2] and len(encode.pieces) <= 5


def test_repair_round_trip():
    rng = np.random.default_rng(0)
    for ids in (np.empty(0, np.uint32), np.array([5], np.uint32), np.full(5000, 7, np.uint32), rng.integers(0, 6, 20000).astype(np.uint32), np.tile(np.arange(50, dtype=np.uint32), 400)):
        rules, symbols, spans = tok.compress(ids, 100)
        shard_row = {"rules": rules.tobytes(), "symbols": symbols.tobytes(), "expansion": spans.tobytes(), "first_rule": 100}
        for a, b in ((0, len(ids)), (3, 3), (len(ids) // 3, len(ids) // 2), (max(0, len(ids) - 1), len(ids))):
            assert (tok.Shard(shard_row).ids(a, b) == ids[a:b]).all()
    assert len(symbols) < 2000


def test_repair_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(1)
    copies = np.tile(rng.integers(0, 90, 1000).astype(np.uint32), 64)
    for ids, most in ((copies, 200), (np.full(5000, 7, np.uint32), 64), (np.repeat(rng.integers(0, 3, 2000), rng.integers(1, 9, 2000)).astype(np.uint32), 9000)):
        rules, symbols, spans = tok.compress(ids, 100)
        shard_row = {"rules": rules.tobytes(), "symbols": symbols.tobytes(), "expansion": spans.tobytes(), "first_rule": 100}
        assert (tok.Shard(shard_row).ids(0, len(ids)) == ids).all() and len(symbols) <= most
        left = []
        for p in zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True):  # an overlapping equal pair isn't counted
            left.append(None if left and p[0] == p[1] and left[-1] == p else p)
        assert max(n for p, n in collections.Counter(left).items() if p) < tok.LEAST_COUNT


def test_token_shards(spark, odd_docs, no_docs):
    path, t = tokenizer()
    for docs in (real(spark), odd_docs):
        rows = tok.read_documents(tok.token_shards(docs, path, shard_ids=5000)).collect()
        texts = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=lambda x: (x[0] is not None, x[0] or 0))
        rows.sort(key=lambda r: r.start)
        at = 0
        assert len(rows) == len(texts)
        for r, (i, text) in zip(rows, texts, strict=True):
            ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
            assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
            at += len(ids)
    assert tok.read_document(tok.token_shards(odd_docs, path, shard_ids=5000), 8) == [*t.encode(LONG + " end", add_special_tokens=False).ids, 2]
    assert tok.read_documents(tok.token_shards(no_docs, path)).count() == 0


def test_token_shards_of_repeated_ids(spark):
    """Rows of one id, or of none, are spread; whatever their order was, the files are the same."""
    path, _ = tokenizer()
    docs = docs_of(spark, [(i, f"text {k % 50} of many", "en", "a") for k in range(600) for i in (None, 7)])
    runs = []
    for n in (2, 5):
        shards = tok.token_shards(docs.repartition(n), path, shard_ids=500).cache()
        assert len({r.part for r in shards.select("part").collect()}) > 1
        runs.append(sorted((r.doc_id is not None, r.start, r.n_tokens, r.ids_crc32) for r in tok.read_documents(shards).collect()))
    assert runs[0] == runs[1] and len(runs[0]) == 1200


# 9


def test_line_dedup(spark, odd_docs, no_docs):
    docs = docs_of(spark, [(1, "a\nb\nc\nd\ne", "en", "a"), (2, "x\nb\nc\nd\ny", "en", "a"), (3, "a\nb\nc\nd\ne", "en", "a"), (4, "b\nc", "en", "a"), (5, "q\nq\nq\nq", "en", "a"), (6, "\n\n\n\n", "en", "a"), (7, "\n\n\n\n", "en", "a"), (8, None, "en", "a")])
    found = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert {i: r.text for i, r in found.items()} == {1: "a\nb\nc\nd\ne", 2: "x\ny", 3: "", 4: "b\nc", 5: "q", 6: "\n\n\n\n", 7: "\n\n\n\n", 8: None}
    assert found[5].n_removed == 3 and found[2].n_lines == 5
    assert lines.dedup_lines(no_docs).count() == 0
    odd = {r.doc_id: r.n_removed for r in lines.dedup_lines(odd_docs).collect()}
    assert odd[1] == 0 and odd[2] == 3


def test_line_dedup_by_row(spark):
    """Rows of one id or of none are documents of their own; no unique line goes; equal rows get equal texts."""
    docs = docs_of(spark, [(1, "x\ny\nz", "en", "a"), (2, "x\ny\nz\nother", "en", "a"), (2, "own\nlines\nhere\nx", "en", "a"), (None, "q\nr\ns", "en", "a"), (None, "q\nr\ns\nt", "en", "a"), (3, "q\nr\ns", "en", "a"), (4, "e\nf\ng", "en", "a"), (4, "e\nf\ng", "en", "a")])
    found = sorted(((r.doc_id or 0, r.text) for r in lines.dedup_lines(docs).collect()))
    assert found[2:] == [(1, "x\ny\nz"), (2, "other"), (2, "own\nlines\nhere\nx"), (3, ""), (4, "e\nf\ng"), (4, "e\nf\ng")]
    assert sum(len(t) for _, t in found[:2]) in (6, 7) and {x for _, t in found[:2] for x in t.split("\n")} - {""} == {"q", "r", "s", "t"}  # of two nulls one is first


def test_line_dedup_of_many_lines(spark):
    one = [f"line {i}" for i in range(30_000)]
    two = [x for i in range(0, 30_000, 10) for x in (*one[i : i + 5], f"new {i}")]
    found = {r.doc_id: r for r in lines.dedup_lines(docs_of(spark, [(1, "\n".join(one), "en", "a"), (2, "\n".join(two), "en", "a")])).collect()}
    assert found[1].n_removed == 0 and found[2].text == "\n".join(f"new {i}" for i in range(0, 30_000, 10))


# 10


def fingerprints_by_hand(texts):
    import xxhash

    out = []
    for text in texts:
        w = [x.lower() if x.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
        grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        out.append(sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)))
    return out


def groups_by_hand(prints, budget):
    """Least index reachable and number of links, by all pairs."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(prints)
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))], links


def test_simhash_against_all_pairs(spark, odd_docs, no_docs):
    texts = sorted((r.doc_id, r.text) for r in real(spark).collect())
    prints = fingerprints_by_hand([t for _, t in texts])
    group, links = groups_by_hand(prints, 2)
    found = {r.doc_id: (r.fingerprint, r.component_id, r.n_links) for r in registry.queries()["op10_simhash"](spark, duck.DATA).collect()}
    assert found == {i: (f"{prints[k]:016x}", texts[group[k]][0], links[k]) for k, (i, _) in enumerate(texts)}
    odd = {r.doc_id: r for r in sim.simhash_groups(odd_docs).collect()}
    assert odd[3].fp == odd[4].fp == odd[5].fp == 0 and odd[5].component_id == 3 and odd[3].n_links == 2
    assert odd[2].component_id == 1 and odd[8].component_id == 7
    assert sim.simhash_groups(odd_docs).count() == odd_docs.count() and sim.simhash_groups(no_docs).count() == 0


@pytest.mark.parametrize("group_rows", [3, 1000])
def test_trie_join_in_dense_clusters(spark, group_rows):
    """Groups that are dealt out again give the same links."""
    rng = random.Random(2)
    prints = set()
    for _ in range(8):
        base = rng.getrandbits(63)
        for _ in range(30):
            x = base
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(63)
            prints.add(x)
    prints = sorted(prints)
    group, links = groups_by_hand(prints, 2)
    rows = spark.createDataFrame([(0, x, x, 1) for x in prints], "tab long, node long, fp long, weight long")
    found = sim.near_links(rows, 2, group_rows=group_rows)
    degree = {r.node: r.n for r in found.where("other is null").groupBy("node").agg(F.sum("links").alias("n")).collect()}
    assert [degree.get(x, 0) for x in prints] == links
    member = {r.node: r.component for r in sim.components(found.where("other is not null").selectExpr("node u", "other v")).collect()}
    assert [member.get(x, x) for x in prints] == [prints[g] for g in group]


def test_components_of_a_chain(spark):
    edges = spark.range(300).selectExpr("id u", "id + 1 v").unionByName(spark.createDataFrame([(900, 901), (901, 900), (7, 7)], "u long, v long"))
    found = {r.node: r.component for r in sim.components(edges).collect()}
    assert all(found.get(i, i) == 0 for i in range(301)) and found[901] == 900


def test_near_duplicates_by_similarity(spark):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(4000)}" for _ in range(300)] for _ in range(12)]
    rows = []
    for i, words in enumerate(base):
        rows.append((10 * i, " ".join(words)))
        for k in range(1, 5):
            copy = list(words)
            for at in rng.sample(range(300), 3 * k):  # k = 1, 2 stay near; 4 is well below
                copy[at] = "changed"
            rows.append((10 * i + k, " ".join(copy)))
        rows.append((10 * i + 5, " \n".join(words).upper()))  # the same words
    grams = {i: set(sim.shingles(t, 5)) for i, t in rows}
    near = lambda a, b: len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])
    ids = [i for i, _ in rows]
    group = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if b < a and near(a, b):
                x, y = group[a], group[b]
                group = {k: min(x, y) if g in (x, y) else g for k, g in group.items()}
    found = {r.doc_id: r.group_id for r in sim.near_duplicates(docs_of(spark, [(i, t, "en", "a") for i, t in rows])).collect()}
    assert found == group


def test_near_duplicates_edges(spark, odd_docs, no_docs):
    found = {r.doc_id: r.group_id for r in sim.near_duplicates(odd_docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 6, 7: 7, 8: 7, 9: 9, 11: 11}
    assert sim.near_duplicates(no_docs).count() == 0


def test_near_duplicates_wherever_edits_lie(spark):
    """Passages appended, cut off or replaced as a block; groups equal those of all pairs."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(4000)}"
    rows = []
    for i in range(12):
        words = [word() for _ in range(300)]
        copies = [words, [*words, *(word() for _ in range(36 + 3 * i))], words[: 290 - 5 * i], words[40 + i :]]
        at, n = rng.randrange(200), 10 + 2 * i
        copies.append(words[:at] + [word() for _ in range(n)] + words[at + n :])
        rows += [(10 * i + k, " ".join(c)) for k, c in enumerate(copies)]
    found = {r.doc_id: r.group_id for r in sim.near_duplicates(docs_of(spark, [(i, t, "en", "a") for i, t in rows])).collect()}
    assert found == groups_of_all_pairs(rows)


def groups_of_all_pairs(rows):
    grams = {i: set(sim.shingles(t, 5)) for i, t in rows}
    group = {i: i for i in grams}
    for a in sorted(grams):
        for b in sorted(grams):
            if b < a and 5 * len(grams[a] & grams[b]) >= 4 * len(grams[a] | grams[b]):
                x, y = group[a], group[b]
                group = {k: min(x, y) if g in (x, y) else g for k, g in group.items()}
    return group


@pytest.mark.parametrize("group_rows", [2, 1000])
def test_cross_pairs_are_all_pairs(spark, group_rows):
    """Every similar pair of different components, from chunks of any size; sizes differ, and no pair comes twice."""
    rng = np.random.default_rng(7)
    sets = [np.unique(rng.permutation(400)[:60] if i % 10 == 0 else np.r_[rng.permutation(60)[: 45 + i % 13], 60 + rng.permutation(300)[: i % 7]]) for i in range(90)]
    comps = [node % 3 if node < 12 else node for node in range(len(sets))]
    n = np.array([len(x) for x in sets])
    flat, sizes = sim.prefixes(np.concatenate(sets).astype(np.uint64), n, 0.8, (np.arange(60, dtype=np.uint64), np.arange(60) // 3 + 4))
    rare = [x.astype(int).tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
    reps = spark.createDataFrame([(i, int(n[i]), rare[i]) for i in range(len(sets))], "node long, n_grams long, rare array<long>")
    rows = [(g, at, i, int(n[i]), comps[i]) for i in range(len(sets)) for at, g in enumerate(rare[i])]
    rows = spark.createDataFrame(rows, "gram long, place int, node long, n_grams long, comp long")
    found = [(r.u, r.v) for r in sim._cross_pairs(rows, reps, 0.8, group_rows).collect()]
    both = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i in range(len(sets)) for j in range(i + 1, len(sets)) if comps[i] != comps[j]}
    similar = {(i, j) for (i, j), k in both.items() if 5 * k >= 4 * (n[i] + n[j] - k)}
    assert similar and len(found) == len(set(found)) and similar <= set(found) <= set(both)


def test_equal_prints_are_joined_once(spark):
    """Texts of the same words share all fingerprints: one row of each is joined, the others are linked with it."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(9)]
    rows = [(i, " ".join(rng.sample(words, 9))) for i in range(12000)]  # all pairs of a table: 72 million
    docs = docs_of(spark, [(i, t, "en", "a") for i, t in rows])
    reps = sim.text_sketches(docs).selectExpr("doc_id node", "fps", "sketch")
    prints, ties = sim.distinct_prints(reps)
    assert [(r.node, r.weight) for r in prints.collect()] == [(0, 12000)] * sim.TABLES
    assert ties.count() == sim.TABLES * 11999
    found = {r.doc_id: r.group_id for r in sim.near_duplicates(docs.where("doc_id < 400")).collect()}
    assert found == groups_of_all_pairs(rows[:400])
