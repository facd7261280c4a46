"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document's counts.
Votes are counted by pattern, at most 3 ** rules rows; expectation-maximisation
over the patterns estimates the share of good documents and each rule's accuracy
on good and on bad ones; a document's posterior probability of being good then
decides. Patterns stay a table: only the 2 * rules + 1 parameters pass through
the driver between rounds, which end when no parameter moves by ``TOLERANCE``. Beta
distributions hold what is believed of accuracies beforehand, with the weight of a share
of the documents, so that estimates come out alike at every size.

Defined cases: a null, empty or blank text has no words, so it fails the base
rule; a repeated doc_id keeps its rows; extra columns are ignored; an empty table
gives no rows. With no votes at all the prior decides.
"""

from __future__ import annotations

import collections
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgrid.llm.common import BLANKS, let, materialize, table, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Rounds end when no parameter moves by more. Each raises the posterior density, so that they do end.
TOLERANCE = 1e-4
#: Beliefs before any vote is seen, as beta distributions: an accuracy on good and on bad
#: documents and the share of good ones, each with the share of the documents that it
#: weighs as much as. A rule seldom fails a good document; it may miss most bad ones, as
#: junk is of many kinds. Without them the model settles on one kind of junk alone.
PRIOR_GOOD, PRIOR_BAD, PRIOR_SHARE = 0.99, 0.3, 0.8
WEIGHT_GOOD, WEIGHT_BAD, WEIGHT_SHARE = 0.05, 0.01, 0.001
MIN_POSTERIOR = 0.5

#: (name, value, good at most, bad above): between the two a rule abstains. No value is
#: -1 or less: the last two rules never vote good.
RULES = (
    ("symbols", "n_symbols / n_words", 0.05, 0.25),
    ("repeats", "n_repeat_words / n_words", 0.05, 0.2),
    ("dup_lines", "n_dup_lines / n_lines", 0.05, 0.2),
    ("capitals", "n_upper / n_letters", 0.15, 0.4),
    ("marks", "1 - n_letters / word_chars", 0.12, 0.3),
    ("shouts", "n_shouts / n_words", 0.02, 0.2),
    ("cells", "n_cells / n_words", 0.01, 0.1),
    ("long_words", "word_chars / n_words", -1.0, 14.0),
    ("short_words", "n_words / word_chars", -1.0, 0.45),
)


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of ``window`` words that the text has twice or more."""

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twins = let(placed, lambda p: F.filter(F.transform(p, lambda x, k: F.when(
            ((k > 0) & (F.get(p, k - 1)["h"] == x["h"])) | (F.get(p, k + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull()))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).cast("int").alias("at"))
        return F.aggregate(
            F.sort_array(twins), start,
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(window), i - acc["at"])).alias("n"), i.alias("at")),
            lambda acc: acc["n"],
        )

    def of_hashes(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(hashes)).otherwise(F.lit(0).cast("long"))

    firsts = F.slice(words, F.lit(1), F.size(words) - (window - 1))
    hashes = F.transform(firsts, lambda word, i: F.xxhash64(word, *(F.get(words, i + k) for k in range(1, window))))
    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(let(hashes, of_hashes))


def document_counts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and the counts that rules use."""
    text = F.coalesce(F.col("text"), F.lit(""))
    ink = F.translate(text, BLANKS, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    of_words = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return docs.select(
        "doc_id", of_words.alias("_w"), of_lines.alias("_l"),
        F.length(ink).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit(r"[!?]{2,}")).cast("long").alias("n_shouts"),
        F.regexp_count(text, F.lit(r" [|] ")).cast("long").alias("n_cells"),
    ).select(
        "doc_id", "_w.n_words", "word_chars", "n_symbols", "_l.n_dup_lines", "_w.n_repeat_words",
        "_l.n_lines", "n_letters", "n_upper", "n_shouts", "n_cells",
    )


def vote(value: str, good: float, bad: float) -> Column:
    """1, -1 or 0; 0 too where the value can't be computed."""
    over, _, under = value.rpartition(" / ")
    if over.startswith("1 - "):
        x = 1 - F.try_divide(F.col(over[4:]), F.col(under))
    else:
        x = F.try_divide(F.col(over), F.col(under))
    return F.when(x <= good, 1).when(x > bad, -1).otherwise(0)


def _posterior(share: float, right_good: dict, right_bad: dict) -> Column:
    """Probability that a row with these votes is good.

    The weights are one array that votes index, so that the code that Spark generates
    is the same in each round.
    """
    weights = []
    for name in right_good:
        g, b = right_good[name], right_bad[name]
        # A rule that is worse than chance says nothing: no vote speaks for its opposite.
        weights += [min(0.0, math.log((1 - g) / b)), 0.0, max(0.0, math.log(g / (1 - b)))]
    weights = F.array(*(F.lit(w) for w in weights))
    votes = F.transform(F.array(*right_good), lambda v, i: F.get(weights, 3 * i + v + 1))
    odds = F.aggregate(votes, F.lit(math.log(share / (1 - share))), lambda total, w: total + w)
    return 1 / (1 + F.exp(-odds))


def fit_label_model(patterns: DataFrame, names: list[str], tolerance: float = TOLERANCE) -> tuple[float, dict, dict]:
    """Share of good documents and each rule's accuracy on good and bad ones: those of greatest posterior density.

    ``patterns``: one row per vote pattern, with its count ``n``.
    """
    share, right_good, right_bad = PRIOR_SHARE, dict.fromkeys(names, PRIOR_GOOD), dict.fromkeys(names, PRIOR_BAD)
    while True:
        scored = patterns.withColumn("p", _posterior(share, right_good, right_bad))
        cast = scored.select("p", "n", F.posexplode(F.array(*names)).alias("rule", "vote")).groupBy("rule", "vote")
        sums = cast.agg(F.sum(F.col("n") * F.col("p")).alias("good"), F.sum(F.col("n") * (1 - F.col("p"))).alias("bad"))
        good, bad = collections.Counter(), collections.Counter()
        for row in sums.collect():  # three rows a rule
            good[row["rule"], row["vote"]], bad[row["rule"], row["vote"]] = row["good"], row["bad"]
        total = sum(good[0, v] + bad[0, v] for v in (-1, 0, 1))
        if not total:
            return share, right_good, right_bad
        before = [share, *right_good.values(), *right_bad.values()]
        believed = lambda right, votes, prior, weight: (right + weight * total * prior) / (votes + weight * total)
        share = believed(sum(good[0, v] for v in (-1, 0, 1)), total, PRIOR_SHARE, WEIGHT_SHARE)
        for i, name in enumerate(names):
            right_good[name] = believed(good[i, 1], good[i, 1] + good[i, -1], PRIOR_GOOD, WEIGHT_GOOD)
            right_bad[name] = believed(bad[i, -1], bad[i, 1] + bad[i, -1], PRIOR_BAD, WEIGHT_BAD)
        if max(abs(x - y) for x, y in zip(before, [share, *right_good.values(), *right_bad.values()], strict=True)) <= tolerance:
            return share, right_good, right_bad


def log_likelihood(patterns: DataFrame, share: float, right_good: dict, right_bad: dict) -> float:
    """Logarithm of the probability of all votes under a model, to compare models by."""

    def of(prior: float, right: dict, sign: int) -> Column:
        """Logarithm of the probability of being of a kind and voting so."""
        out = F.lit(math.log(prior))
        for name, x in right.items():
            vote = F.col(name) * sign
            out = out + F.when(vote == 1, math.log(x)).when(vote == -1, math.log(1 - x)).otherwise(0.0)
        return out

    good, bad = of(share, right_good, 1), of(1 - share, right_bad, -1)
    both = F.greatest(good, bad) + F.log1p(F.exp(-F.abs(good - bad)))
    return patterns.agg(F.coalesce(F.sum(F.col("n") * both), F.lit(0.0))).first()[0]


def judge_quality(docs: DataFrame, rules=RULES, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """Counts, votes, posterior ``p_good``, ``base_failed`` and ``kept`` of every document."""
    names = [f"vote_{r[0]}" for r in rules]
    counts = document_counts(docs).select("*", *(vote(*r[1:]).alias(n) for r, n in zip(rules, names, strict=True)))
    counts = materialize(counts)
    patterns = materialize(counts.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1))
    model = fit_label_model(patterns, names)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counts.withColumn("p_good", _posterior(*model)).withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("p_good") >= min_posterior))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"
    )
