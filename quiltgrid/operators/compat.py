"""The compatibility pipeline (P1 to P35) as operators over tables of functions, cases, versions and formulas."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgrid.functions.values import ERROR_CODES, to_serial
from quiltgrid.operators.scans import same_keys
from quiltgrid.operators.tables import distinct_values
from quiltgrid.session import dealt, materialize

# Parts of engine names, in the order in which they are tried, and the keys they give.
LABELS = (("libreoffice", "libreoffice"), ("excel", "excel"), ("google", "google_sheets"), ("sheets", "google_sheets"))
# End of fixed values.
TOLERANCE = 1e-9
#: Worst first.
STATES = ("quirky", "unsupported", "supported")


def normalize_label(name: Column, labels=LABELS) -> Column:
    """The key of the first part that a free-text name contains; else null."""
    out = F.lit(None).cast("string")
    for part, key in reversed(labels):
        out = F.when(F.contains(F.lower(name), F.lit(part)), key).otherwise(out)
    return out


def version_key(version: Column) -> Column:
    """The numbers of a dotted version; what isn't a digit is left out, nothing is 0, no version is an empty array."""
    parts = F.transform(F.split(version, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "[^0-9]", "").try_cast("int"), F.lit(0)))
    return F.when(F.coalesce(version, F.lit("")) == "", F.array().cast("array<int>")).otherwise(parts)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in an order whose later parts break ties; by partial aggregation."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest))


def history_per_key(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Rows with their place in the key's history, from 1, and the value before."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({"step": F.row_number().over(w), "value_before": F.lag(value).over(w)})


def flag_error_codes(value: Column) -> Column:
    """P5: the value if it is an error text; else null."""
    return F.when(value.isin(*ERROR_CODES), value)


def serial(column: Column) -> Column:
    """Fractional days since 1899-12-30."""
    return to_serial(column)


def cells_equal(a: Column, b: Column, kind: str = "num", tol: float = TOLERANCE) -> Column:
    """Numbers are equal strictly within the tolerance, booleans and texts if they are the same; a null text equals ""."""
    if kind == "num":
        return F.when(a.isNotNull() & b.isNotNull(), F.abs(a - b) < tol).otherwise(a.isNull() & b.isNull())
    if kind == "text":
        return F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))
    return a.eqNullSafe(b)


def kind_of_type(data_type: str) -> str:
    """The comparison that a column's type asks for."""
    return "text" if data_type == "string" else "num" if data_type.split("(")[0] in ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal") else "same"


def arrays_equal(expected: Column, actual: Column, kind: str = "num", tol: float = TOLERANCE) -> Column:
    """Null without expectation; lengths first, then every pair of cells."""
    pairs = F.zip_with(expected, actual, lambda e, a: cells_equal(e, a, kind, tol))
    return F.when(expected.isNull(), None).when(actual.isNull() | (F.size(expected) != F.size(actual)), False).otherwise(F.forall(pairs, lambda p: p))


def arrays_detail(expected: Column, actual: Column, kind: str = "num", tol: float = TOLERANCE) -> Column:
    """What differs first, as text; null if nothing does."""
    wrong = F.filter(F.arrays_zip(expected.alias("e"), actual.alias("a")), lambda p: ~cells_equal(p["e"], p["a"], kind, tol))
    first = F.get(wrong, F.lit(0))
    return (
        F.when(expected.isNull(), None).when(actual.isNull(), "no cells were read")
        .when(F.size(expected) != F.size(actual), F.format_string("%d cells wanted, %d read", F.size(expected), F.size(actual)))
        .when(F.size(wrong) > 0, F.format_string("a cell should be %s, is %s", first["e"].cast("string"), first["a"].cast("string")))
    )


def compare_tables(expected: DataFrame, actual: DataFrame, keys: list[str], values: list[str], tol: float = TOLERANCE) -> DataFrame:
    """Per key: match (null where nothing is expected) and the first column that differs; a null key equals a null key."""
    kinds = {c: kind_of_type(expected.schema[c].dataType.simpleString()) for c in values}
    a = actual.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.struct(*values).alias("_a"))
    both = expected.select(*keys, F.struct(*values).alias("_e")).join(a, reduce(and_, same_keys(keys, "_k_")), "full")
    first = F.lit(None).cast("string")
    for c in reversed(values):
        first = F.when(~cells_equal(F.col(f"_e.{c}"), F.col(f"_a.{c}"), kinds[c], tol), c).otherwise(first)
    asked = F.col("_e").isNotNull()
    first = F.when(asked & F.col("_a").isNull(), "missing").otherwise(first)
    own = [F.when(asked, F.col(k)).otherwise(F.col(f"_k_{k}")).alias(k) for k in keys]
    return both.select(*own, F.when(asked, first.isNull()).alias("matched"), F.when(asked, first).alias("detail"))


def trust_gate(df: DataFrame, run: list[str], deterministic_ok: Column, volatile_differs: Column) -> DataFrame:
    """A run is trusted if both hold in all its rows; else its note says which failed."""
    checks = df.groupBy(*run).agg(F.bool_and(F.coalesce(deterministic_ok, F.lit(False))).alias("_d"), F.bool_and(F.coalesce(volatile_differs, F.lit(False))).alias("_v"))
    note = F.concat_ws("; ", F.when(~F.col("_d"), "deterministic value differs"), F.when(~F.col("_v"), "volatile value repeats"))
    return checks.select(*run, (F.col("_d") & F.col("_v")).alias("trusted"), note.alias("gate_note"))


def case_report(cases: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """P10: cases (expected, expected_note) with their results (value, error, canary_ok): match and notes, in a fixed order."""
    joined = cases.join(results, key)
    kind = kind_of_type(cases.schema["expected"].dataType.simpleString())
    matched = F.when(F.col("expected").isNotNull(), cells_equal(F.col("expected"), F.col("value"), kind))
    detail = F.format_string("should be %s, is %s", F.col("expected").cast("string"), F.coalesce(F.col("value").cast("string"), F.lit("null")))
    notes = F.concat_ws("; ", F.when(~F.col("canary_ok"), "UNTRUSTED_RECALC"), F.col("expected_note"), F.when(~matched, detail))
    return joined.withColumns({"matched": matched, "notes": notes})


def group_verdict(df: DataFrame, keys: list[str], matched: Column, value: Column, error: Column, range_values: Column | None = None) -> DataFrame:
    """Supported if every case is ok; unsupported if any is #NAME?; else quirky. Case without expectation: ok if it has no error."""
    ok = F.when(matched.isNull(), error.isNull()).otherwise(matched)
    unknown = F.coalesce(value == "#NAME?", F.lit(False))
    if range_values is not None:
        unknown = unknown | F.coalesce((F.size(range_values) > 0) & F.forall(range_values, lambda v: v == "#NAME?"), F.lit(False))
    return df.groupBy(*keys).agg(F.when(F.bool_and(ok), "supported").when(F.bool_or(unknown), "unsupported").otherwise("quirky").alias("verdict"), F.count("*").alias("cases"))


def support_matrix(inventory: DataFrame, verdicts: DataFrame, key: str, apps: list[str]) -> DataFrame:
    """An inventory row per key with a verdict column per application; unlisted keys drop out."""
    wide = verdicts.groupBy(key).pivot("app", apps).agg(F.first("verdict"))
    return inventory.join(wide, key, "left")


def mismatch_rows(df: DataFrame, matched: str) -> DataFrame:
    """Rows whose match is false; unknown is no mismatch."""
    return df.where(F.col(matched) == F.lit(False))


def state_change(df: DataFrame, keys: list[str], version: str, supported: Column) -> DataFrame:
    """Keys whose first and last state differ: since when it was first supported, and whether that is new."""
    grouped = df.groupBy(*keys).agg(
        F.countDistinct(version).alias("versions"), F.min_by(supported, version).alias("first_state"), F.max_by(supported, version).alias("last_state"),
        F.min(F.when(supported, F.col(version))).alias("since"),
    )
    changed = grouped.where((F.col("versions") >= 2) & (F.col("first_state") != F.col("last_state")))
    return changed.withColumn("newly", ~F.col("first_state") & F.col("last_state")).drop("versions")


def rollup_priority(df: DataFrame, keys: list[str], state: str, matched: Column, date: str) -> DataFrame:
    """The worst state of each key (null if it has none), counts of mismatches and of rows, and the last date."""
    rank = F.lit(len(STATES))
    for i, name in reversed(list(enumerate(STATES))):
        rank = F.when(F.col(state) == name, i).otherwise(rank)
    worst = F.get(F.array(*map(F.lit, STATES)), F.min(rank))
    return df.groupBy(*keys).agg(worst.alias("worst"), F.count_if(~matched).alias("quirks"), F.count("*").alias("cases"), F.max(date).alias("last_date"))


def corpus_stats(df: DataFrame, **counts: Column) -> DataFrame:
    """One row of totals."""
    return df.agg(*(c.alias(n) for n, c in counts.items()))


def top_k_by(df: DataFrame, order: list, k: int = 8) -> DataFrame:
    """The first k rows."""
    return df.orderBy(*order).limit(k)


def ordered_allowlist(df: DataFrame, key: str, wanted: list) -> DataFrame:
    """Rows of a curated list with their place in it."""
    kind = df.schema[key].dataType.simpleString()
    listed = df.sparkSession.createDataFrame([(w, i) for i, w in enumerate(wanted)], f"{key} {kind}, list_pos int")
    return df.join(F.broadcast(listed), key)


def extract_calls(text: Column) -> Column:
    """Names before "(" outside quoted text, upper case, distinct, first seen first."""
    bare = F.regexp_replace(text, r'"[^"]*"', '""')
    return F.array_distinct(F.transform(F.regexp_extract_all(bare, F.lit(r"([A-Za-z_][A-Za-z0-9_.]*)\("), F.lit(1)), lambda n: F.upper(n)))


def inverted_index(df: DataFrame, token: str, item: str) -> DataFrame:
    """P20: distinct (token, item) pairs with the token's number of items; no list is held in one row."""
    pairs = df.select(token, item).distinct()
    return pairs.join(pairs.groupBy(token).agg(F.count("*").alias("n_items")), token)


#: Items that a token may have for its pairs to be listed.
HOT = 1000


#: Rows that a key may have for its items to be counted in one row; with ``HOT`` this bounds that row.
KEY_TOKENS = 2000
#: Items in lists that weigh as much as a row when rows are dealt out.
LISTED = 16


def _top_shared(left: DataFrame, right: DataFrame, k: int, hot: int, apart: bool, key_tokens: int = KEY_TOKENS) -> DataFrame:
    """(_key, _item, _score, _place): for each key of ``left`` (_key, _t) the k items of ``right`` (_item, _t) that share most tokens.

    A token's items travel to its keys as one list, and a key's lists are counted in its
    row, so that no pair is a row of its own. Keys of more than ``key_tokens`` rows, and
    all keys if a token has more than ``hot`` items, are counted pair by pair. ``apart``
    leaves out an item's pair with itself.
    """
    # Repeated rows may count a token as frequent that isn't, or a key as large: that makes no difference to the result.
    # Dealt out first: a map of a whole input split's tokens grows with the table.
    both = left.select("_t", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(right.select("_t", F.lit(0), F.lit(1)))
    tokens = dealt(both, left.count() + right.count(), "_t").groupBy("_t").agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    size = tokens.agg(F.max("_r").alias("most"), F.sum("_l").alias("left"), F.sum("_r").alias("right"), F.sum(F.col("_l") * F.col("_r")).alias("pairs")).first()
    if (size["most"] or 0) > hot:
        often = materialize(tokens.where(F.col("_r") > hot).select("_t"))
        return _best(_scored_by_sets(left.distinct(), right.distinct(), often, k), k, apart)
    rows = max(size["left"] or 0, size["right"] or 0)
    large = materialize(left.groupBy("_key").agg(F.count("*").alias("_n")).where(F.col("_n") > key_tokens).select("_key"))
    some = not large.isEmpty()
    lists = dealt(right, rows, "_t").groupBy("_t").agg(F.collect_set("_item").alias("_items"))
    own = dealt(left.join(large, "_key", "left_anti") if some else left, rows, "_t").distinct()
    met = dealt(own.join(lists, "_t").select("_key", "_items"), max(rows, (size["pairs"] or 0) // LISTED), "_key")
    top = _best_of_lists(met.groupBy("_key").agg(F.flatten(F.collect_list("_items")).alias("_all")), k, apart)
    if not some:
        return top
    pairs = left.join(large, "_key", "left_semi").distinct().join(right.distinct(), "_t")
    return top.unionByName(_best(pairs.groupBy("_key", "_item").agg(F.count("*").alias("_score")), k, apart))


def _best(scored: DataFrame, k: int, apart: bool) -> DataFrame:
    """The first k of each key's rows (_key, _item, _score)."""
    if apart:
        scored = scored.where(F.col("_key") != F.col("_item"))
    order = Window.partitionBy("_key").orderBy(F.col("_score").desc(), "_item")
    return scored.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)


def _best_of_lists(keys: DataFrame, k: int, apart: bool) -> DataFrame:
    """The same of rows (_key, _all), each item being in the list as often as it shares a token.

    In the sorted list an item that was there before is a repeat; runs of repeats give the
    scores above 1. Where these are fewer than k, the first of the other items follow.
    """
    sort = keys.select("_key", F.sort_array(F.array_remove("_all", F.col("_key")) if apart else "_all").alias("_all"))
    sort = sort.withColumn("_again", F.filter("_all", lambda x, i: x == F.get("_all", i - 1)))
    sort = sort.withColumn("_starts", F.array_compact(F.transform("_again", lambda x, i: F.when((i == 0) | (x != F.get("_again", i - 1)), i))))
    run = lambda s, j: F.struct((s - F.coalesce(F.get("_starts", j + 1), F.size("_again")) - 1).alias("less"), F.get("_again", s).alias("item"))
    sort = sort.withColumn("_best", F.slice(F.sort_array(F.transform("_starts", run)), 1, k))
    # Fewer than k of the first 2 * k different items are among the best.
    others = F.slice(F.array_except(F.slice(F.array_distinct("_all"), 1, 2 * k), F.transform("_best", lambda b: b["item"])), 1, k)
    filled = F.slice(F.concat("_best", F.transform(others, lambda x: F.struct(F.lit(-1).alias("less"), x.alias("item")))), 1, k)
    sort = sort.withColumn("_best", F.when(F.size("_best") < k, filled).otherwise(F.col("_best")))
    # Outer: else a filter by the list's size would count every list twice.
    each = sort.select("_key", F.posexplode_outer("_best").alias("_nth", "_b")).where(F.col("_nth").isNotNull())
    return each.select("_key", F.col("_b.item").alias("_item"), (-F.col("_b.less")).cast("long").alias("_score"), (F.col("_nth") + 1).alias("_place"))


def _scored_by_sets(left: DataFrame, right: DataFrame, often: DataFrame, k: int) -> DataFrame:
    """(_key, _item, _score) where tokens ``often`` are frequent: all that may be among a key's first k.

    Pairs are listed by the other tokens. Frequent ones are counted between sets: items
    with the same set of them are alike but for their names, so that of each set the first
    k + 1 names are kept, and sets that share such a token are paired. Exact: what an item
    shares through frequent tokens alone can only be among the first k of that order.
    """
    sets = lambda df, c: materialize(df.join(often, "_t", "left_semi").groupBy(c).agg(F.array_sort(F.collect_set("_t")).alias(f"_set{c}")))
    own, others = sets(left, "_key"), sets(right, "_item")
    shared = F.when(F.col("_set_key").isNotNull() & F.col("_set_item").isNotNull(), F.size(F.array_intersect("_set_key", "_set_item"))).otherwise(0)
    rare = left.join(right.join(often, "_t", "left_anti"), "_t").groupBy("_key", "_item").agg(F.count("*").alias("_c"))
    rare = rare.join(own, "_key", "left").join(others, "_item", "left").select("_key", "_item", (F.col("_c") + shared).alias("_score"))
    first = Window.partitionBy("_set_item").orderBy("_item")
    names = others.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= k + 1)
    each = lambda df, c: df.select(c).distinct().withColumn("_t", F.explode(c))
    met = each(own, "_set_key").join(each(names, "_set_item"), "_t").groupBy("_set_key", "_set_item").agg(F.count("*").alias("_score"))
    best = Window.partitionBy("_set_key").orderBy(F.col("_score").desc(), "_item")
    ranked = met.join(names, "_set_item").withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= k + 1)
    by_set = own.join(ranked, "_set_key").select("_key", "_item", "_score")
    return rare.unionByName(by_set).groupBy("_key", "_item").agg(F.max("_score").alias("_score"))


def related_items(df: DataFrame, token: str, item: str, k: int = 5, hot: int = HOT) -> DataFrame:
    """For each item, the k others that share most tokens (ties by name); a token that all items share isn't squared."""
    pairs = df.select(F.col(item).alias("_item"), F.col(token).alias("_t")).where("_item is not null and _t is not null")
    best = _top_shared(pairs.withColumnRenamed("_item", "_key"), pairs, k, hot, apart=True)
    return best.select(F.col("_key").alias(item), F.col("_item").alias("other"), F.col("_score").alias("score"), F.col("_place").alias("place"))


def items_for_group(groups: DataFrame, items: DataFrame, group: str, token: str, item: str, k: int = 6, hot: int = HOT) -> DataFrame:
    """For each group, the k items that share most of its tokens (ties by name)."""
    left = groups.select(F.col(group).alias("_key"), F.col(token).alias("_t")).where("_key is not null and _t is not null")
    right = items.select(F.col(item).alias("_item"), F.col(token).alias("_t")).where("_item is not null and _t is not null")
    best = _top_shared(left, right, k, hot, apart=False)
    return best.select(F.col("_key").alias(group), F.col("_item").alias(item), F.col("_score").alias("score"), F.col("_place").alias("place"))


def classify_first_match(text: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The first rule with a keyword that the text contains."""
    out = F.lit(default)
    for name, words in reversed(rules):
        test = F.lit(False)
        for w in words:
            test = test | F.contains(F.lower(text), F.lit(w))
        out = F.when(test, name).otherwise(out)
    return out


def check_corpus(calls: DataFrame, compat: DataFrame, key: str, name: str, apps: list[str]) -> DataFrame:
    """P25: per formula: number of calls, whether all work in each application, and unknown names."""
    known = compat.withColumn("_known", F.lit(True))
    joined = calls.select(key, name).distinct().join(known, name, "left")
    works = [F.bool_and(F.coalesce(F.col(a), F.lit(False))).alias(f"ok_{a}") for a in apps]
    return joined.groupBy(key).agg(F.count("*").alias("n_calls"), *works, F.count_if(F.col("_known").isNull()).alias("n_unknown"))


def migration_report(calls: DataFrame, compat: DataFrame, alternatives: DataFrame, key: str, name: str, ok: Column) -> DataFrame:
    """Calls that don't work in the target, with an alternative if one is known."""
    broken = calls.select(key, name).distinct().join(compat, name).where(~F.coalesce(ok, F.lit(False)))
    return broken.join(alternatives, name, "left")


def exclusive_items(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Items in A and not in B."""
    return df.where(a & ~b)


def overlap_counts(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """How many are only in A, only in B, in both."""
    return df.agg(F.count_if(a & ~b).alias("only_a"), F.count_if(b & ~a).alias("only_b"), F.count_if(a & b).alias("both"))


def version_matrix(df: DataFrame, key: str, version: str, versions: list | None, state: str) -> DataFrame:
    """States per version as columns, for keys whose state changes; versions that aren't given are found."""
    versions = distinct_values(df, version) if versions is None else versions
    changed = df.groupBy(key).agg(F.countDistinct(state).alias("_n")).where("_n > 1").select(key)
    return df.join(changed, key, "left_semi").groupBy(key).pivot(version, versions).agg(F.first(state))


def verify_examples(df: DataFrame, expected: Column, actual: Column, error: Column) -> DataFrame:
    """Whole floats as integers, nulls dropped, compared as text; an error is a failure."""
    tidy = lambda arr: F.transform(F.filter(arr, lambda x: x.isNotNull()), lambda x: F.regexp_replace(x, r"^(-?\d+)\.0+$", "$1"))
    return df.withColumn("verified", error.isNull() & F.coalesce(tidy(expected) == tidy(actual), F.lit(False)))


def outcome_summary(df: DataFrame, error: Column) -> DataFrame:
    """Outcomes without error, #NAME?, and with other errors."""
    return df.agg(F.count_if(error.isNull()).alias("fine"), F.count_if(error == "#NAME?").alias("unknown_name"), F.count_if(error.isNotNull() & (error != "#NAME?")).alias("other_errors"))


def rewrite_tokens(text: Column, prefixes: dict[str, str]) -> Column:
    """Calls of whole names, found without case and followed by a bracket at once, get a prefix and the listed spelling; the longest names first."""
    out, literal = text, lambda t: t.replace("\\", r"\\").replace("$", r"\$")
    for name, prefix in sorted(prefixes.items(), key=lambda p: (-len(p[0]), p[0])):
        pattern = r"(?i)(?<![A-Za-z0-9_.])" + re.escape(name) + r"(?=\()"
        out = F.regexp_replace(out, pattern, literal(prefix + name))
    return out


def flag_member(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Whether a row's name is listed."""
    return df.join(names.select(key).distinct().withColumn("is_member", F.lit(True)), key, "left").fillna({"is_member": False})
