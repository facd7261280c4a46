"""Lookups and joins.

Join strategy is left to Spark: small tables are broadcast below its size threshold,
others are shuffled, with skewed partitions split at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiltgrid.functions.criteria import criterion
from quiltgrid.operators.aggregates import number
from quiltgrid.operators.scans import running_columns, same_keys
from quiltgrid.session import materialize


def first_match(table: DataFrame, keys: list[str], pos: str, columns: list[str]) -> DataFrame:
    """One row per key: the first by ``pos``, by partial aggregation."""
    best = F.min_by(F.struct(*columns), pos).alias("_m")
    return table.groupBy(*keys).agg(best).select(*keys, *(F.col(f"_m.{c}").alias(c) for c in columns))


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, value: str, pos: str, default=None) -> DataFrame:
    """The value of the first row whose key is equal; the default, and ``found`` false, if there is none."""
    found = first_match(table, [table_key], pos, [value]).select(F.col(table_key).alias("_k"), F.col(value).alias("_v"))
    joined = df.join(found, F.col(key) == F.col("_k"), "left")
    shown = F.when(F.col("_k").isNotNull(), F.col("_v"))
    shown = shown if default is None else shown.otherwise(F.lit(default))
    return joined.withColumns({value: shown, "found": F.col("_k").isNotNull()}).drop("_k", "_v")


def match_position(df: DataFrame, table: DataFrame, key: str, table_key: str, pos: str) -> DataFrame:
    """The first place of an equal key."""
    places = table.groupBy(F.col(table_key).alias("_k")).agg(F.min(pos).alias("position"))
    return df.join(places, F.col(key) == F.col("_k"), "left").drop("_k")


def header_lookup(table: DataFrame, row: str, columns: list[str], wanted: str) -> DataFrame:
    """Lookup along the header row: (row, value) of the column of that name."""
    cells = table.select(row, *(F.col(c).cast("string").alias(c) for c in columns)).unpivot([row], columns, "header", "value")
    return cells.where(F.lower("header") == wanted.lower()).select(row, "value")


def lookup_approx(df: DataFrame, table: DataFrame, by: list[str], key: str, table_key: str, values: list[str], next_larger: bool = False, spread: bool | None = None) -> DataFrame:
    """Within equal ``by`` columns, the row of the table with the greatest key at or below (least at or above) the sought one.

    As-of join: both sides are put in one order and the last table row is carried over,
    from range to range where a group is larger than a task may scan. ``by`` may be
    empty; a null key neither finds nor is found.
    """
    cols = [c for c in df.columns if c not in by]
    left = df.select(*by, F.col(key).alias("_at"), F.lit(1).alias("_side"), F.struct(*cols).alias("_row"), F.lit(None).cast(_struct(table, [table_key, *values])).alias("_t"))
    right = table.where(F.col(table_key).isNotNull()).select(*by, F.col(table_key).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(_struct(df, cols)).alias("_row"), F.struct(table_key, *values).alias("_t"))
    at = F.col("_at").desc() if next_larger else F.col("_at").asc()
    both = running_columns(left.unionByName(right), by, [at, "_side"], {"_hit": (F.col("_t"), "last")}, spread).where("_side = 1")
    hit = lambda c: F.when(F.col("_at").isNotNull(), F.col(f"_hit.{c}"))
    return both.select(*by, *(F.col(f"_row.{c}").alias(c) for c in cols), *(hit(c).alias(c) for c in (table_key, *values)))


def _struct(df: DataFrame, columns: list[str]) -> str:
    return df.select(F.struct(*columns).alias("s")).schema["s"].dataType.simpleString()


def lookup_bins(df: DataFrame, steps: list[tuple[float, object]], key: str, name: str) -> DataFrame:
    """For a short step table given as values: the value of the greatest step at or below the key."""
    out = F.lit(None)
    for edge, value in sorted(steps):
        out = F.when(F.col(key) >= edge, F.lit(value)).otherwise(out)
    return df.withColumn(name, out)


#: Characters of the literal parts by which patterns find texts, and what stands before and after a text.
GRAM, START, END, GAP = 3, "\x02", "\x03", "\x01"


def _tokens(pattern: Column) -> Column:
    """A pattern's characters and wildcards, in lower case; ``~`` and what it takes literally are one."""
    return F.regexp_extract_all(F.lower(pattern), F.lit(r"(?s)~[*?~]|."), F.lit(0))


def _is_wild(token: Column) -> Column:
    return (token == "*") | (token == "?")


def pattern_regex(pattern: Column) -> Column:
    """Java pattern of a column of wildcard texts, for texts in lower case."""
    quoted = lambda t: F.concat(F.lit(r"\Q"), F.right(t, F.lit(1)), F.lit(r"\E"))
    parts = F.transform(_tokens(pattern), lambda t: F.when(t == "*", ".*").when(t == "?", ".").otherwise(quoted(t)))
    return F.concat(F.lit("(?s)^"), F.array_join(parts, ""), F.lit("$"))


def _grams(text: Column, size: int) -> Column:
    """The different runs of ``size`` characters of a text."""
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    return F.array_distinct(F.transform(F.slice(chars, F.lit(1), F.greatest(F.size(chars) - (size - 1), F.lit(0))), lambda c, i: F.array_join(F.slice(chars, i + 1, F.lit(size)), "")))


def _pattern_grams(patterns: DataFrame) -> DataFrame:
    """(_pattern, _size, _gram): of each pattern's literal parts, the runs of the greatest size up to ``GRAM`` that it has."""
    literal = F.array_join(F.transform(_tokens(F.col("_pattern")), lambda t: F.when(_is_wild(t), GAP).otherwise(F.right(t, F.lit(1)))), "")
    parts = F.filter(F.split(F.concat(F.lit(START), literal, F.lit(END)), GAP), lambda p: ~p.isin("", START, END))
    out = patterns.withColumn("_parts", parts).withColumn("_size", F.least(F.array_max(F.transform("_parts", lambda p: F.length(p))), F.lit(GRAM)))
    of_size = lambda size: F.array_distinct(F.flatten(F.transform("_parts", lambda p: _grams(p, size))))
    each = F.lit(None).cast("array<string>")
    for size in range(1, GRAM + 1):
        each = F.when(F.col("_size") == size, of_size(size)).otherwise(each)
    return out.select("_pattern", "_size", F.explode(F.filter(each, lambda g: ~g.isin(START, END))).alias("_gram"))


def lookup_patterns(patterns: DataFrame, table: DataFrame, pattern: str, text: str, pos: str, value: str) -> DataFrame:
    """For each different wildcard text of a table of patterns, the value of the first row by ``pos`` that matches, without case.

    Texts are indexed by their runs of up to three characters, their start and end being
    characters too. A pattern looks up that of its literal runs which fewest texts have,
    and only those texts are held against it; one that no text has ends the search.
    Patterns of wildcards alone are answered by the texts' lengths. ``pos`` tells rows apart.
    """
    asked = patterns.select(F.col(pattern).alias("_pattern")).where("_pattern is not null").distinct()
    rows = table.where(F.col(text).isNotNull()).select(F.col(pos).alias("_pos"), F.lower(text).alias("_text"), F.col(value).alias("_value"))
    grams = materialize(_pattern_grams(asked))
    sizes = [r["_size"] for r in grams.select("_size").distinct().collect()]  # three at most
    framed = F.concat(F.lit(START), F.col("_text"), F.lit(END))
    listed = rows.select("_pos", F.explode(F.array_distinct(F.concat(*(_grams(framed, size) for size in sizes)))).alias("_gram")) if sizes else rows.select("_pos", F.lit("").alias("_gram")).limit(0)
    listed = materialize(listed.join(grams.select("_gram").distinct(), "_gram", "left_semi"))
    counts = listed.groupBy("_gram").agg(F.count("*").alias("_n"))
    rarest = grams.join(counts, "_gram", "left").groupBy("_pattern").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("g"))).alias("_r"))
    rarest = rarest.where("_r.n > 0").select("_pattern", F.col("_r.g").alias("_gram"), pattern_regex(F.col("_pattern")).alias("_regex"))
    met = listed.join(rarest, "_gram").select("_pattern", "_regex", "_pos").join(rows, "_pos").where(F.expr("_text rlike _regex"))
    first = F.min_by("_value", "_pos").alias("_value")
    found = met.groupBy("_pattern").agg(first)
    # What wildcards alone ask for: a length, or at least a length.
    wild = asked.where(F.forall(_tokens(F.col("_pattern")), _is_wild)).select("_pattern", F.size(F.filter(_tokens(F.col("_pattern")), lambda t: t == "?")).alias("_least"), F.contains("_pattern", F.lit("*")).alias("_more"))
    lengths = rows.groupBy(F.length("_text").alias("_length")).agg(F.min(F.struct("_pos", "_value")).alias("_best"))
    exact = wild.where("not _more").join(lengths, F.col("_least") == F.col("_length")).select("_pattern", F.col("_best._value").alias("_value"))
    longer = running_columns(lengths, [], [F.col("_length").desc()], {"_any": (F.col("_best"), "min")}, spread=False)  # a row per length
    more = lookup_approx(wild.where("_more"), longer.select("_length", "_any"), [], "_least", "_length", ["_any"], next_larger=True, spread=False)
    found = found.unionByName(exact).unionByName(more.where("_any is not null").select("_pattern", F.col("_any._value").alias("_value")))
    joined = asked.join(found.withColumnRenamed("_pattern", "_p"), F.col("_pattern") == F.col("_p"), "left")
    return joined.select(F.col("_pattern").alias(pattern), F.col("_value").alias(value))


def lookup_wildcard(patterns: list[str], table: DataFrame, text: str, pos: str, value: str) -> DataFrame:
    """The same for a few patterns given as a list; they may repeat."""
    spark = table.sparkSession
    asked = spark.createDataFrame(list(enumerate(patterns)), "_nr int, pattern string")
    found = lookup_patterns(asked, table, "pattern", text, pos, value).withColumnRenamed("pattern", "_asked")
    return asked.join(found, F.col("pattern") == F.col("_asked")).select("pattern", value)


def lookup_composite(df: DataFrame, table: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """A key of several columns, each compared for itself; a null part equals a null part."""
    found = first_match(table, keys, pos, [value]).select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col(value).alias("_value"))
    return df.join(found, same_keys(keys, "_k_"), "left").select(*(c for c in df.columns if c != value), F.col("_value").alias(value))


def lookup_two_way(df: DataFrame, cross: DataFrame, row: str, header: str, columns: list[str]) -> DataFrame:
    """The cell of a cross table at (row key, column name)."""
    cells = cross.select(row, *(F.col(c).cast("double").alias(c) for c in columns)).unpivot([row], columns, header, "cell")
    return df.join(cells, [row, header], "left")


def lookup_last(df: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """Each key's last value, and its last that is not blank."""
    some = F.when(F.col(value).isNotNull() & (F.col(value).cast("string") != ""), F.col(pos))
    return df.groupBy(*keys).agg(F.max_by(value, pos).alias("last_value"), F.max_by(value, some).alias("last_non_blank"))


def lookup_all(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Every match."""
    return df.join(table, keys)


def in_both(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` whose key ``b`` has."""
    return a.join(b, keys, "left_semi")


def not_in(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` whose key ``b`` lacks."""
    return a.join(b, keys, "left_anti")


def flag_in(a: DataFrame, b: DataFrame, key: str, name: str = "is_in") -> DataFrame:
    """Whether ``b`` has a row's key."""
    return a.join(b.select(key).distinct().withColumn(name, F.lit(True)), key, "left").fillna({name: False})


def combine_lists(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both lists without duplicates."""
    return a.union(b).distinct()


def criteria_mask(rows: list[dict[str, object]]) -> Column:
    """A criteria table as a predicate: a row's cells are all met, in any of the rows; an empty cell asks nothing."""
    out = F.lit(False) if rows else F.lit(True)
    for row in rows:
        met = F.lit(True)
        for column, text in row.items():
            if text is not None and text != "":
                met = met & criterion(F.col(column), text)
        out = out | met
    return out


def db_aggregate(df: DataFrame, criteria: list[dict[str, object]], field: str | int) -> DataFrame:
    """Sum, average, count of numbers, least, greatest and the single value of a field over rows that a criteria table selects; one row."""
    name = df.columns[field - 1] if isinstance(field, int) else next(c for c in df.columns if c.lower() == field.lower())
    kept = df.where(criteria_mask(criteria))
    x = number(name)
    total = F.sum(x)
    return kept.agg(F.coalesce(total, F.lit(0.0)).alias("dsum"), F.try_divide(total, F.count(x)).alias("daverage"), F.count(x).alias("dcount"), F.coalesce(F.min(x), F.lit(0.0)).alias("dmin"), F.coalesce(F.max(x), F.lit(0.0)).alias("dmax"), F.when(F.count("*") == 1, F.first(name)).alias("dget"))


def bracket_sum(df: DataFrame, value: str, brackets: list[tuple[float, float]], name: str = "bracket_sum") -> DataFrame:
    """Marginal tiers: what lies above each threshold, times the step of the rate there."""
    x, out, last = F.col(value), F.lit(0.0), 0.0
    for threshold, rate in sorted(brackets):
        out = out + F.greatest(x - threshold, F.lit(0.0)) * (rate - last)
        last = rate
    return df.withColumn(name, out)


def cross_table_agg(tables: dict[str, DataFrame], keys: list[str], value: str) -> DataFrame:
    """Sums of a value over several tables by key, in all and in each table."""
    both = None
    for name, t in tables.items():
        part = t.select(*keys, number(value).alias("_v"), F.lit(name).alias("_t"))
        both = part if both is None else both.unionByName(part)
    return both.groupBy(*keys).agg(F.coalesce(F.sum("_v"), F.lit(0.0)).alias("total"), *(F.coalesce(F.sum(F.when(F.col("_t") == n, F.col("_v"))), F.lit(0.0)).alias(f"from_{n}") for n in tables))
