"""Aggregations (A1 to A15): what spreadsheet aggregate functions give over groups of rows.

Values that aren't numbers are skipped, as text cells are; so are booleans, and "NaN"
and "Infinity". Sums are of doubles, as spreadsheets' are. ``keys`` may be empty for one
group of all rows; a null key is a group. All are partial aggregations, which combine
before the shuffle; only order statistics hold a group's values, or its distinct ones.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgrid.functions.criteria import all_criteria
from quiltgrid.functions.numbers import number
from quiltgrid.operators.scans import is_wide, running_columns, same_keys, with_totals
from quiltgrid.session import materialize


def agg_basic(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A1: sum, average, least, greatest, sum of squares, product of signs and magnitudes; 0 where there is no number, null average."""
    x = number(value)
    zero = F.lit(0.0)
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum(x), zero).alias("sum"), (F.try_divide(F.sum(x), F.count(x))).alias("average"), F.coalesce(F.min(x), zero).alias("min"),
        F.coalesce(F.max(x), zero).alias("max"), F.coalesce(F.sum(x * x), zero).alias("sumsq"),
    )


def product(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A1: product of the numbers."""
    return df.groupBy(*keys).agg(F.coalesce(F.product(number(value)), F.lit(0.0)).alias("product"))


def count_kinds(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A2: numbers, values that are not empty, and blanks (null or "")."""
    c = F.col(value)
    return df.groupBy(*keys).agg(F.count(number(value)).alias("numbers"), F.count(c).alias("non_empty"), F.count_if(c.isNull() | (c.cast("string") == "")).alias("blanks"))


def agg_if(df: DataFrame, keys: list[str], value: str, criteria: dict[str, list[tuple[str, object]]]) -> DataFrame:
    """A3: for each named list of (column, criterion), all met: count, sum, average, least and greatest; one pass."""
    tests = {f"_met_{name}": all_criteria([(F.col(c), t) for c, t in pairs]) for name, pairs in criteria.items()}
    rows = df.select(*keys, number(value).alias("_x"), *(test.alias(m) for m, test in tests.items()))  # once a row, not once a figure
    out = []
    for name in criteria:
        met = F.col(f"_met_{name}")
        x = F.when(met, F.col("_x"))
        out += [
            F.count_if(met).alias(f"{name}_count"), F.coalesce(F.sum(x), F.lit(0.0)).alias(f"{name}_sum"), F.try_divide(F.sum(x), F.count(x)).alias(f"{name}_average"),
            F.coalesce(F.min(x), F.lit(0.0)).alias(f"{name}_min"), F.coalesce(F.max(x), F.lit(0.0)).alias(f"{name}_max"),
        ]
    return rows.groupBy(*keys).agg(*out)


def subtotal(df: DataFrame, keys: list[str], value: str, is_subtotal: Column, is_error: Column) -> DataFrame:
    """A3: count and sum without rows that are subtotals themselves, and without errors."""
    own = ~F.coalesce(is_subtotal, F.lit(False)) & ~F.coalesce(is_error, F.lit(False))
    return df.groupBy(*keys).agg(F.count_if(own).alias("rows"), F.coalesce(F.sum(F.when(own, number(value))), F.lit(0.0)).alias("total"))


#: SUBTOTAL's and AGGREGATE's function codes over a group's numbers; those from 101 on are the same without hidden rows.
CODES = {
    1: lambda x, c: F.avg(x), 2: lambda x, c: F.count(x), 3: lambda x, c: F.count(c), 4: lambda x, c: F.coalesce(F.max(x), F.lit(0.0)), 5: lambda x, c: F.coalesce(F.min(x), F.lit(0.0)), 6: lambda x, c: F.coalesce(F.product(x), F.lit(0.0)),
    7: lambda x, c: F.stddev_samp(x), 8: lambda x, c: F.stddev_pop(x), 9: lambda x, c: F.coalesce(F.sum(x), F.lit(0.0)), 10: lambda x, c: F.var_samp(x), 11: lambda x, c: F.var_pop(x), 12: lambda x, c: F.median(x),
}


def subtotal_codes(df: DataFrame, keys: list[str], value: str, codes: list[int], is_subtotal: Column | None = None, is_error: Column | None = None, is_hidden: Column | None = None) -> DataFrame:
    """A3: column ``code_N`` for each function code N of SUBTOTAL and AGGREGATE, in one pass.

    Rows that are subtotals themselves or errors are left out, and for codes from 101
    on hidden ones too. Code 12 (median) holds a group's distinct values.
    """
    given = lambda c: F.lit(False) if c is None else F.coalesce(c, F.lit(False))
    own = ~given(is_subtotal) & ~given(is_error)
    out = []
    for code in codes:
        row = own & ~given(is_hidden) if code > 100 else own
        out.append(CODES[code % 100](F.when(row, number(value)), F.when(row, F.col(value))).cast("double").alias(f"code_{code}"))
    return df.groupBy(*keys).agg(*out)


#: AGGREGATE's codes that ask for a place in a group's order, from k and the number n of values; those left out when out of range.
RANKED = {
    14: lambda n, k: n + 1 - F.ceil(F.lit(float(k))), 15: lambda n, k: F.ceil(F.lit(float(k))), 16: lambda n, k: 1 + (n - 1) * F.lit(float(k)), 17: lambda n, k: 1 + (n - 1) * F.lit(int(k) / 4),
    18: lambda n, k: (n + 1) * F.lit(float(k)), 19: lambda n, k: (n + 1) * F.lit(int(k) / 4),
}


def aggregate_ranked(df: DataFrame, keys: list[str], value: str, codes: list[tuple[int, float | None]], pos: str, leave_out: Column | None = None, spread: bool | None = None) -> DataFrame:
    """A3: AGGREGATE's codes 13 to 19 with their k, columns ``code_N_k`` (a point being ``_``): mode, k-th largest and smallest, percentiles and quartiles.

    Rows that ``leave_out`` holds for (errors, subtotals, hidden ones) are no evidence.
    Code 13 is the most frequent number, the first by ``pos`` of equals. Null where k is
    out of range. Groups without any number give no row.
    """
    own = df if leave_out is None else df.where(~F.coalesce(leave_out, F.lit(False)))
    n = F.col("_total")
    out = []
    for code, k in codes:
        if code != 13:
            place = RANKED[code](n, k)
            inside = (F.max(place) >= 1) & (F.max(place) <= F.max(n))
            out.append(F.when(inside, _between(place)).alias(f"code_{code}_{k}".replace(".", "_")))
    ranked = value_counts(own, keys, value, spread).groupBy(*keys).agg(F.max(n).alias("_n"), *out)
    if all(code != 13 for code, _ in codes):
        return ranked.drop("_n")
    modes = mode_first(own, keys, value, pos).select(*(F.col(c).alias(f"_k_{c}") for c in keys), F.col("mode").alias("code_13"))
    joined = ranked.join(modes, same_keys(keys, "_k_")) if keys else ranked.join(F.broadcast(modes))
    return joined.drop("_n", *(f"_k_{c}" for c in keys))


def value_counts(df: DataFrame, keys: list[str], value: str, spread: bool | None = None) -> DataFrame:
    """(keys, _x, _n, _last, _total): each group's distinct numbers, their counts, the last rank that each takes, and the group's count.

    Counts of a wide group are accumulated by ranges of its numbers, so that no task
    sorts even a group's distinct ones.
    """
    counts = df.select(*keys, number(value).alias("_x")).where("_x is not null").groupBy(*keys, "_x").agg(F.count("*").alias("_n"))
    wide = is_wide(df, keys, spread)
    ranked = running_columns(counts, keys, ["_x"], {"_last": (F.col("_n"), "sum")}, wide)
    if wide:
        return with_totals(ranked, keys, {"_total": F.sum("_n")})
    return ranked.withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))


def _at(place: Column) -> Column:
    """The number of a group's ``value_counts`` at a whole place, as an aggregate."""
    return F.max(F.when((F.col("_last") - F.col("_n") < place) & (F.col("_last") >= place), F.col("_x")))


def _between(place: Column) -> Column:
    """The number at a place, interpolated between its neighbours."""
    low = F.floor(place)
    return _at(low) + (F.max(place) - F.max(low)) * (F.coalesce(_at(low + 1), _at(low)) - _at(low))


def order_stats(df: DataFrame, keys: list[str], value: str, inclusive: list[float], exclusive: list[float], k: list[int], spread: bool | None = None) -> DataFrame:
    """A4: percentiles at (n - 1) p + 1 and at (n + 1) p, k-th largest and smallest; null out of range.

    Works on distinct values with counts, so that a group costs what its distinct
    values do.
    """
    n = F.col("_total")
    out = [_between(1 + (n - 1) * p).alias(f"inc_{round(100 * p)}") for p in inclusive]
    for p in exclusive:
        place = (n + 1) * p
        out.append(F.when((F.max(place) >= 1) & (F.max(place) <= F.max(n)), _between(place)).alias(f"exc_{round(100 * p)}"))
    for i in k:
        out += [_at(n + 1 - i).alias(f"large_{i}"), _at(F.lit(i)).alias(f"small_{i}")]
    return value_counts(df, keys, value, spread).groupBy(*keys).agg(*out)


def mode_first(df: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """A4: the most frequent number, the earliest by ``pos`` of equals; null if none occurs twice; and how many are modal."""
    counts = df.withColumn("_x", number(value)).where("_x is not null").groupBy(*keys, "_x").agg(F.count("*").alias("_n"), F.min(pos).alias("_p"))
    best = F.max_by("_x", F.struct(F.col("_n"), (-F.col("_p")).alias("p")))
    # How many values occur how often, then the top of it: no window over a group's values.
    top = counts.groupBy(*keys, "_n").agg(best.alias("_best"), F.count("*").alias("_same"))
    most = F.max(F.struct("_n", "_best", "_same"))
    return top.groupBy(*keys).agg(most.alias("_m")).select(*keys, F.when(F.col("_m._n") > 1, F.col("_m._best")).alias("mode"), F.when(F.col("_m._n") > 1, F.col("_m._same")).otherwise(0).alias("modes"))


def mode_all(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A4: every modal number of each group that occurs at least twice."""
    counts = df.select(*keys, number(value).alias("_x")).where("_x is not null").groupBy(*keys, "_x").agg(F.count("*").alias("_n"))
    return with_totals(counts, keys, {"_m": F.max("_n")}).where("_n = _m and _n > 1").select(*keys, F.col("_x").alias("mode"), F.col("_n").alias("n"))


def spread_means(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A5: variances, deviations (also with text and false as 0, true as 1), mean absolute deviation, geometric and harmonic mean.

    The two means are null unless all numbers are positive.
    """
    rows = df.select(*keys, F.col(value).alias("_v"), number(value).alias("_x"))
    means = with_totals(rows, keys, {"_mean": F.avg("_x")})
    truth = F.when(F.typeof("_v") == "boolean", F.col("_v").try_cast("double"))
    as_zero = F.when(F.col("_v").isNotNull(), F.coalesce("_x", truth, F.lit(0.0)))
    positive = F.min("_x") > 0
    return means.groupBy(*keys).agg(
        F.var_samp("_x").alias("var_s"), F.var_pop("_x").alias("var_p"), F.stddev_samp("_x").alias("sd_s"), F.stddev_pop("_x").alias("sd_p"),
        F.var_samp(as_zero).alias("var_a"), F.var_pop(as_zero).alias("var_pa"), F.stddev_samp(as_zero).alias("sd_a"), F.stddev_pop(as_zero).alias("sd_pa"), F.avg(F.abs(F.col("_x") - F.col("_mean"))).alias("avedev"),
        (F.var_pop("_x") * F.count("_x")).alias("devsq"), F.when(positive, F.exp(F.avg(F.ln("_x")))).alias("geomean"), F.when(positive, F.try_divide(F.count("_x"), F.sum(F.try_divide(F.lit(1.0), "_x")))).alias("harmean"),
    )


def trim_mean(df: DataFrame, keys: list[str], value: str, fraction: float, spread: bool | None = None) -> DataFrame:
    """A5: mean without floor(n * fraction / 2) values at either end."""
    cut = F.floor(F.col("_total") * fraction / 2)
    low, high = F.greatest(F.col("_last") - F.col("_n"), cut), F.least(F.col("_last"), F.col("_total") - cut)
    kept = F.greatest(high - low, F.lit(0))
    return value_counts(df, keys, value, spread).groupBy(*keys).agg(F.try_divide(F.sum(F.col("_x") * kept), F.sum(kept)).alias("trimmean"))


#: Above this the least common multiple is given as a double; 38 digits are exact before.
EXACT_DIGITS = 38


def prime_powers(x: int) -> list[tuple[int, int]]:
    """(prime, exponent) of a positive whole number, by trial division, then Pollard's rho."""
    found: dict[int, int] = {}

    def put(n: int) -> None:
        if n == 1:
            return
        if _is_prime(n):
            found[n] = found.get(n, 0) + 1
            return
        c = 0
        while True:
            c += 1
            a = b = 2
            d = 1
            while d == 1:
                a, b = (a * a + c) % n, (b * b + c) % n
                b = (b * b + c) % n
                d = math.gcd(abs(a - b), n)
            if d != n:
                put(d)
                put(n // d)
                return

    for p in range(2, 200):
        while x % p == 0:
            found[p] = found.get(p, 0) + 1
            x //= p
    put(x)
    return sorted(found.items())


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test with bases that are certain below 2 ** 64."""
    bases = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)
    if n < 2 or any(n % p == 0 for p in bases):
        return n in bases
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in bases:
        x = pow(a, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def _factors(xs: pd.Series) -> pd.Series:
    """Prime powers of each number, and 1 as a factor that all have."""
    return xs.map(lambda x: [{"p": p, "e": e} for p, e in [*prime_powers(int(x)), (1, 1)]])


def gcd_lcm(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Greatest common divisor and least common multiple of a group's positive whole numbers.

    Distinct numbers are split into prime powers; a group's highest power of each prime
    makes the multiple, the lowest of those that all numbers share the divisor: partial
    aggregations, no task holds a group. The multiple is exact to 38 digits, then a
    double, and null (a number error) beyond the largest double.
    """
    x = number(value)
    # Whole types keep all their digits.
    wanted = F.when(F.typeof(value).isin("tinyint", "smallint", "int", "bigint"), F.col(value).try_cast("long")).otherwise(F.when((x > 0) & (x < 2.0**63), F.floor(x).cast("long")))
    distinct = df.select(*keys, wanted.alias("_x")).where("_x > 0").distinct()
    powers = distinct.select(*keys, F.explode(F.pandas_udf(_factors, "array<struct<p:bigint,e:int>>")("_x")).alias("_f")).groupBy(*keys, F.col("_f.p").alias("_p")).agg(F.max("_f.e").alias("_high"), F.min("_f.e").alias("_low"), F.count("*").alias("_c"))
    # Each number has 1 as a factor too: the group's count of it is that of its numbers.
    sizes = {"_n": F.max(F.when(F.col("_p") == 1, F.col("_c"))), "_digits": F.sum(F.col("_high") * F.log10("_p"))}
    sized = with_totals(powers, keys, sizes)
    parts = lambda test, power: F.collect_list(F.when(test & (F.col("_p") > 1), F.struct("_p", F.col(power).alias("e"))))
    # Lists of bounded length: fewer than 38 primes, and at most 15 of a number below 2 ** 63.
    exact, shared = F.col("_digits") < EXACT_DIGITS - 1, F.col("_c") == F.col("_n")
    about = F.product(F.when(F.col("_digits") < 308.25, F.pow("_p", "_high")))
    grouped = sized.groupBy(*keys).agg(F.max("_digits").alias("_digits"), about.alias("_about"), parts(exact, "_high").alias("_lcm"), parts(shared, "_low").alias("_gcd"))
    times = lambda a, f: F.aggregate(F.array_repeat(f["_p"], f["e"]), a, lambda b, p: (b * p.cast("decimal(19,0)")).cast("decimal(38,0)"))
    whole = lambda c: F.aggregate(c, F.lit(1).cast("decimal(38,0)"), times)
    lcm = F.when(exact, whole("_lcm").cast("double")).when(F.abs("_about") < float("inf"), F.col("_about"))
    return grouped.select(*keys, whole("_gcd").cast("long").alias("gcd"), lcm.alias("lcm"))


def bivariate(df: DataFrame, keys: list[str], y: str, x: str) -> DataFrame:
    """Correlation, covariances and the least-squares line of y on x, of pairs that are both numbers."""
    y, x = number(y), number(x)
    y, x = F.when(x.isNotNull(), y), F.when(y.isNotNull(), x)
    correl = F.try_divide(F.covar_pop(y, x), F.stddev_pop(y) * F.stddev_pop(x))  # null where either is the same throughout
    return df.groupBy(*keys).agg(
        correl.alias("correl"), F.covar_pop(y, x).alias("covar_p"), F.covar_samp(y, x).alias("covar_s"),
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.when(F.var_pop(y) > 0, F.regr_r2(y, x)).alias("rsq"),
    )


def bool_agg(df: DataFrame, keys: list[str], test: Column) -> DataFrame:
    """All, any, and an odd number of true cells."""
    return df.groupBy(*keys).agg(F.bool_and(test).alias("all_true"), F.bool_or(test).alias("any_true"), (F.count_if(test) % 2 == 1).alias("odd_true"))


#: Characters that a cell holds.
CELL_CHARS = 32_767
TOO_LONG = "#VALUE!"


def text_agg(df: DataFrame, keys: list[str], value: str, pos: str, delimiter: str, skip_empty: bool = True, cell_chars: int | None = CELL_CHARS) -> DataFrame:
    """A group's texts in order of ``pos`` joined, and as an array's text; empty ones skipped, or kept as "".

    A text longer than ``cell_chars``, what a cell holds, is the error ``#VALUE!``. Lengths
    are summed first, so that only groups that fit are brought together: 32,767 texts at
    most, or one more where empty ones are joined by a delimiter. If it is None, texts are
    whole, whatever their length: ranges of (keys, ``pos``) are joined each for itself,
    then a group's ranges.
    """
    text = F.col(value).cast("string")
    rows = df.select(*keys, F.col(pos).alias("_at"), (F.when(text != "", text) if skip_empty else F.coalesce(text, F.lit(""))).alias("_text"))
    if cell_chars is None:
        return _whole_text(rows, keys, delimiter)
    sized = with_totals(rows, keys, {"_chars": F.coalesce(F.sum(F.length("_text")), F.lit(0)), "_texts": F.count("_text")})
    long = lambda between, around: F.col("_chars") + F.greatest(F.col("_texts") - 1, F.lit(0)) * len(between) + around > cell_chars
    listed = F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull() & ~long(delimiter[:1] if skip_empty else delimiter, 0), F.struct("_at", "_text"))))
    grouped = sized.groupBy(*keys).agg(listed.alias("_listed"), F.max("_chars").alias("_chars"), F.max("_texts").alias("_texts"))
    texts = F.transform("_listed", lambda s: s["_text"])
    joined = F.when(long(delimiter, 0), TOO_LONG).otherwise(F.array_join(texts, delimiter))
    quoted = F.when(long('","', 4), TOO_LONG).otherwise(F.concat(F.lit('{"'), F.array_join(texts, '","'), F.lit('"}')))
    return grouped.select(*keys, joined.alias("joined"), quoted.alias("array_text"))


def _whole_text(rows: DataFrame, keys: list[str], delimiter: str) -> DataFrame:
    """``text_agg`` without a limit, of rows (keys, _at, _text): only a group's joined text is held in one row."""
    ranged = rows.repartitionByRange(*keys, "_at", "_text").withColumn("_range", F.spark_partition_id())
    listed = F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("_at", "_text"))))
    parts = ranged.groupBy(*keys, "_range").agg(listed.alias("_listed")).withColumn("_texts", F.transform("_listed", lambda s: s["_text"]))
    parts = parts.select(*keys, F.when(F.size("_texts") > 0, F.struct("_range", *(F.array_join("_texts", d).alias(c) for c, d in (("joined", delimiter), ("quoted", '","'))))).alias("_part"))
    grouped = parts.groupBy(*keys).agg(F.array_sort(F.collect_list("_part")).alias("_parts"))
    whole = lambda c, d: F.array_join(F.transform("_parts", lambda p: p[c]), d)
    return grouped.select(*keys, whole("joined", delimiter).alias("joined"), F.concat(F.lit('{"'), whole("quoted", '","'), F.lit('"}')).alias("array_text"))


def linear_predict(df: DataFrame, keys: list[str], y: str, x: str, at: list[float]) -> DataFrame:
    """A10: a group's line at given places, and the exponential curve fitted through ln y, of pairs that are both numbers."""
    y, x = number(y), number(x)
    line = df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"),
        F.regr_slope(F.ln(y), x).alias("_d"), F.regr_intercept(F.ln(y), x).alias("_c"),
    )
    return line.withColumn("x", F.explode(F.array(*map(F.lit, at)))).select(*keys, "x", (F.col("_a") + F.col("_b") * F.col("x")).alias("linear"), F.exp(F.col("_c") + F.col("_d") * F.col("x")).alias("growth"))


def ets_forecast(df: DataFrame, keys: list[str], order: str, value: str, alpha: float = 0.9, beta: float = 0.2) -> DataFrame:
    """Next value of each series by Holt's linear smoothing with given parameters, and the mean absolute error of one-step forecasts.

    A fold over the series, sorted in its row, without Python; what is no number is
    skipped. ``smoothing`` fits parameters and seasons.
    """
    series = df.where(number(value).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("t"), number(value).alias("v")))).alias("s")).where(F.size("s") >= 2)
    v = lambda i: F.get("s", F.lit(i))["v"]
    start = F.struct(v(1).alias("level"), (v(1) - v(0)).alias("trend"), F.lit(0.0).alias("err"))

    def step(acc: Column, s: Column) -> Column:
        guess = acc["level"] + acc["trend"]
        level = alpha * s["v"] + (1 - alpha) * guess
        trend = beta * (level - acc["level"]) + (1 - beta) * acc["trend"]
        return F.struct(level.alias("level"), trend.alias("trend"), (acc["err"] + F.abs(s["v"] - guess)).alias("err"))

    fitted = F.aggregate(F.slice("s", F.lit(3), F.greatest(F.size("s") - 2, F.lit(0))), start, step)
    return series.withColumn("f", fitted).select(*keys, F.size("s").alias("points"), (F.col("f.level") + F.col("f.trend")).alias("forecast"), F.try_divide(F.col("f.err"), F.size("s") - 2).alias("mean_error"))


def loan_schedule(df: DataFrame, rate: str, periods: str, principal: str) -> DataFrame:
    """A row per period of each loan: interest, principal part and balance, from closed forms; none for less than one period."""
    df = df.where(F.col(periods) >= 1)
    r, n, p = F.col(rate), F.col(periods), F.col(principal)
    payment = F.when(r == 0, p / n).otherwise(p * r / (1 - F.pow(1 + r, -n)))
    k = F.col("period")
    balance = lambda t: F.when(r == 0, p - payment * t).otherwise(p * F.pow(1 + r, t) - payment * (F.pow(1 + r, t) - 1) / r)
    rows = df.withColumn("payment", payment).withColumn("period", F.explode(F.sequence(F.lit(1), n.cast("int"))))
    return rows.withColumn("interest", balance(k - 1) * r).withColumn("principal_part", F.col("payment") - F.col("interest")).withColumn("balance", balance(k))


def npv(df: DataFrame, keys: list[str], rate: float, value: str, pos: str, day: str, spread: bool | None = None) -> DataFrame:
    """Net present value by place (from 1) and by days since the first flow; what is no number takes no place."""
    wide = is_wide(df, keys, spread)
    flows = df.select(*keys, F.col(pos).alias("_at"), F.col(day).alias("_day"), number(value).alias("_v")).where("_v is not null")
    rows = _with_first(running_columns(flows, keys, ["_at"], {"_k": (F.lit(1), "count")}, wide), keys, wide)
    worth = lambda t: F.sum(F.col("_v") / F.pow(F.lit(1 + rate), t))
    return rows.groupBy(*keys).agg(worth(F.col("_k")).alias("npv"), worth(F.datediff("_day", "_first") / 365).alias("xnpv"))


def _with_first(flows: DataFrame, keys: list[str], wide: bool) -> DataFrame:
    """``flows`` with their group's first ``_day`` as ``_first``."""
    return with_totals(flows, keys, {"_first": F.min("_day")}) if wide else flows.withColumn("_first", F.min("_day").over(Window.partitionBy(*keys)))


#: Ranges of rates that are looked at, the first in which the worth changes its sign.
RATE_RANGES = ((-0.9, 1.0), (-0.99, 10.0), (-0.999999, 1e9))
#: Parts into which a range is cut in each round, and rounds: a range of rates shrinks by 2 ** 50.
PARTS, ROUNDS = 32, 10


def irr(df: DataFrame, keys: list[str], value: str, pos: str, days: bool = True, spread: bool | None = None) -> DataFrame:
    """The rate at which a group's flows are worth nothing; column ``xirr`` for dated flows, ``irr`` for one flow a period.

    ``pos`` is a date if ``days``, else the order of the flows; what is no number takes
    no period. All groups are searched at once: flows of a day are summed, then each
    round is one partial aggregation of the worth at the inner edges of every group's
    range, of which the first part with a change of sign is the next. Null if there is
    none in the widest range.
    """
    flows = df.select(*keys, F.col(pos).alias("_day"), number(value).alias("_v")).where("_v is not null")
    wide = is_wide(flows, keys, spread)
    if days:
        placed = _with_first(flows, keys, wide).withColumn("_t", F.datediff("_day", "_first") / F.lit(365.0))
    else:
        placed = running_columns(flows, keys, ["_day"], {"_k": (F.lit(1), "count")}, wide).withColumn("_t", (F.col("_k") - 1).cast("double"))
    placed = materialize(placed.groupBy(*keys, "_t").agg(F.sum("_v").alias("_v")))
    worth = lambda y: F.sum(F.col("_v") * F.exp(-F.col("_t") * y))  # noqa: E731  y = ln(1 + rate)
    edge = lambda r: F.lit(math.log1p(r))
    found = placed.groupBy(*keys).agg(*(worth(edge(r)).alias(f"_w{i}{j}") for i, ends in enumerate(RATE_RANGES) for j, r in enumerate(ends)))
    pick = F.lit(None).cast("struct<low:double,high:double,at_low:double>")
    for i, (low, high) in reversed(list(enumerate(RATE_RANGES))):
        pick = F.when(F.col(f"_w{i}0") * F.col(f"_w{i}1") < 0, F.struct(edge(low).alias("low"), edge(high).alias("high"), F.signum(f"_w{i}0").alias("at_low"))).otherwise(pick)
    found = materialize(found.select(*keys, pick.alias("_r")))
    everyone = found.select(*keys)
    for _ in range(ROUNDS):
        state = found.where("_r is not null").withColumnsRenamed({k: f"_k_{k}" for k in keys})
        joined = placed.join(state, same_keys(keys, "_k_")) if keys else placed.join(F.broadcast(state))
        point = lambda j: F.col("_r.low") + (F.col("_r.high") - F.col("_r.low")) * (j / PARTS)
        worths = joined.groupBy(*keys, "_r").agg(*(worth(point(j)).alias(f"_w{j}") for j in range(1, PARTS)))
        part = lambda j: F.struct(point(j).alias("low"), point(j + 1).alias("high"), F.col("_r.at_low").alias("at_low"))
        pick = part(PARTS - 1)
        for j in range(PARTS - 1, 0, -1):
            pick = F.when(F.col(f"_w{j}") * F.col("_r.at_low") <= 0, part(j - 1)).otherwise(pick)
        found = materialize(worths.select(*keys, pick.alias("_r")))
    rate = F.expm1((F.col("_r.low") + F.col("_r.high")) / 2).alias("xirr" if days else "irr")
    if not keys:
        return everyone.join(F.broadcast(found), how="left").select(rate)
    known = found.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return everyone.join(known, same_keys(keys, "_k_"), "left").select(*keys, rate)


def distinct_if(df: DataFrame, keys: list[str], value: str, test: Column) -> DataFrame:
    """Distinct values, of all rows and of those that meet a test."""
    return df.groupBy(*keys).agg(F.countDistinct(value).alias("n_distinct"), F.countDistinct(F.when(test, F.col(value))).alias("n_distinct_if"))


#: Bits of a sketch's registers: an estimate's relative standard error is 1.04 / 2 ** (bits / 2), 0.8 % here.
SKETCH_BITS = 14


def distinct_sketches(df: DataFrame, keys: list[str], value: str, bits: int = SKETCH_BITS) -> DataFrame:
    """A HyperLogLog sketch of each group's different values as column ``sketch``, to be stored and merged later; null values aren't counted."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), bits).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Estimated numbers of different values of coarser groups, from stored sketches."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about_distinct"))


def weighted(df: DataFrame, keys: list[str], value: str, weight: str, mask: Column) -> DataFrame:
    """Sum of products, weighted mean, and the sum over masked rows; what is no number counts as nothing."""
    x, w = number(value), number(weight)
    products = F.sum(x * w)
    return df.groupBy(*keys).agg(products.alias("sumproduct"), F.try_divide(products, F.sum(F.when(x.isNotNull(), w))).alias("weighted_mean"), F.coalesce(F.sum(F.when(mask, x)), F.lit(0.0)).alias("masked_sum"))
