"""Window operators (W1 to W10) over a group's rows in a stated order.

Ranks, running figures, lags and fills of groups larger than a task may scan go by ranges
(``scans``); ``spread`` forces either way. What isn't a number is skipped, as cells with
text are. ``keys`` may be empty for one group of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgrid.operators.aggregates import number
from quiltgrid.operators.scans import is_wide, running_columns, same_keys, with_totals


def rank_rows(df: DataFrame, keys: list[str], value: str, pos: str, ascending: bool = False, spread: bool | None = None) -> DataFrame:
    """Rank with ties equal, with ties averaged, and unique by ``pos``.

    A wide group's rows are numbered by ranges; equal values take the least of their numbers.
    """
    by = F.col(value).asc() if ascending else F.col(value).desc()
    if is_wide(df, keys, spread):
        placed = running_columns(df, keys, [by, pos], {"rank_unique": (F.lit(1), "count")}, True)
        tied = with_totals(placed, [*keys, value], {"_least": F.min("rank_unique"), "_twins": F.count("*")})
        return tied.withColumns({"rank_eq": F.col("_least"), "rank_avg": F.col("_least") + (F.col("_twins") - 1) / 2}).select(*df.columns, "rank_eq", "rank_avg", "rank_unique")
    order = Window.partitionBy(*keys).orderBy(by)
    equal = F.rank().over(order)
    twins = F.count("*").over(Window.partitionBy(*keys, value))
    return df.withColumns({"rank_eq": equal, "rank_avg": equal + (twins - 1) / 2, "rank_unique": F.row_number().over(Window.partitionBy(*keys).orderBy(by, F.col(pos)))})


def percent_rank_at(df: DataFrame, keys: list[str], value: str, digits: int = 3, spread: bool | None = None) -> DataFrame:
    """Share of the group's numbers below a row's, digits cut off; and the variant over n + 1; null where there is no number.

    Ranks are those of a group's distinct numbers with their counts, joined back: no
    task sorts a group's rows.
    """
    cut = lambda x: F.floor(x * 10**digits + 1e-9) / 10**digits
    own = df.withColumn("_x", number(value))
    counts = own.where("_x is not null").groupBy(*keys, "_x").agg(F.count("*").alias("_c"))
    ranked = running_columns(counts, keys, ["_x"], {"_upto": (F.col("_c"), "sum")}, is_wide(df, keys, spread))
    ranked = with_totals(ranked, keys, {"_n": F.sum("_c")})
    n, below = F.col("_n"), F.col("_upto") - F.col("_c")
    ranks = {"rank_inc": F.when(n > 1, cut(below / (n - 1))).otherwise(1.0), "rank_exc": cut((below + 1) / (n + 1))}
    ranked = ranked.withColumns(ranks).select(*(F.col(c).alias(f"_of_{c}") for c in [*keys, "_x"]), *ranks)
    return own.join(ranked, same_keys([*keys, "_x"], "_of_"), "left").select(*df.columns, *ranks)


def percent_rank_of(df: DataFrame, keys: list[str], value: str, x: float, digits: int = 3) -> DataFrame:
    """Place of any number among a group's, interpolated between its neighbours; null outside; 1 for the only number."""
    v, d = number(value), F.lit(float(x))
    low, high = F.max(F.when(v <= d, v)), F.min(F.when(v >= d, v))
    below_low, below_high = F.count_if(v < d), F.count_if(v <= d)
    grouped = df.groupBy(*keys).agg(low.alias("_l"), high.alias("_h"), below_low.alias("_b"), below_high.alias("_c"), F.count(v).alias("_n"))
    place = F.when(F.col("_l") == F.col("_h"), F.col("_b")).otherwise(F.col("_c") - 1 + (d - F.col("_l")) / (F.col("_h") - F.col("_l")))
    share = F.when((F.col("_n") == 1) & (F.col("_l") == F.col("_h")), F.lit(1.0)).otherwise(F.try_divide(place, F.col("_n") - 1))
    return grouped.select(*keys, (F.floor(share * 10**digits + 1e-9) / 10**digits).alias("percent_rank"))


def running(df: DataFrame, keys: list[str], value: str, pos: str, spread: bool | None = None) -> DataFrame:
    """Running sum, count of the same value, maximum and share of the total, null of a total of 0."""
    wide, x = is_wide(df, keys, spread), number(value)
    out = running_columns(df, keys, [pos], {"running_sum": (x, "sum"), "running_max": (x, "max")}, wide)
    out = running_columns(out, [*keys, value], [pos], {"running_count": (F.lit(1), "count")}, wide)
    out = _with_sum(out, keys, x, wide).withColumn("running_share", F.try_divide("running_sum", "_total"))
    return out.select(*df.columns, "running_sum", "running_count", "running_max", "running_share")


def _with_sum(df: DataFrame, keys: list[str], x: Column, wide: bool) -> DataFrame:
    """``df`` with its group's sum as ``_total``."""
    return with_totals(df, keys, {"_total": F.sum(x)}) if wide else df.withColumn("_total", F.sum(x).over(Window.partitionBy(*keys)))


def scan(df: DataFrame, keys: list[str], pos: str, value: Column, how: str, spread: bool | None = None) -> DataFrame:
    """A running fold of all rows of the group up to each row: sum, product, count, min, max or last."""
    return running_columns(df, keys, [pos], {"scan": (value, how)}, spread)


def row_change(df: DataFrame, keys: list[str], value: str, pos: str, spread: bool | None = None) -> DataFrame:
    """Difference and relative change from the previous row; null on the first, after 0, or where either is no number."""
    rows, x = running_columns(df, keys, [pos], {"_before": (number(value), "lag")}, spread), number(value)
    change = {"difference": x - F.col("_before"), "change": F.try_divide(x - F.col("_before"), F.col("_before"))}
    return rows.withColumns(change).drop("_before")


def fill_down(df: DataFrame, keys: list[str], value: str, pos: str, spread: bool | None = None) -> DataFrame:
    """The last value that is not blank (null or "")."""
    return running_columns(df, keys, [pos], {"filled": (F.when(F.col(value).cast("string") != "", F.col(value)), "last")}, spread)


def normalize(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Z-score and position between the least and the greatest value.

    A group's four figures are aggregated and joined back: no task holds a group.
    """
    facts = df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_sd"), F.min(value).alias("_low"), F.max(value).alias("_high"))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    rows = df.join(facts.withColumnsRenamed({k: f"_key_{k}" for k in keys}) if keys else F.broadcast(facts), same or None)
    x = F.col(value)
    rows = rows.withColumns({"z_score": F.try_divide(x - F.col("_mean"), F.col("_sd")), "scaled": F.try_divide(x - F.col("_low"), F.col("_high") - F.col("_low"))})
    return rows.select(*df.columns, "z_score", "scaled")


def share_of_total(df: DataFrame, keys: list[str], value: str, pos: str, spread: bool | None = None) -> DataFrame:
    """Share of the group's sum, and the cumulative share in order of ``pos``; null of a sum of 0."""
    wide, x = is_wide(df, keys, spread), number(value)
    rows = _with_sum(running_columns(df, keys, [pos], {"_upto": (x, "sum")}, wide), keys, x, wide)
    return rows.withColumns({"share": F.try_divide(x, F.col("_total")), "cumulative_share": F.try_divide("_upto", "_total")}).drop("_upto", "_total")


def last_n_agg(df: DataFrame, keys: list[str], value: str, pos: str, n: int, every: int, spread: bool | None = None) -> DataFrame:
    """Mean of each group's last ``n`` values, and the sum of every ``every``-th row from the first."""
    wide = is_wide(df, keys, spread)
    rows = running_columns(df, keys, [pos], {"_k": (F.lit(1), "count")}, wide)
    rows = with_totals(rows, keys, {"_n": F.count("*")}) if wide else rows.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    x = number(value)
    last = F.when(F.col("_n") - F.col("_k") < n, x)
    return rows.groupBy(*keys).agg(F.avg(last).alias("last_mean"), F.sum(F.when((F.col("_k") - 1) % every == 0, x)).alias("every_sum"))


def flag_duplicates(df: DataFrame, value: str, pos: str) -> DataFrame:
    """Whether a row's value occurs more than once, and the first place where it does.

    Counts are aggregated and joined back, so that a frequent value is not one
    task's window.
    """
    seen = df.groupBy(value).agg(F.count("*").alias("_n"), F.min(pos).alias("first_pos"))
    joined = df.join(seen.withColumnRenamed(value, "_v"), F.col(value).eqNullSafe(F.col("_v")))
    return joined.withColumn("is_duplicate", F.col("_n") > 1).drop("_v", "_n")


def position_of_max(df: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """The greatest number and where it first is; null where there is none."""
    x = number(value)
    first = F.when(x.isNotNull(), F.struct((-x).alias("v"), F.col(pos).alias("p")))
    return df.groupBy(*keys).agg(F.max(x).alias("max_value"), F.min_by(pos, first).alias("max_pos"))


def top_n(df: DataFrame, keys: list[str], value: str, pos: str, n: int) -> DataFrame:
    """Each group's ``n`` largest values, largest first, with their sum and mean."""
    order = Window.partitionBy(*keys).orderBy(F.col(value).desc(), F.col(pos))
    best = df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
    group = Window.partitionBy(*keys)
    total = F.sum(value).over(group)
    return best.withColumns({"top_sum": total, "top_mean": total / F.count("*").over(group)})
