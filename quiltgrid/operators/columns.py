"""Column jobs (C1 to C22, Q1): scalar families applied over whole tables, without Python functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgrid.functions.numbers import number
from quiltgrid.functions.units import UNITS
from quiltgrid.functions.values import ERROR_CODES, ERROR_NUMBERS


def derive(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """The kept columns and the derived ones, in one projection."""
    return df.select(*keep, *(c.alias(n) for n, c in columns.items()))


def profile(df: DataFrame, *columns: str) -> DataFrame:
    """A row per column: rows, nulls and distinct values (approximate)."""
    stats = df.agg(F.count("*").alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)), *(F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(columns)))
    return stats.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"n_{i}").alias("nulls"), F.col(f"d_{i}").alias("distinct")) for i, c in enumerate(columns)))))


def first_true(branches: list[tuple[Column, object]], default=None) -> Column:
    """IF and IFS: the value of the first true test; null (or the default) if none is."""
    out = F.lit(default)
    for test, value in reversed(branches):
        out = F.when(test, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def switch(value: Column, cases: dict, default=None) -> Column:
    """SWITCH: the value of the first equal case."""
    return first_true([(value == k, v) for k, v in cases.items()], default)


def if_error(value: Column, error: Column, alternative) -> Column:
    """IFERROR: the alternative where there is any error code."""
    return F.when(error.isNull(), value).otherwise(alternative)


def if_na(value: Column, error: Column, alternative) -> Column:
    """IFNA: the alternative only for #N/A."""
    return F.when(F.coalesce(error, F.lit("")) == "#N/A", alternative).otherwise(value)


def kind_of(text: Column) -> Column:
    """What a cell's text is: blank, number, bool, error or text."""
    return (
        F.when(text.isNull(), "blank").when(text.try_cast("double").isNotNull(), "number")
        .when(F.upper(text).isin("TRUE", "FALSE"), "bool").when(text.isin(*ERROR_CODES), "error").otherwise("text")
    )


def type_number(text: Column) -> Column:
    """TYPE: 1 number or blank, 2 text, 4 boolean, 16 error."""
    return switch(kind_of(text), {"blank": 1, "number": 1, "bool": 4, "error": 16}, 2)


def error_number(text: Column) -> Column:
    """ERROR.TYPE: the number of an error code; null for anything else."""
    return switch(text, ERROR_NUMBERS)


def as_n(text: Column) -> Column:
    """N: a number as it is, true as 1, anything else as 0."""
    return F.when(F.upper(text) == "TRUE", 1.0).otherwise(F.coalesce(text.try_cast("double"), F.lit(0.0)))


def type_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cells of each kind, and odd and even numbers, per column; one pass."""
    kinds = ("blank", "number", "bool", "error", "text")
    aggs = []
    for i, c in enumerate(columns):
        text = F.col(c).cast("string")
        whole = F.floor(F.abs(text.try_cast("double")))
        aggs += [F.count_if(kind_of(text) == k).alias(f"{k}_{i}") for k in kinds]
        aggs += [F.count_if(whole % 2 == 1).alias(f"odd_{i}"), F.count_if(whole % 2 == 0).alias(f"even_{i}")]
    rows = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"{k}_{i}").alias(k) for k in (*kinds, "odd", "even"))) for i, c in enumerate(columns)))
    return df.agg(*aggs).select(F.inline(rows))


def workday_calendar(spark, first: str, last: str, holidays: DataFrame | None = None, weekend: str = "0000011") -> DataFrame:
    """(day, n): days of a range with the number of workdays up to each.

    ``weekend`` has a 1 for each day off from Monday. A row per day: small whatever
    the data, so that its one window is too.
    """
    days = spark.sql("select explode(sequence(to_date(:a), to_date(:b))) as day", args={"a": first, "b": last})
    off = F.substring(F.lit(weekend), F.weekday("day") + 1, F.lit(1)) == "1"
    if holidays is not None:
        days = days.join(holidays.select(F.col(holidays.columns[0]).cast("date").alias("day")).distinct().withColumn("_h", F.lit(True)), "day", "left")
        off = off | F.col("_h").isNotNull()
    return days.select("day", (~off).cast("int").alias("works")).withColumn("n", F.sum("works").over(Window.orderBy("day")))


def network_days(df: DataFrame, start: str, end: str, calendar: DataFrame, name: str = "network_days") -> DataFrame:
    """Workdays from start to end, both included; negative if reversed; null outside the calendar."""
    at = lambda c, n: calendar.select(F.col("day").alias(c), F.col("n").alias(n), F.col("works").alias(f"{n}_w"))
    rows = df.join(at("_s", "_sn"), F.col(start).cast("date") == F.col("_s"), "left").join(at("_e", "_en"), F.col(end).cast("date") == F.col("_e"), "left")
    forward = F.col("_en") - F.col("_sn") + F.col("_sn_w")
    backward = -(F.col("_sn") - F.col("_en") + F.col("_en_w"))
    return rows.withColumn(name, F.when(F.col("_e") >= F.col("_s"), forward).otherwise(backward)).drop("_s", "_sn", "_sn_w", "_e", "_en", "_en_w")


def workday_shift(df: DataFrame, start: str, n: int, calendar: DataFrame, name: str = "workday") -> DataFrame:
    """The n-th workday after a date (before it, if negative)."""
    works = calendar.where("works = 1").select(F.col("day").alias(name), F.col("n").alias("_to"))
    at = calendar.select(F.col("day").alias("_s"), (F.col("n") + n + (F.lit(1) - F.col("works") if n < 0 else F.lit(0))).alias("_to"))
    return df.join(at, F.col(start).cast("date") == F.col("_s"), "left").join(works, "_to", "left").drop("_s", "_to")


def by_row(columns: list[Column], fold, zero: Column) -> Column:
    """BYROW: a fold over a row's cells."""
    return F.aggregate(F.array(*columns), zero, fold)


def by_column(df: DataFrame, columns: list[str], agg) -> DataFrame:
    """BYCOL: an aggregate of each column."""
    return df.agg(*(agg(c).alias(c) for c in columns))


def make_array(rows: int, columns: int, cell) -> Column:
    """MAKEARRAY: cells computed from row and column numbers from 1."""
    return F.transform(F.sequence(F.lit(1), F.lit(rows)), lambda r: F.transform(F.sequence(F.lit(1), F.lit(columns)), lambda c: cell(r, c)))


def convert_units(df: DataFrame, value: str, source: str, target: str, name: str = "converted") -> DataFrame:
    """CONVERT where the units are columns too; null between dimensions and for names that are no unit.

    The table of units, which is fixed, is joined for each side.
    """
    units = df.sparkSession.createDataFrame([(u, *v) for u, v in UNITS.items()], "_unit string, _dim string, _size double, _zero double")
    side = lambda mark: F.broadcast(units.withColumnsRenamed({c: f"{c}_{mark}" for c in units.columns}))
    both = df.join(side("a"), F.col(source) == F.col("_unit_a"), "left").join(side("b"), F.col(target) == F.col("_unit_b"), "left")
    x = (number(value) * F.col("_size_a") + F.col("_zero_a") - F.col("_zero_b")) / F.col("_size_b")
    return both.withColumn("_x", F.when(F.col("_dim_a") == F.col("_dim_b"), x)).select(*df.columns, F.col("_x").alias(name))


def random_of(seed: int, *key: Column) -> Column:
    """A number in [0, 1) that the key and the seed decide: equal in every run, whatever the partitions.

    52 bits of the MD5 of the seed and the key's parts, each with its length.
    """
    part = lambda c: F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    digest = F.md5(F.concat(F.lit(f"{seed}|"), *map(part, key)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def random_columns(df: DataFrame, key: list[str], seed: int, low: int, high: int) -> DataFrame:
    """C20: RAND and RANDBETWEEN of each row, decided by its key and the seed; rows of equal key get equal numbers."""
    rand = lambda s: random_of(s, *map(F.col, key))
    return df.withColumns({"rand": rand(seed), "rand_between": (F.floor(rand(seed + 1) * (high - low + 1)) + low).cast("long")})


def random_array(df: DataFrame, key: list[str], rows: int, columns: int, seed: int, low: float = 0.0, high: float = 1.0, whole: bool = False, name: str = "random") -> DataFrame:
    """C20: RANDARRAY: an array of ``rows`` rows of ``columns`` numbers from low to high for each row of ``df``, decided by its key, the cell and the seed."""
    if rows < 1 or columns < 1 or low > high:
        raise ValueError("RANDARRAY asks for one row and one column at least, and low not above high")
    x = lambda r, c: random_of(seed, *map(F.col, key), r, c)
    cell = (lambda r, c: (F.floor(x(r, c) * (high - low + 1)) + low).cast("long")) if whole else (lambda r, c: x(r, c) * (high - low) + low)
    return df.withColumn(name, make_array(rows, columns, cell))


def random_pick(df: DataFrame, keys: list[str], item: list[str], seed: int, n: int = 1) -> DataFrame:
    """C20: ``n`` rows of each group at random: those of the least numbers, decided by the columns ``item`` and the seed.

    One row is a partial aggregation; several are a top-n, which Spark cuts in each task
    before the shuffle. Every row has the same chance; rows of equal item share a number.
    """
    rows = df.withColumn("_r", random_of(seed, *map(F.col, [*keys, *item])))
    if n == 1:
        rest = [c for c in df.columns if c not in keys]
        return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("_r", *item)).alias("_best")).select(*keys, *(F.col(f"_best.{c}").alias(c) for c in rest))
    order = Window.partitionBy(*keys).orderBy("_r", *item)
    return rows.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= n).drop("_r", "_nth")


def sum_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def sql_query(df: DataFrame, name: str, text: str) -> DataFrame:
    """Q1: SQL over a table under a name, in the table's own session."""
    return df.sparkSession.sql(text, **{name: df})
