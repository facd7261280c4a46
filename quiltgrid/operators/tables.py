"""Table operators (T1 to T12): filter, sort and reshape, with an explicit row order ``pos``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgrid.session import materialize


def numbered(df: DataFrame, order: list, name: str = "row_no") -> DataFrame:
    """``df`` with gapless row numbers from 1 in an order over all rows, without one task holding them.

    Rows are dealt out in ranges of the order; a range's rows are numbered in its
    task and shifted by the counts of the ranges before, one row for each.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    ranged = materialize(ranged)  # both reads below must see the same ranges
    counts = ranged.groupBy(F.shiftright("_id", 33).alias("_p")).agg(F.count("*").alias("_n"))
    starts = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_s"))
    # One row per partition of the sort, whatever the number of rows.
    out = ranged.withColumn("_p", F.shiftright("_id", 33)).join(F.broadcast(starts), "_p")
    return out.withColumn(name, F.col("_s") + F.col("_id").bitwiseAND((1 << 33) - 1) + 1).drop("_p", "_s", "_id")


def unique_rows(df: DataFrame, by: list[str], pos: str, exactly_once: bool = False) -> DataFrame:
    """Distinct rows with the first place of each; or those that occur once only."""
    out = df.groupBy(*by).agg(F.min(pos).alias("first_pos"), F.count("*").alias("n"))
    return out.where("n = 1") if exactly_once else out


def sort_table(df: DataFrame, by: list[tuple[str, int]], pos: str) -> DataFrame:
    """Stable sort by columns with directions 1 or -1."""
    return df.orderBy(*(F.col(c).asc() if way > 0 else F.col(c).desc() for c, way in by), pos)


def to_column(df: DataFrame, columns: list[str], pos: str) -> DataFrame:
    """(row, column number, value) of each cell, row by row."""
    cells = F.posexplode(F.array(*(F.col(c).cast("string") for c in columns))).alias("column_no", "value")
    return df.select(F.col(pos).alias("row_pos"), cells)


def wrap_rows(df: DataFrame, value: str, place: Column, width: int) -> DataFrame:
    """A list in ``place`` order (from 0) as rows of ``width`` cells c0, c1, ..."""
    return df.groupBy(F.floor(place / width).alias("row_no")).agg(*(F.max(F.when(place % width == i, F.col(value))).alias(f"c{i}") for i in range(width)))


def wrap_columns(df: DataFrame, value: str, place: Column, height: int, width: int) -> DataFrame:
    """A list in ``place`` order (from 0) down columns of ``height`` cells."""
    return df.groupBy((place % height).alias("row_no")).agg(*(F.max(F.when(F.floor(place / height) == i, F.col(value))).alias(f"c{i}") for i in range(width)))


def unique_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """T1 by column: the first of each set of columns that are equal in all rows, by digests of each cell and its row's place in one pass."""
    place = F.monotonically_increasing_id()
    cells = df.select(place.alias("_place"), *(F.col(c).cast("string").alias(c) for c in columns))
    digests = [F.sum(F.xxhash64("_place", F.col(c).isNull(), F.col(c), F.lit(part)).cast("decimal(38,0)")) for part in (0, 1) for c in columns]
    sums = cells.agg(*(d.alias(f"d{i}") for i, d in enumerate(digests))).first()
    seen: dict = {}
    for i, c in enumerate(columns):
        seen.setdefault((sums[i], sums[i + len(columns)]), c)
    return list(seen.values())


def split_text(df: DataFrame, key: str, text: str, row_mark: str, column_mark: str, skip_empty: bool = False) -> DataFrame:
    """(key, row, column, cell) of texts split by a mark of rows and a mark of columns, both literal."""
    literal = lambda mark: "".join(f"\\{c}" if not c.isalnum() and not c.isspace() else c for c in mark)
    rows = df.select(key, F.posexplode(F.split(text, literal(row_mark))).alias("row_no", "_r"))
    cells = F.split("_r", literal(column_mark))
    return rows.select(key, "row_no", F.posexplode(F.filter(cells, lambda c: c != "") if skip_empty else cells).alias("column_no", "cell"))


def vstack(*tables: DataFrame) -> DataFrame:
    """T4: tables below one another, by column name; missing columns are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def hstack(a: DataFrame, b: DataFrame, place: str) -> DataFrame:
    """T4: tables side by side by place; the shorter one is padded with nulls."""
    return a.join(b, place, "full")


def take_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """T5: the first ``n`` rows."""
    return df.orderBy(*order).limit(n)


def take_columns(df: DataFrame, n: int) -> DataFrame:
    """T5: the first ``n`` columns, or the last ones if ``n`` is negative."""
    return df.select(*(df.columns[:n] if n >= 0 else df.columns[n:]))


def drop_columns(df: DataFrame, n: int) -> DataFrame:
    """T5: all but the first ``n`` columns, or but the last ones if ``n`` is negative."""
    return df.select(*(df.columns[n:] if n >= 0 else df.columns[:n]))


def drop_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """T5: all but the first ``n`` rows in this order; of rows equal in it some are dropped, never too many."""
    return numbered(df, order, "_row_no").where(F.col("_row_no") > n).drop("_row_no")


def choose_rows(df: DataFrame, place: str, wanted: list[int]) -> DataFrame:
    """Rows at the given places, in that order, repeats allowed; negative places count from the end."""
    spark = df.sparkSession
    table = spark.createDataFrame(list(enumerate(wanted)), "out_pos long, _w long")
    if any(w < 0 for w in wanted):
        n = df.agg(F.max(place).alias("_n"))
        table = table.join(F.broadcast(n)).withColumn("_w", F.when(F.col("_w") < 0, F.col("_n") + 1 + F.col("_w")).otherwise(F.col("_w"))).drop("_n")
    return df.join(F.broadcast(table), F.col(place) == F.col("_w")).drop("_w")


def choose_columns(df: DataFrame, wanted: list[int]) -> DataFrame:
    """Columns by number from 1 (negative from the end), renamed if repeated."""
    names = [df.columns[w - 1 if w > 0 else w] for w in wanted]
    return df.select(*(F.col(n).alias(n if n not in names[:i] else f"{n}_{i + 1}") for i, n in enumerate(names)))


def generate_series(spark, rows: int, columns: int, start: float, step: float) -> DataFrame:
    """Rows x columns numbers, counted row by row."""
    return spark.range(rows).select((F.col("id") + 1).alias("row_no"), *((F.lit(start) + (F.col("id") * columns + i) * F.lit(step)).alias(f"c{i + 1}") for i in range(columns)))


def pad(df: DataFrame, key: str, series: DataFrame, fill: dict) -> DataFrame:
    """Every key of ``series``, with ``df``'s row or the fill values."""
    return series.join(df, key, "left").fillna(fill)


def frequency(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Counts up to each edge (edge included) and beyond the last; empty bins are kept."""
    spark, edges = df.sparkSession, sorted(edges)
    number = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        number = F.when(F.col(value) <= edges[i], i).otherwise(number)
    counts = df.where(F.col(value).isNotNull()).groupBy(number.alias("bin")).agg(F.count("*").alias("n"))
    bins = spark.createDataFrame([(i, e) for i, e in enumerate([*map(float, edges), None])], "bin int, upper double")
    return bins.join(counts, "bin", "left").select("bin", "upper", F.coalesce("n", F.lit(0)).alias("n"))


def group_totals(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Groups, subtotals and the grand total; ``level`` is the number of keys rolled up."""
    level = sum((F.grouping(k).cast("int") for k in keys), F.lit(0))
    return df.rollup(*keys).agg(*aggs, level.alias("level"))


#: Columns that values may become.
MOST_COLUMNS = 1000


def distinct_values(df: DataFrame, column: str, most: int = MOST_COLUMNS) -> list:
    """A column's different values, ascending, null left out; an error if there are more than may become columns."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} different values, which can't all become columns")
    return sorted(found)


def pivot_totals(df: DataFrame, row: str, column: str, values: list | None, total: Column) -> DataFrame:
    """A cross table of sums with totals of rows and columns (row ``null`` with is_total true); column values that aren't given are found."""
    values = distinct_values(df, column) if values is None else values
    cells = [F.sum(F.when(F.col(column) == v, total)).alias(f"{v}") for v in values]
    return df.rollup(row).agg(*cells, F.sum(total).alias("total"), (F.grouping(row) == 1).alias("is_total"))


def filter_rows(df: DataFrame, mask: Column, if_empty: dict | None = None) -> DataFrame:
    """Rows whose mask is truthy; if there is none, the given row, else no row."""
    kept = df.where(F.coalesce(mask.cast("boolean"), F.lit(False)))
    if if_empty is None:
        return kept
    default = df.sparkSession.range(1).select(*(F.lit(if_empty.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema))
    some = kept.limit(1).select(F.lit(True).alias("_some"))
    return kept.unionByName(default.join(some, how="left_anti"))


def transpose(df: DataFrame, place: str, columns: list[str], places: list | None = None) -> DataFrame:
    """A row per column, a column per place; places that aren't given are found."""
    places = distinct_values(df, place) if places is None else places
    cells = df.select(place, *(F.col(c).cast("string").alias(c) for c in columns)).unpivot([place], columns, "name", "value")
    return cells.groupBy("name").pivot(place, places).agg(F.first("value"))
