"""Running aggregates of groups of any size (the ground of W1, W3 to W5, W7, W8, J2, A4, A5).

A window over a group brings all its rows to one task. Where a group is larger than
``GROUP_ROWS``, rows are dealt out in ranges of (keys, order) instead: each range is
scanned for itself, its summary (one row per key and range) is accumulated over the ranges
before, and joined back as what is carried in. Smaller groups take the window, which
moves rows once. Both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgrid.session import materialize

#: Rows of a group that one task may scan.
GROUP_ROWS = 1_000_000


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest group, by partial aggregation."""
    return df.groupBy(*keys).agg(F.count("*").alias("_rows")).agg(F.coalesce(F.max("_rows"), F.lit(0))).first()[0]


def is_wide(df: DataFrame, keys: list[str], spread: bool | None) -> bool:
    """Whether groups are to be scanned in ranges; asked of the data if ``spread`` is None.

    Counting all rows reads no column, and answers for tables that fit as a whole.
    """
    if spread is not None:
        return spread
    rows = df.count()
    return rows > GROUP_ROWS and (not keys or largest_group(df, keys) > GROUP_ROWS)


def same_keys(keys: list[str], prefix: str) -> list[Column]:
    """Null-safe equality of each key with its copy of that prefix."""
    return [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys]


#: Of each running aggregate: over rows, over partial results, and what is carried in with what is local.
HOW = {
    "sum": (F.sum, F.sum, lambda carry, local: F.coalesce(carry + local, carry, local)),
    "count": (F.count, F.sum, lambda carry, local: F.coalesce(carry, F.lit(0)) + local),
    "min": (F.min, F.min, F.least),
    "max": (F.max, F.max, F.greatest),
    "product": (F.product, F.product, lambda carry, local: F.coalesce(carry * local, carry, local)),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda c: F.last(c, ignorenulls=True), lambda carry, local: F.coalesce(local, carry)),
}


def running_columns(df: DataFrame, keys: list[str], order: list, columns: dict[str, tuple[Column, str]], spread: bool | None = None) -> DataFrame:
    """``df`` with running aggregates of each group in this order, the row itself included.

    ``columns`` maps names to (value, how), ``how`` being one of sum, count, min, max,
    product, last (the last value that isn't null), or lag (the value of the row before).
    Rows equal in ``order`` come in any order, the same for all columns.
    """
    own = {f"_v_{name}": value for name, (value, _) in columns.items()}
    rows = df.withColumns(own)
    if not is_wide(df, keys, spread):
        order_by = Window.partitionBy(*keys).orderBy(*order)
        up_to = order_by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = {name: F.lag(f"_v_{name}").over(order_by) if how == "lag" else HOW[how][0](f"_v_{name}").over(up_to) for name, (_, how) in columns.items()}
        return rows.withColumns(out).drop(*own)
    ranged = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_scan_at", F.monotonically_increasing_id())
    ranged = materialize(ranged).withColumn("_scan_range", F.shiftright("_scan_at", 33))  # all reads below must see the same ranges
    parts, carries, merged = [], [], {}
    before = Window.partitionBy(*keys).orderBy("_scan_range")  # a row per key and range
    inside = Window.partitionBy(*keys, "_scan_range").orderBy("_scan_at")
    up_to = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name, (_, how) in columns.items():
        v, part, carry = F.col(f"_v_{name}"), f"_p_{name}", F.col(f"_c_{name}")
        if how == "lag":
            parts.append(F.max_by(F.struct(v.alias("v")), "_scan_at").alias(part))
            carries.append(F.lag(part).over(before).getField("v").alias(f"_c_{name}"))
            merged[name] = F.when(F.row_number().over(inside) == 1, carry).otherwise(F.lag(v).over(inside))
            continue
        over_rows, over_parts, merge = HOW[how]
        parts.append((F.max_by(v, F.when(v.isNotNull(), F.col("_scan_at"))) if how == "last" else over_rows(v)).alias(part))
        carries.append(over_parts(part).over(before.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_c_{name}"))
        merged[name] = merge(carry, over_rows(v).over(up_to))
    carried = ranged.groupBy(*keys, "_scan_range").agg(*parts).select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_scan_range").alias("_r"), *carries)
    joined = ranged.join(carried, [*same_keys(keys, "_k_"), F.col("_scan_range") == F.col("_r")])
    return joined.withColumns(merged).select(*df.columns, *columns)


def with_totals(df: DataFrame, keys: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """``df`` with aggregates of each group joined to its rows, null keys being a group; no window over a group."""
    totals = df.groupBy(*keys).agg(*(a.alias(name) for name, a in aggregates.items())).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    # Without keys the other side is one row.
    joined = df.join(totals, same_keys(keys, "_k_")) if keys else df.join(F.broadcast(totals))
    return joined.select(*df.columns, *aggregates)
