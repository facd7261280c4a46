"""What counts as a number in a cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(c: Column | str) -> Column:
    """A finite number, or text that is a numeral, as a double; else null, for booleans too."""
    c = F.col(c) if isinstance(c, str) else c
    kind, x = F.typeof(c), c.try_cast("double")
    fits = (kind != "boolean") & ((kind != "string") | c.cast("string").rlike(NUMERAL))
    return F.when(fits & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)
