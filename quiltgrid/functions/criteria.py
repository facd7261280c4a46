"""Criteria text (``">100"``, ``"<>apple"``, ``"North*"``, ``""``) as column predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quiltgrid.functions.numbers import number

#: The comparison operators of criteria text, longest first.
COMPARISONS = ("<=", ">=", "<>", "<", ">", "=")


def wildcard_pattern(text: str) -> str:
    """Java pattern of a wildcard text: ``*`` any run, ``?`` one character, ``~`` takes the next literally."""
    out, i = [], 0
    while i < len(text):
        c = text[i]
        if c == "~" and i + 1 < len(text) and text[i + 1] in "*?~":
            i += 1
            out.append(re.escape(text[i]))
        else:
            out.append({"*": ".*", "?": "."}.get(c) or re.escape(c))
        i += 1
    return "(?is)^" + "".join(out) + "$"


def matches_wildcard(value: Column, text: str) -> Column:
    return value.cast("string").rlike(wildcard_pattern(text))


def _number(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def criterion(value: Column, text: str | float | bool | Column) -> Column:
    """Whether ``value`` meets a criterion; never null, and null values meet only ``""``, ``"="`` and ``"<>x"``.

    Numbers, texts and booleans meet criteria of their own kind only: numeric text asks
    for numbers, ``TRUE`` and ``FALSE`` for booleans, other text, which is compared
    without case and may hold wildcards, for texts; ``"<>"`` alone asks for any value.
    A numeral in a text column is a number.
    """
    if isinstance(text, Column):
        return F.coalesce(value == text, F.lit(False))
    kind, cell = F.typeof(value), value.cast("string")
    if isinstance(text, bool):
        return F.coalesce(kind.isin("boolean", "string") & (F.lower(cell) == str(text).lower()), F.lit(False))
    if not isinstance(text, str):
        return F.coalesce(number(value) == float(text), F.lit(False))
    op = next((o for o in COMPARISONS if text.startswith(o)), "=")
    rest = text[len(op):] if text.startswith(op) else text
    if rest == "":
        blank = value.isNull() | (cell == "")
        return {"=": blank, "<>": ~blank}.get(op, F.lit(False))
    x = _number(rest)
    if op in ("=", "<>"):
        as_text = kind.isin("string", "boolean") & cell.rlike(wildcard_pattern(rest))
        same = F.coalesce(number(value) == x if x is not None else as_text, F.lit(False))
        return same if op == "=" else ~same
    left = number(value) if x is not None else F.when((kind == "string") & number(value).isNull() & (cell != ""), F.lower(cell))
    right = F.lit(x if x is not None else rest.lower())
    test = {"<": left < right, "<=": left <= right, ">": left > right, ">=": left >= right}[op]
    return F.coalesce(test, F.lit(False))


def all_criteria(pairs) -> Column:
    """Every (value, criterion) pair is met."""
    out = F.lit(True)
    for value, text in pairs:
        out = out & criterion(value, text)
    return out
