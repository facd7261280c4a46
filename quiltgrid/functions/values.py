"""Scalar rules of spreadsheet functions as column expressions."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quiltgrid.functions.units import UNITS

# The error texts of spreadsheet applications, with ERROR.TYPE's numbers.
ERROR_NUMBERS = {"#NULL!": 1, "#DIV/0!": 2, "#VALUE!": 3, "#REF!": 4, "#NAME?": 5, "#NUM!": 6, "#N/A": 7}
ERROR_CODES = (
    "#NULL!", "#DIV/0!", "#VALUE!", "#REF!", "#NAME?", "#NUM!", "#N/A", "#GETTING_DATA", "#CALC!", "#SPILL!", "#FIELD!", "#UNKNOWN!", "#BLOCKED!", "#CONNECT!", "#BUSY!",
)
# End of fixed values.


def lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def away_from_zero(x: Column, step) -> Column:
    """ROUNDUP and the like: the next multiple of ``step`` away from zero."""
    step = lit(step)
    return F.signum(x) * F.ceil(F.round(F.abs(x) / step, 9)) * step


def toward_zero(x: Column, step) -> Column:
    step = lit(step)
    return F.signum(x) * F.floor(F.round(F.abs(x) / step, 9)) * step


def round_half_away(x: Column, digits: int = 0) -> Column:
    return F.round(x, digits)


def round_up(x: Column, digits: int = 0) -> Column:
    return F.round(away_from_zero(x, 10.0**-digits), max(digits, 0))


def round_down(x: Column, digits: int = 0) -> Column:
    """ROUNDDOWN and TRUNC."""
    return F.round(toward_zero(x, 10.0**-digits), max(digits, 0))


def mround(x: Column, multiple) -> Column:
    """Nearest multiple, halves away from zero; null if the signs differ; 0 for a multiple of 0."""
    m = lit(multiple)
    return F.when(m == 0, 0.0).when(x * m >= 0, F.signum(x) * F.floor(F.round(F.abs(x) / F.abs(m) + 0.5, 9)) * F.abs(m))


def floor_math(x: Column, step, mode: int = 0) -> Column:
    s = F.abs(lit(step)).cast("double")
    down = F.floor(F.round(x / s, 9)) * s
    return F.when(x < 0, -F.floor(F.round(-x / s, 9)) * s).otherwise(down) if mode else down


def ceiling_math(x: Column, step, mode: int = 0) -> Column:
    s = F.abs(lit(step)).cast("double")
    up = F.ceil(F.round(x / s, 9)) * s
    return F.when(x < 0, -F.ceil(F.round(-x / s, 9)) * s).otherwise(up) if mode else up


def ceiling(x: Column, step) -> Column:
    """CEILING: a negative step takes a negative number away from zero; a positive number with a negative step is null."""
    s = lit(step)
    return F.when(s == 0, 0.0).when((x > 0) & (s < 0), None).otherwise(F.ceil(F.round(x / s, 9)) * s)


def floor_(x: Column, step) -> Column:
    s = lit(step)
    return F.when((x > 0) & (s < 0), None).otherwise(F.floor(F.round(x / s, 9)) * s)


def even(x: Column) -> Column:
    return away_from_zero(x, 2.0)


def odd(x: Column) -> Column:
    sign = F.when(x < 0, -1.0).otherwise(1.0)
    return sign * (F.ceil(F.greatest(F.abs(x) - 1, F.lit(0.0)) / 2) * 2 + 1)


def mod(x: Column, n) -> Column:
    """Remainder with the divisor's sign; null by zero."""
    n = lit(n)
    return F.when(n != 0, x - n * F.floor(x / n))


def quotient(x: Column, n) -> Column:
    return F.when(lit(n) != 0, (x / lit(n)).cast("long"))


def is_even(x: Column) -> Column:
    return F.floor(F.abs(x)) % 2 == 0


def sqrt(x: Column) -> Column:
    return F.when(x >= 0, F.sqrt(x))


def power(x: Column, y) -> Column:
    """Null where there is no real result."""
    out = F.pow(x, lit(y))
    return F.when(~F.isnan(out) & ~((x == 0) & (lit(y) < 0)), out)


def proper(text: Column) -> Column:
    """Upper case after anything but a letter, lower case after a letter."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, F.lit(2), F.length(r))))), "")


def trim(text: Column) -> Column:
    """No outer spaces, inner runs of spaces made one; other white space stays."""
    return F.btrim(F.regexp_replace(text, " +", " "))


def clean(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x1f]", "")


def char(code: Column) -> Column:
    return F.when(code.between(1, 255), F.chr(code.cast("long")))


def left(text: Column, n: int = 1) -> Column:
    return F.substring(text, 1, n)


def right(text: Column, n: int = 1) -> Column:
    return F.when(F.length(text) <= n, text).otherwise(F.substring(text, -n, n)) if n else F.lit("")


def text_before(text: Column, mark: str, n: int = 1) -> Column:
    """Text before the n-th mark (from the end if negative); null if there is none."""
    count = (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)
    head = F.substring_index(text, mark, n) if n > 0 else F.substring(text, F.lit(1), F.length(text) - F.length(F.substring_index(text, mark, n)) - len(mark))
    return F.when(count >= abs(n), head)


def text_after(text: Column, mark: str, n: int = 1) -> Column:
    count = (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)
    tail = F.substring_index(text, mark, n) if n < 0 else F.substring(text, F.length(F.substring_index(text, mark, n)) + len(mark) + 1, F.length(text))
    return F.when(count >= abs(n), tail)


def find(part: str, text: Column, start: int = 1) -> Column:
    """Place of a part, with case; null if it is missing."""
    at = F.locate(part, text, start)
    return F.when(at > 0, at)


def search(pattern: str, text: Column) -> Column:
    """Place of a wildcard pattern, without case; null if it is missing."""
    from quiltgrid.functions.criteria import wildcard_pattern

    regex = wildcard_pattern(pattern).replace("(?is)^", "(?is)").removesuffix("$").replace(".*", ".*?")
    at = F.regexp_instr(text, F.lit(regex))
    return F.when(at > 0, at)


def substitute(text: Column, old: str, new: str, nth: int | None = None) -> Column:
    """Replace a part, with case: everywhere, or only its n-th occurrence."""
    if nth is None:
        return F.replace(text, F.lit(old), F.lit(new))
    before, after = text_before(text, old, nth), text_after(text, old, nth)
    return F.when(before.isNull(), text).otherwise(F.concat(before, F.lit(new), after))


def replace_at(text: Column, start: int, n: int, new: str) -> Column:
    return F.concat(F.substring(text, 1, start - 1), F.lit(new), F.substring(text, F.lit(start + n), F.length(text)))


def to_number(text: Column) -> Column:
    """VALUE: numbers with grouping commas, a currency sign before or a percent sign after them; in brackets they are negative."""
    bare = F.btrim(text)
    # sign, dollar, digits with or without groups, fraction, exponent, percent
    shape = r"^([+-]?\s*\$?|\$\s*[+-]?)\s*([0-9]{1,3}(,[0-9]{3})+|[0-9]+)?(\.[0-9]*)?([eE][+-]?[0-9]+)?\s*%?$"
    inner = F.when(bare.rlike(r"^\(.*\)$"), F.substring(bare, F.lit(2), F.length(bare) - 2)).otherwise(bare)
    n = F.when(inner.rlike(shape) & inner.rlike("[0-9]"), F.regexp_replace(inner, r"[$,%\s]", "").try_cast("double"))
    n = F.when(inner.endswith("%"), n / 100).otherwise(n)
    return F.when(bare.startswith("("), F.when(n >= 0, -n)).otherwise(n)


def to_serial(t: Column) -> Column:
    """Days since 1899-12-30, with the time as a fraction; for dates from 1900-03-01."""
    stamp = t.cast("timestamp")
    return F.unix_micros(stamp) / F.lit(86400e6) + 25569


def from_serial(x: Column) -> Column:
    return F.timestamp_micros(F.round((x - 25569) * 86400e6).cast("long"))


def make_date(y, m, d) -> Column:
    """DATE: months and days out of range carry over."""
    y, m, d = lit(y), lit(m), lit(d)
    return F.date_add(F.add_months(F.make_date(y, F.lit(1), F.lit(1)), (m - 1).cast("int")), (d - 1).cast("int"))


def edate(day: Column, months) -> Column:
    """Months later, held at the month's last day; fractions are cut off."""
    return F.add_months(day.cast("date"), lit(months).cast("int"))


def eomonth(day: Column, months) -> Column:
    return F.last_day(edate(day, months))


def date_dif(start: Column, end: Column, unit: str) -> Column:
    """DATEDIF: whole Y, M or D, and the rests YM, YD, MD; null if the end is before the start.

    MD counts the days of the month before the end's to the end, so that it is negative
    where that month is shorter than the start's day.
    """
    start, end = start.cast("date"), end.cast("date")
    short = F.day(end) < F.day(start)
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start) - short.cast("int")
    years = F.floor(months / 12)
    days = F.day(end) - F.day(start) + F.when(short, F.day(F.last_day(F.add_months(end, -1)))).otherwise(0)
    out = {
        "Y": years, "M": months.cast("long"), "D": F.datediff(end, start).cast("long"), "YM": (months % 12).cast("long"), "YD": F.datediff(end, F.add_months(start, (years * 12).cast("int"))).cast("long"), "MD": days.cast("long"),
    }[unit.upper()]
    return F.when(end >= start, out)


def days360(start: Column, end: Column, european: bool = False) -> Column:
    start, end = start.cast("date"), end.cast("date")
    d1 = F.least(F.day(start), F.lit(30)) if european else F.when(start == F.last_day(start), 30).otherwise(F.day(start))
    d2 = F.least(F.day(end), F.lit(30)) if european else F.when((F.day(end) == 31) & (d1 >= 30), 30).otherwise(F.day(end))
    return (F.year(end) - F.year(start)) * 360 + (F.month(end) - F.month(start)) * 30 + d2 - d1


def year_frac(start: Column, end: Column, basis: int = 0) -> Column:
    days = F.datediff(end.cast("date"), start.cast("date"))
    if basis == 0:
        return days360(start, end) / 360
    if basis == 4:
        return days360(start, end, european=True) / 360
    if basis == 1:
        year_days = F.datediff(F.make_date(F.year(end) + 1, F.lit(1), F.lit(1)), F.make_date(F.year(start), F.lit(1), F.lit(1))) / (F.year(end) - F.year(start) + 1)
        return days / year_days
    return days / {2: 360, 3: 365}[basis]


def workdays(start: Column, end: Column) -> Column:
    """Mondays to Fridays in a date range, both ends included, negative if reversed; closed form."""
    start, end = start.cast("date"), end.cast("date")
    before = lambda d: F.floor((F.unix_date(d) + 3) / 7) * 5 + F.least(F.pmod(F.unix_date(d) + 3, F.lit(7)), F.lit(5))  # noqa: E731  workdays before d, from a Monday
    forward = lambda a, b: before(F.date_add(b, 1)) - before(a)
    return F.when(end >= start, forward(start, end)).otherwise(-forward(end, start)).cast("long")


def workday_after(start: Column, n: Column) -> Column:
    """The n-th workday after a date (n >= 0)."""
    day = F.unix_date(start.cast("date")) + 3
    place = F.floor(day / 7) * 5 + F.least(F.pmod(day, F.lit(7)) + 1, F.lit(5)) - 1 + n  # the workday number reached
    return F.when(n == 0, start.cast("date")).otherwise(F.date_from_unix_date((F.floor(place / 5) * 7 + F.pmod(place, F.lit(5)) - 3).cast("int")))


def weeknum(day: Column, first: int = 1) -> Column:
    """WEEKNUM: the week of January 1st is 1; weeks begin on Sunday (1) or Monday (2); 21 is the ISO week."""
    if first == 21:
        return F.weekofyear(day)
    shift = F.weekday(F.trunc(day.cast("date"), "year")) if first == 2 else F.dayofweek(F.trunc(day.cast("date"), "year")) - 1
    return F.floor((F.dayofyear(day) - 1 + shift) / 7).cast("int") + 1


def time_of(h, m, s) -> Column:
    """TIME: a fraction of a day; whole days are dropped."""
    return F.pmod(lit(h) * 3600 + lit(m) * 60 + lit(s), F.lit(86400)) / 86400


def time_value(text: Column) -> Column:
    """TIMEVALUE: 12-hour or 24-hour clock text as a fraction of a day; null if it is neither."""
    t = F.upper(F.btrim(text))
    stamp = F.coalesce(F.try_to_timestamp(t, F.lit("h:mm:ss a")), F.try_to_timestamp(t, F.lit("h:mm a")), F.try_to_timestamp(t, F.lit("H:mm:ss")), F.try_to_timestamp(t, F.lit("H:mm")))
    return (F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.second(stamp)) / 86400


def number_value(text: Column, decimal: str = ".", group: str = ",") -> Column:
    """NUMBERVALUE: a number with given separators; each percent sign divides by 100."""
    bare = F.replace(F.replace(F.regexp_replace(text, r"\s", ""), F.lit(group), F.lit("")), F.lit(decimal), F.lit("."))
    signs = F.length(bare) - F.length(F.rtrim(bare, F.lit("%")))
    return F.rtrim(bare, F.lit("%")).try_cast("double") / F.pow(F.lit(100.0), signs)


def log(x: Column, base=10.0) -> Column:
    """LOG: null for numbers that have none."""
    return F.when(x > 0, F.ln(x) / F.ln(lit(base)))


def multinomial(*counts: Column) -> Column:
    """(sum)! over the product of factorials, as a product of binomials."""
    total, out = lit(0), F.lit(1.0)
    for c in counts:
        total = total + c
        out = out * combin(total, c)
    return out


def fixed(x: Column, digits: int = 2, commas: bool = True) -> Column:
    """FIXED: text with so many decimals, halves away from zero."""
    text = F.format_number(F.round(x, digits), digits)
    return text if commas else F.replace(text, F.lit(","), F.lit(""))


def format_number_code(x: Column, code: str) -> Column:
    """TEXT with a number code: sections by sign, digit places, grouping, percent, exponent, literal text.

    Up to three sections, ``positive;negative;zero``, hold for their sign; a negative
    number in its own section shows no sign but that section's.
    """
    parts = code.split(";")
    zero = _one_code(x, parts[2] if len(parts) > 2 else parts[0])
    below = _one_code(F.abs(x), parts[1]) if len(parts) > 1 else F.concat(F.lit("-"), _one_code(F.abs(x), parts[0]))
    shown_zero = _one_code(F.lit(0.0), parts[0])
    if len(parts) == 1:  # a number that is shown as zero has no sign
        below = F.when(_one_code(F.abs(x), parts[0]) == shown_zero, shown_zero).otherwise(below)
    return F.when(x > 0, _one_code(x, parts[0])).when(x < 0, below).otherwise(zero)


def _one_code(x: Column, code: str) -> Column:
    """One section for a number that isn't negative."""
    found = re.search(r"[0#?][0#?,]*(\.[0#?]*)?(E[+-]0+)?|\.[0#?]+(E[+-]0+)?", code)
    quiet = lambda text: text.replace('"', "").replace("\\", "").replace("_", "")
    if not found:
        return F.lit(quiet(code))
    head, body, tail = quiet(code[: found.start()]), found.group(), quiet(code[found.end() :])
    body, _, exponent = body.partition("E")
    whole, _, part = body.partition(".")
    scaled = whole.endswith(",")
    thousands = len(whole) - len(whole.rstrip(","))
    x = x * (100.0 if "%" in code else 1.0) / 1000.0**thousands if scaled or "%" in code else x
    places, least = len(part), sum(c == "0" for c in whole)
    if exponent:
        power = F.when(x == 0, F.lit(0)).otherwise(F.floor(F.log10(x)).cast("int"))
        digits = F.round(x / F.pow(F.lit(10.0), power), places)
        carry = digits >= 10
        power, digits = F.when(carry, power + 1).otherwise(power), F.when(carry, digits / 10).otherwise(digits)
        sign = F.when(power < 0, "-").otherwise("+" if exponent[0] == "+" else "")
        tens = F.lpad(F.abs(power).cast("string"), max(len(exponent) - 1, 1), "0")
        tens = F.when(F.length(F.abs(power).cast("string")) > len(exponent) - 1, F.abs(power).cast("string")).otherwise(tens)
        return F.concat(F.lit(head), F.replace(F.format_number(digits, places), F.lit(","), F.lit("")), F.lit("E"), sign, tens, F.lit(tail))
    shown = F.format_number(F.round(x, places), places)
    left, right_ = F.split_part(shown, F.lit("."), F.lit(1)), F.split_part(shown, F.lit("."), F.lit(2))
    bare = F.replace(left, F.lit(","), F.lit(""))
    if least == 0:
        left, bare = (F.when(bare == "0", "").otherwise(v) for v in (left, bare))
    if "," in whole.rstrip(","):
        left = F.when(F.length(bare) < least, F.lpad(bare, least, "0")).otherwise(left)
    else:
        left = F.when(F.length(bare) < least, F.lpad(bare, max(least, 1), "0")).otherwise(bare)
    fixed_places = len(part.rstrip("#"))
    for _ in range(places - fixed_places):  # optional places: zeros at the end go
        right_ = F.when((F.length(right_) > fixed_places) & right_.endswith("0"), F.substring(right_, F.lit(1), F.length(right_) - 1)).otherwise(right_)
    point = F.concat(F.lit("."), right_) if places else F.lit("")
    return F.concat(F.lit(head), left, point, F.lit(tail))


def format_date_code(t: Column, code: str) -> Column:
    """TEXT with a date or time code: y, m, d, h, s in their usual lengths, AM/PM, and elapsed [h], [m] or [s]."""
    stamp, out, minutes = t.cast("timestamp"), [], False
    seconds = F.unix_micros(stamp) / F.lit(1_000_000) + F.lit(25569 * 86400)
    elapsed = {"[h]": 3600, "[hh]": 3600, "[m]": 60, "[mm]": 60, "[s]": 1, "[ss]": 1}
    half = bool(re.search("am/pm", code, re.I))
    tokens = re.findall(r'\[h+\]|\[m+\]|\[s+\]|am/pm|y+|m+|d+|h+|s+|"[^"]*"|\\.|.', code, re.I)
    for i, token in enumerate(tokens):
        low = token.lower()
        if low in elapsed:
            out.append(F.floor(seconds / elapsed[low]).cast("string"))
            minutes = low[1] == "h"
        elif low == "am/pm":
            out.append(F.date_format(stamp, "a"))
        elif low[0] == "h":
            out.append(F.date_format(stamp, ("h" if half else "H") * min(len(low), 2)))
            minutes = True
        elif low[0] == "s":
            out.append(F.date_format(stamp, "s" * min(len(low), 2)))
        elif low[0] == "m" and len(low) <= 2 and (minutes or next((x[0].lower() for x in tokens[i + 1 :] if x[0].isalpha()), "") == "s"):
            out.append(F.date_format(stamp, "m" * len(low)))
            minutes = False
        elif low[0] == "m":
            name = F.date_format(stamp, "MMM" if len(low) == 3 else "MMMM")
            out.append(F.date_format(stamp, "M" * len(low)) if len(low) < 3 else F.substring(name, 1, 1) if len(low) == 5 else name)
        elif low[0] == "y":
            out.append(F.date_format(stamp, "yy" if len(low) <= 2 else "yyyy"))
        elif low[0] == "d":
            out.append(F.date_format(stamp, ("d", "dd", "EEE", "EEEE")[min(len(low), 4) - 1]))
        else:
            out.append(F.lit(token.strip('"') if token[0] == '"' else token.lstrip("\\")))
    return F.concat(*out)


def text(x: Column, code: str) -> Column:
    """TEXT: a number by a number code, or by a date code as the serial of a day; ``@`` or ``General`` as it is."""
    if code in ("@", "General"):
        return value_to_text(x)
    bare = re.sub(r'"[^"]*"|\\.', "", code)
    if re.search(r"[ymdhs]", bare, re.I) and not re.search(r"[0#?]", bare):
        return format_date_code(from_serial(x), code)
    return format_number_code(x, code)


def dollar(x: Column, digits: int = 2) -> Column:
    """DOLLAR: negative amounts in parentheses."""
    text = F.concat(F.lit("$"), F.format_number(F.round(F.abs(x), digits), digits))
    return F.when(x < 0, F.concat(F.lit("("), text, F.lit(")"))).otherwise(text)


def value_to_text(x: Column, strict: bool = False) -> Column:
    """VALUETOTEXT: whole numbers without decimals; strict quotes text."""
    text = F.regexp_replace(x.cast("string"), r"\.0$", "")
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')) if strict else text


def radix(x: Column, base: int, places: int = 0, bits: int = 0) -> Column:
    """A whole number in a base; negative numbers as two's complement of ``bits`` bits."""
    n = F.when(x < 0, x + (1 << bits)).otherwise(x) if bits else x
    out = F.conv(n.cast("string"), 10, base)
    return F.when(F.length(out) < places, F.lpad(out, places, "0")).otherwise(out) if places else out


def from_radix(text: Column, base: int, bits: int = 0) -> Column:
    n = F.conv(text, base, 10).cast("long")
    return F.when(n >= 1 << (bits - 1), n - (1 << bits)).otherwise(n) if bits else n


def combin(n: Column, k) -> Column:
    """n over k, as a product that stays exact in doubles for results below 2 ** 53."""
    k = lit(k).cast("int")
    steps = F.when(k > 0, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>"))
    return F.when(k <= n, F.round(F.aggregate(steps, F.lit(1.0), lambda acc, i: acc * (n - k + i) / i)))


def combina(n: Column, k) -> Column:
    """COMBINA: ways to choose ``k`` of ``n`` with repetition; 1 for none of none."""
    k = lit(k)
    return F.when((n == 0) & (k == 0), 1.0).when(n > 0, combin(n + k - 1, k))


def double_factorial(n: Column) -> Column:
    return F.when(n <= 1, 1.0).otherwise(F.aggregate(F.sequence(n.cast("int"), F.lit(1), F.lit(-2)), F.lit(1.0), lambda acc, i: acc * i))


def pmt(rate, n, pv, fv=0.0) -> Column:
    r, n, pv, fv = map(lit, (rate, n, pv, fv))
    growth = F.pow(1 + r, n)
    return F.when(r == 0, -(pv + fv) / n).otherwise(-(pv * growth + fv) * r / (growth - 1))


def fv(rate, n, payment, pv=0.0) -> Column:
    r, n, p, pv = map(lit, (rate, n, payment, pv))
    growth = F.pow(1 + r, n)
    return F.when(r == 0, -(pv + p * n)).otherwise(-(pv * growth + p * (growth - 1) / r))


def pv(rate, n, payment, fv_=0.0) -> Column:
    r, n, p, v = map(lit, (rate, n, payment, fv_))
    growth = F.pow(1 + r, n)
    return F.when(r == 0, -(v + p * n)).otherwise(-(v + p * (growth - 1) / r) / growth)


def _balance(rate, k, payment, pv_, start: int) -> Column:
    """What is owed after ``k`` payments, as FV gives it; ``start``: payments at the start of a period."""
    r, k, due = lit(rate).cast("double"), lit(k), lit(payment) * (1 + lit(rate) * start)
    grown = F.pow(1 + r, k)
    return F.when(r == 0, -(lit(pv_) + lit(payment) * k)).otherwise(-(lit(pv_) * grown + due * F.try_divide(grown - 1, r)))


def payment_of(rate, n, pv_, fv_=0.0, start: int = 0) -> Column:
    """PMT with payments at the end or the start of each period."""
    r, n = lit(rate).cast("double"), lit(n)
    grown = F.pow(1 + r, n)
    return F.when(r == 0, -(lit(pv_) + lit(fv_)) / n).otherwise(-(lit(fv_) + lit(pv_) * grown) * F.try_divide(r, (1 + r * start) * (grown - 1)))


def ipmt(rate, period, n, pv_, fv_=0.0, start: int = 0) -> Column:
    """IPMT: the interest in one payment; null outside periods 1 to n."""
    k, r = lit(period), lit(rate)
    owed = _balance(rate, k - 1, payment_of(rate, n, pv_, fv_, start), pv_, start)
    interest = F.when((k == 1) & F.lit(start == 1), 0.0).otherwise(owed * r / (1 + r * start))
    return F.when((k >= 1) & (k <= lit(n)), interest)


def ppmt(rate, period, n, pv_, fv_=0.0, start: int = 0) -> Column:
    """PPMT: the part of one payment that isn't interest."""
    return payment_of(rate, n, pv_, fv_, start) - ipmt(rate, period, n, pv_, fv_, start)


def cumipmt(rate, n, pv_, first, last, start: int = 0) -> Column:
    """CUMIPMT: interest of payments ``first`` to ``last``, in either order; null if one is outside 1 to n.

    In closed form: what is owed grows by the interest and falls by the payments.
    """
    r, a, b = lit(rate), lit(first).cast("int"), lit(last).cast("int")
    payment = payment_of(rate, n, pv_, 0.0, start)
    low, high = F.least(a, b), F.greatest(a, b)
    before = F.greatest(low - 1, F.lit(start))  # the first payment at the start of a period has no interest
    grown = _balance(rate, high, payment, pv_, start) - _balance(rate, before, payment, pv_, start)
    interest = F.when((r == 0) | (high <= before), 0.0).otherwise((high - before) * payment + grown / (1 + r * start))
    return F.when((a >= 1) & (b >= 1) & (a <= lit(n)) & (b <= lit(n)), interest)


def cumprinc(rate, n, pv_, first, last, start: int = 0) -> Column:
    """CUMPRINC: what payments ``first`` to ``last`` pay back."""
    return (lit(last) - lit(first) + 1) * payment_of(rate, n, pv_, 0.0, start) - cumipmt(rate, n, pv_, first, last, start)


def _rate(n: pd.Series, payment: pd.Series, pv: pd.Series, fv: pd.Series, start: pd.Series) -> pd.Series:
    def worth(r: np.ndarray) -> np.ndarray:
        """Of all flows today; a huge discount factor is held below what a double overflows at."""
        factor = np.exp(np.minimum(-n * np.log1p(r), 600.0))
        each = np.where(r == 0, n, (1 + r * start) * (1 - factor) / np.where(r == 0, 1.0, r))
        return pv + payment * each + fv * factor

    n, payment, pv, fv, start = (x.to_numpy(float) for x in (n, payment, pv, fv, start))
    low, high = np.full(len(n), -0.99), np.full(len(n), 10.0)
    with np.errstate(all="ignore"):
        sign, crosses = np.sign(worth(low)), worth(low) * worth(high) <= 0
        for _ in range(60):  # a low end keeps its sign, so that only the middle is looked at
            mid = (low + high) / 2
            left = sign * np.sign(worth(mid)) <= 0
            low, high = np.where(left, low, mid), np.where(left, mid, high)
    return pd.Series(np.where(crosses, (low + high) / 2, np.nan))


def rate(n, payment, pv_, fv_=0.0, start: int = 0) -> Column:
    """RATE: the rate of a period, by halving a range for many rows at once; null if the worth keeps its sign in (-0.99, 10)."""
    return F.pandas_udf(_rate, "double")(*(lit(x).cast("double") for x in (n, payment, pv_, fv_, start)))


def nper(rate, payment, pv_, fv_=0.0) -> Column:
    r, p, v, f = map(lit, (rate, payment, pv_, fv_))
    return F.when(r == 0, -(v + f) / p).otherwise(F.ln((p - f * r) / (p + v * r)) / F.ln(1 + r))


def effect(nominal: Column, times) -> Column:
    return F.pow(1 + nominal / times, lit(times)) - 1


def nominal(effective: Column, times) -> Column:
    return times * (F.pow(1 + effective, 1 / lit(times)) - 1)


def rri(n, start, end) -> Column:
    return F.pow(lit(end) / lit(start), 1 / lit(n)) - 1


def pduration(rate, start, end) -> Column:
    return F.ln(lit(end) / lit(start)) / F.ln(1 + lit(rate))


def sln(cost: Column, salvage: Column, life) -> Column:
    return (cost - salvage) / lit(life)


def syd(cost: Column, salvage: Column, life, period) -> Column:
    life, period = lit(life), lit(period)
    return (cost - salvage) * (life - period + 1) * 2 / (life * (life + 1))


def ddb(cost: Column, salvage: Column, life, period, factor: float = 2.0) -> Column:
    """Declining balance: what a period takes, never below the salvage value."""
    rate = F.least(lit(factor) / lit(life), F.lit(1.0))
    left = lambda k: F.greatest(cost * F.pow(1 - rate, lit(k)), F.least(salvage, cost))
    return F.greatest(left(lit(period) - 1) - left(period), F.lit(0.0))


def db(cost: Column, salvage: Column, life, period) -> Column:
    """Fixed declining balance with a rate of three places, whole first year."""
    rate = F.round(1 - F.pow(salvage / cost, 1 / lit(life)), 3)
    return cost * F.pow(1 - rate, lit(period) - 1) * rate


def convert(x: Column, source: str, target: str) -> Column:
    """CONVERT between units of one dimension; null between others and for names that are no unit."""
    if source not in UNITS or target not in UNITS:
        return F.lit(None).cast("double")
    (a, f, o), (b, g, p) = UNITS[source], UNITS[target]
    return (x * f + o - p) / g if a == b else F.lit(None).cast("double")
