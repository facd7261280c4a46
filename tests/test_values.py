"""Rules of single functions, on values whose results are documented."""

import datetime

import pytest
from pyspark.sql import functions as F

from quiltgrid.functions import values as V
from quiltgrid.functions.criteria import criterion
from quiltgrid.operators import columns as C
from quiltgrid.operators import compat as P

D = lambda s: F.lit(s).cast("date")
X = lambda x: F.lit(float(x))

def cases():
    return [
    (V.round_half_away(X(2.5)), 3.0), (V.round_half_away(X(-2.5)), -3.0), (V.round_half_away(X(1.005), 2), 1.01), (V.round_up(X(3.2)), 4.0), (V.round_up(X(-3.14159), 1), -3.2), (V.round_down(X(-3.9)), -3.0), (V.round_down(X(31415.92654), -2), 31400.0),
    (V.mround(X(10), 3.0), 9.0), (V.mround(X(-10), -3.0), -9.0), (V.mround(X(5), -2.0), None), (V.mod(X(3), -2), -1.0), (V.mod(X(-3), 2), 1.0), (V.mod(X(3), 0), None), (V.quotient(X(-10), 3), -3),
    (V.even(X(1.5)), 2.0), (V.even(X(-1)), -2.0), (V.odd(X(1.5)), 3.0), (V.odd(X(-2)), -3.0), (V.odd(X(0)), 1.0), (V.floor_math(X(-8.1), 2), -10.0), (V.floor_math(X(-5.5), 2, -1), -4.0), (V.ceiling_math(X(-8.1), 2), -8.0), (V.ceiling(X(-45.67), -2.0), -46.0), (V.ceiling(X(2.5), -2.0), None),
    (V.sqrt(X(-16)), None), (V.power(X(-8), 0.5), None), (V.proper(F.lit("76BudGet o'brien")), "76Budget O'Brien"), (V.trim(F.lit("  a  b ")), "a b"), (V.clean(F.lit("a\tb\n")), "ab"), (V.char(F.lit(0)), None), (V.char(F.lit(65)), "A"),
    (V.text_before(F.lit("a-b-c"), "-", 2), "a-b"), (V.text_before(F.lit("a-b-c"), "-", -1), "a-b"), (V.text_before(F.lit("abc"), "-"), None), (V.text_after(F.lit("a-b-c"), "-"), "b-c"), (V.text_after(F.lit("a-b-c"), "-", -1), "c"), (V.text_after(F.lit("a-b-c"), "-", 3), None),
    (V.find("b", F.lit("aBb")), 3), (V.find("z", F.lit("abc")), None), (V.search("B?D", F.lit("abcd")), 2), (V.search("n*e", F.lit("printer nose")), 4), (V.substitute(F.lit("a.a.a"), "a", "b", 2), "a.b.a"), (V.substitute(F.lit("aaa"), "A", "b"), "aaa"), (V.replace_at(F.lit("abcdef"), 3, 2, "XY!"), "abXY!ef"),
    (V.right(F.lit("abc"), 5), "abc"), (V.to_number(F.lit("$1,234.50")), 1234.5), (V.to_number(F.lit("50%")), 0.5), (V.to_number(F.lit("x")), None), (V.to_serial(F.lit("2024-03-15 12:00:00").cast("timestamp")), 45366.5),
    (V.make_date(2024, 13, 1), datetime.date(2025, 1, 1)), (V.make_date(2024, -1, 15), datetime.date(2023, 11, 15)), (V.make_date(2024, 3, 0), datetime.date(2024, 2, 29)), (V.edate(D("2024-01-31"), 1.9), datetime.date(2024, 2, 29)), (V.eomonth(D("2024-01-15"), -2), datetime.date(2023, 11, 30)),
    (V.date_dif(D("2024-01-31"), D("2024-02-29"), "M"), 0), (V.date_dif(D("1990-06-15"), D("2024-06-15"), "Y"), 34), (V.date_dif(D("2024-02-01"), D("2024-01-01"), "D"), None), (V.days360(D("2024-01-31"), D("2024-03-31")), 60), (V.year_frac(D("2026-01-01"), D("2026-07-01")), 0.5),
    (V.workdays(D("2024-01-01"), D("2024-01-31")), 23), (V.workdays(D("2024-01-31"), D("2024-01-01")), -23), (V.workday_after(D("2024-01-05"), F.lit(1)), datetime.date(2024, 1, 8)), (V.workday_after(D("2024-01-06"), F.lit(1)), datetime.date(2024, 1, 8)),
    (V.radix(F.lit(5), 2, 8), "00000101"), (V.radix(F.lit(-1), 16, bits=40), "FFFFFFFFFF"), (V.from_radix(F.lit("1111111111"), 2, bits=10), -1), (V.combin(X(8), 2), 28.0), (V.combin(X(5), 0), 1.0), (V.double_factorial(F.lit(7)), 105.0), (V.double_factorial(F.lit(0)), 1.0),
    (F.round(V.pmt(0.08 / 12, 10, 10000.0), 2), -1037.03), (F.round(V.fv(0.06 / 12, 10, -200.0, -500.0), 2), 2571.18), (F.round(V.nper(0.01, -100.0, 1000.0), 4), 10.5886), (F.round(V.effect(X(0.0525), 4), 6), 0.053543), (F.round(V.convert(X(68), "F", "C"), 6), 20.0), (V.convert(X(1), "m", "kg"), None),
    (V.ddb(X(2400), X(300), 10, 1), 480.0), (F.round(V.db(X(1000000), X(100000), 6, 1), 2), 319000.0), (V.syd(X(30000), X(7500), 10, 1), 4090.909090909091), (V.sln(X(30000), X(7500), 10), 2250.0),
    (C.type_number(F.lit("#N/A")), 16), (C.type_number(F.lit("TRUE")), 4), (C.error_number(F.lit("#DIV/0!")), 2), (C.error_number(F.lit("x")), None), (C.as_n(F.lit("7")), 7.0), (C.as_n(F.lit("x")), 0.0),
    (V.weeknum(D("2024-01-07")), 2), (V.weeknum(D("2024-01-07"), 2), 1), (V.weeknum(D("2021-01-01"), 21), 53), (V.time_of(27, 0, 0), 0.125), (V.time_of(0, -30, 0), 47 / 48), (V.time_value(F.lit("2:24 pm")), 0.6), (V.time_value(F.lit("06:00")), 0.25), (V.time_value(F.lit("x")), None),
    (V.number_value(F.lit("2.500,27"), ",", "."), 2500.27), (V.number_value(F.lit("9%%")), 0.0009), (V.log(X(8), 2.0), 3.0), (V.log(X(0)), None), (V.multinomial(F.lit(2), F.lit(3), F.lit(4)), 1260.0), (V.fixed(X(1234.567), 1), "1,234.6"), (V.fixed(X(-1234.567), 1, False), "-1234.6"), (V.dollar(X(-99.888)), "($99.89)"), (V.value_to_text(X(5)), "5"), (V.value_to_text(F.lit('a"b'), True), '"a""b"'),
    (V.text(X(1234.567), "$#,##0.00"), "$1,234.57"), (V.text(X(0.285), "0.0%"), "28.5%"), (V.text(X(12200000), "0.00E+00"), "1.22E+07"), (V.text(X(0.000999), "0.0E+0"), "1.0E-3"), (V.text(X(1234), "0000000"), "0001234"),
    (V.text(X(45356), "yyyy-mm-dd"), "2024-03-05"), (V.text(X(45356), "dddd"), "Tuesday"), (V.text(X(45356.75), "h:mm AM/PM"), "6:00 PM"), (V.text(X(45356.75), "mmm d, yyyy hh:mm:ss"), "Mar 5, 2024 18:00:00"), (V.text(X(1.5), "[h]:mm"), "36:00"), (V.text(X(1.5), "[m]"), "2160"),
    (V.text(X(-5), "0.0;(0.0);zero"), "(5.0)"), (V.text(X(0), "0.0;(0.0);zero"), "zero"), (V.text(X(-5), "0.0"), "-5.0"), (V.text(X(-0.01), "0.0"), "0.0"), (V.text(X(2.5), "#.##"), "2.5"), (V.text(X(1234567), "#,##0,"), "1,235"), (V.text(X(7), '"no. "0'), "no. 7"), (V.text(X(0.5), ".00"), ".50"),
    (F.round(V.ipmt(0.005, 1, 360, -300000.0), 2), 1500.0), (F.round(V.ppmt(0.005, 1, 360, -300000.0), 2), 298.65), (F.round(V.cumipmt(0.005, 360, 300000.0, 1, 1), 2), -1500.0), (F.round(V.cumprinc(0.005, 360, 300000.0, 1, 1), 2), -298.65), (V.ipmt(0.005, 0, 360, 1.0), None),
    (V.ipmt(0.1, 1, 3, 100.0, 0.0, 1), 0.0), (V.ipmt(0.0, 2, 3, 90.0), 0.0), (V.ppmt(0.0, 2, 3, 90.0), -30.0), (F.round(V.rate(360, -1798.65, 300000.0) * 12, 4), 0.06), (V.rate(3, 1.0, 1.0), None),
    (V.combina(X(4), 3), 20.0), (V.combina(X(5), 2), 15.0), (V.combina(X(10), 0), 1.0), (V.combina(X(0), 0), 1.0), (V.to_number(F.lit("1 2")), None), (V.to_number(F.lit("5$3")), None), (V.to_number(F.lit("(5)")), -5.0), (V.to_number(F.lit("$1,000")), 1000.0), (V.to_number(F.lit("1,0")), None), (V.to_number(F.lit("-$2.5")), -2.5), (V.to_number(F.lit("")), None),
    (P.version_key(F.lit("24.x8.")), [24, 8, 0]), (P.version_key(F.lit("")), []), (P.normalize_label(F.lit("LibreOffice 24")), "libreoffice"), (P.normalize_label(F.lit("abacus")), None), (P.extract_calls(F.lit('=IF(sum(A1)>1,"MAX(",SUM(B1))')), ["IF", "SUM"]),
    (P.rewrite_tokens(F.lit("=SORT(A1)+SORTBY(B1)+XSORT(1)"), {"SORT": "_x.", "SORTBY": "_y."}), "=_x.SORT(A1)+_y.SORTBY(B1)+XSORT(1)"), (P.cells_equal(X(1), X(1.0000000001)), True), (P.cells_equal(F.lit(""), F.lit(None).cast("string"), "text"), True), (P.cells_equal(X(1), X(1.1)), False), (P.cells_equal(F.lit("1"), F.lit("1.0"), "text"), False),
    (P.arrays_detail(F.array(X(1), X(2)), F.array(X(1), X(3))), "a cell should be 2.0, is 3.0"),
    (P.arrays_equal(F.array(X(1), X(2)), F.array(X(1))), False), (P.arrays_equal(F.lit(None).cast("array<double>"), F.array(X(1))), None),
    ]


def test_values(spark):
    known = cases()
    results = spark.range(1).select(*(c.alias(f"c{i}") for i, (c, _) in enumerate(known))).first()
    wrong = []
    for i, (_, expected) in enumerate(known):
        if results[i] != (pytest.approx(expected) if isinstance(expected, float) else expected):
            wrong.append((i, results[i], expected))
    assert not wrong


def test_criteria(spark):
    rows = spark.createDataFrame([("apple",), ("Apple",), ("10",), ("",), (None,), ("pineapple",), ("a*b",)], "v string")
    count = lambda text: rows.where(criterion(F.col("v"), text)).count()
    assert [count(t) for t in ("apple", "*apple", "<>apple", ">5", "=", "<>", "", "?pple", "a~*b", ">=b")] == [2, 3, 5, 1, 2, 5, 2, 2, 1, 1]
