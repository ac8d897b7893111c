from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import codes, dates, numbers, text


def evaluate(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("c"))).collect()]


def test_strip_handles_every_kind_of_white_space(spark):
    values = ["  a b ", "\t x\n", " \t y 　 ", "", "   ", None, "z\x1f", "\x85q"]
    assert evaluate(spark, text.strip, values) == [v.strip() if v is not None else None for v in values]


def test_title_case_agrees_with_python(spark):
    values = ["o'neil", "mcDONALD-smith", "3rd street", "éCOLE d'été", "SMITH", "a_b", "", None, "new  york", "x9y"]
    assert evaluate(spark, text.title_case, values) == [v.title() if v is not None else None for v in values]


def test_null_tokens_are_not_stripped_first(spark):
    values = ["", "NA", "null", "N/A", "NaN", "None", " NA", "Nan", "ok", None]
    assert evaluate(spark, lambda _: text.null_token("c"), values) == [None] * 6 + [" NA", "Nan", "ok", None]


def test_load_values_are_stripped_first(spark):
    values = ["", "  ", "nan", " NaT ", "None", "none", " ok "]
    assert evaluate(spark, text.load_value, values) == [None] * 5 + ["none", " ok "]


def test_canonical_codes(spark):
    fn = lambda c: text.canonical(text.strip(c), codes.REGIONS)
    assert evaluate(spark, fn, [" eAsT ", "ea", "So", " Mars ", None, ""]) == [
        "EAST", "EAST", "SOUTH", "Mars", None, "",
    ]


def test_installments_default_to_one(spark):
    fn = lambda c: text.lookup(c, codes.INSTALLMENTS, 1)
    assert evaluate(spark, fn, ["Monthly", "Quarterly", "Annual", "weekly", None]) == [12, 4, 1, 1, 1]


def test_ids(spark):
    values = ["7", "07", "701.0", "1e3", " 12 ", "7.5", "abc", "-4", "", "1d", "NaN", "inf", None]
    assert evaluate(spark, numbers.to_id, values) == [
        7, 7, 701, 1000, 12, None, None, -4, None, None, None, None, None,
    ]
    values = ["701.0000004", "9223372036854775807", "9223372036854775808", "9223372036854775807.0", "1.5e1", "1.55e1", "+8", "5."]
    assert evaluate(spark, numbers.to_id, values) == [None, 2**63 - 1, None, 2**63 - 1, 15, None, 8, 5]


def test_amounts(spark):
    values = ["0", "-1", "x", "1e3", "1d", "NaN", "12.5"]
    assert evaluate(spark, numbers.to_amount, values) == [
        Decimal("0.00"), Decimal("-1.00"), None, Decimal("1000.00"), None, None, Decimal("12.50"),
    ]
    exact = evaluate(spark, numbers.to_exact, ["0.004", "-0.004", "1e14", "x", None])
    assert exact == [Decimal("0.004"), Decimal("-0.004"), None, None, None]


def test_half_even(spark):
    values = [Decimal("0.125"), Decimal("0.375"), Decimal("0.135"), Decimal("-0.125")]
    assert evaluate(spark, numbers.half_even, values, "decimal(9,3)") == [
        Decimal("0.12"), Decimal("0.38"), Decimal("0.14"), Decimal("-0.12"),
    ]


def test_nan_is_null(spark):
    assert evaluate(spark, numbers.nan_to_null, [float("nan"), 1.0, None], "double") == [None, 1.0, None]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("2024-01-05", dt.date(2024, 1, 5)),
        ("2024-1-5", dt.date(2024, 1, 5)),
        (" 2024-01-05 ", dt.date(2024, 1, 5)),
        ("2024-01-05 10:11:12", dt.date(2024, 1, 5)),
        ("01/05/2024", dt.date(2024, 1, 5)),
        ("2024/1/5", dt.date(2024, 1, 5)),
        ("20240105", dt.date(2024, 1, 5)),
        ("5-Jan-2024", dt.date(2024, 1, 5)),
        ("9999-12-31", dt.date(9999, 12, 31)),
        ("2024-02-30", None),
        ("13/45/2024", None),
        ("not a date", None),
        ("soon-ish", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, given, expected):
    assert evaluate(spark, dates.parse_date, [given]) == [expected]


def test_date_formats_and_year(spark):
    day = [dt.date(2012, 1, 2), dt.date(2012, 12, 31), dt.date(2013, 1, 1), None]
    assert evaluate(spark, dates.us, day, "date") == ["01/02/2012", "12/31/2012", "01/01/2013", None]
    assert evaluate(spark, dates.iso, day, "date")[0] == "2012-01-02"
    assert evaluate(spark, lambda c: dates.in_year(c, 2012), day, "date") == [True, True, False, None]


def test_names(spark):
    df = spark.createDataFrame([("Mr.", "A", "B"), (None, "A", "B"), ("Mr.", None, "B")], "t string, f string, l string")
    names = df.select(text.joined_name(F.col("t"), F.col("f"), F.col("l")), text.strict_name(F.col("t"), F.col("f"), F.col("l")))
    assert [tuple(r) for r in names.collect()] == [("Mr. A B", "Mr. A B"), ("A B", None), ("Mr.  B", None)]


def test_display(spark):
    assert evaluate(spark, lambda c: text.display(c, True), [1234567, None], "bigint") == ["1,234,567", "—"]
    assert evaluate(spark, lambda c: text.display(c, True), [Decimal("1234.50")], "decimal(9,2)") == ["1,234.5"]
    assert evaluate(spark, lambda c: text.display(c, False), ["x", "", None]) == ["x", "—", "—"]
