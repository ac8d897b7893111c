"""Date expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Texts in year-month-day order with dashes (a time may follow) are cast; these shapes
# are parsed otherwise. The shape test keeps junk away from the parser, where every miss
# costs an exception.
DATE_SHAPES = {
    r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy",
    r"^\d{4}/\d{1,2}/\d{1,2}$": "yyyy/M/d",
    r"^\d{8}$": "yyyyMMdd",
    r"^\d{1,2}-[A-Za-z]{3}-\d{4}$": "d-MMM-yyyy",
}


def parse_date(c: Column, shapes: Mapping[str, str] = DATE_SHAPES) -> Column:
    """Text to DATE; a text of no known shape, or no real date, becomes NULL."""
    text = F.trim(c)
    iso_date = F.when(F.contains(text, F.lit("-")), text.try_cast("date"))
    others = [F.when(text.rlike(shape), F.try_to_date(text, f)) for shape, f in shapes.items()]
    return F.coalesce(iso_date, *others)


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def us(c: Column) -> Column:
    return F.date_format(c, "MM/dd/yyyy")


def in_year(c: Column, year: int) -> Column:
    """Calendar-year test as a half-open range, which reaches the Parquet reader."""
    return (c >= F.lit(dt.date(year, 1, 1))) & (c < F.lit(dt.date(year + 1, 1, 1)))


def strictly_after(a: Column, b: Column) -> Column:
    """``a > b`` with a missing date on either side counting as false."""
    return F.coalesce(a > b, F.lit(False))
