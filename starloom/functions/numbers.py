"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from starloom.schemas import MONEY

EXACT = T.DecimalType(38, 18)


def to_amount(c: Column) -> Column:
    """Text to money; anything that is not a finite number becomes NULL."""
    return c.try_cast(MONEY)


def to_exact(c: Column) -> Column:
    """Text that :func:`to_amount` accepts, before rounding: what decides whether it is positive."""
    return F.when(to_amount(c).isNotNull(), c.try_cast(EXACT))


def to_id(c: Column) -> Column:
    """Text to a BIGINT key; ``701.0``, ``07`` and ``1e3`` are whole, ``7.5`` and ``701.0000004`` are not.

    The shape test matters for speed only: a failed cast costs an exception, and a column
    of ``701.0`` texts would fail one on every row.
    """
    plain = F.when(c.rlike(r"^-?\d{1,18}$"), c.try_cast("bigint"))
    whole = F.when(c.rlike(r"^\s*[+-]?\d+\.?0*\s*$"), c.try_cast("decimal(38,6)").try_cast("bigint"))
    number = F.when(c.rlike("[eE]"), c.try_cast("decimal(38,18)"))
    power = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(plain, whole, power)


def half_even(c: Column, digits: int = 2) -> Column:
    """Banker's rounding: 0.125 -> 0.12, 0.375 -> 0.38."""
    return F.bround(c, digits)


def nan_to_null(c: Column) -> Column:
    """NaN compares greater than everything in Spark; make it NULL before comparing."""
    return F.when(~F.isnan(c), c)
