"""Ordered limits and pages. ``order_by`` must be a total order."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

SORTED = 10_000  # a range of so many rows is sorted, larger ones are narrowed first
PIVOTS = 48


def _ordered(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order_by]


def top(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows; a named column puts nulls last, as :func:`page` does."""
    return df.orderBy(*_ordered(order_by)).limit(n)


@dataclass(frozen=True)
class SortKey:
    """One column of an order, so that rows can be compared with a value."""

    name: str
    descending: bool = False
    nulls_first: bool = False

    def before(self, value: object) -> Column:
        """Rows that come before those with ``value`` in this column."""
        c = F.col(self.name)
        if value is None:
            return F.lit(False) if self.nulls_first else c.isNotNull()
        return F.coalesce(c > F.lit(value) if self.descending else c < F.lit(value), F.lit(self.nulls_first))

    def same(self, value: object) -> Column:
        return F.col(self.name).isNull() if value is None else F.col(self.name).eqNullSafe(F.lit(value))


def sort_keys(order_by: Sequence[str | Column]) -> list[SortKey]:
    """The keys of an order over plain columns."""
    keys = []
    for c in order_by:
        told = None if isinstance(c, str) else re.fullmatch(r"Column<'(\w+)(?: (ASC|DESC) NULLS (FIRST|LAST))?'>", str(c))
        if not isinstance(c, str) and not told:
            raise ValueError(f"pages are ordered by columns, not by {c}; add the expression as a column")
        keys.append(SortKey(c) if told is None else SortKey(told[1], told[2] == "DESC", told[3] != "LAST"))
    return keys


def _before(keys: Sequence[SortKey], values: Sequence[object]) -> Column:
    """Rows that come before the row with these key values."""
    found, equal = F.lit(False), F.lit(True)
    for key, value in zip(keys, values):
        found = found | (equal & key.before(value))
        equal = equal & key.same(value)
    return found


def _narrowed(
    df: DataFrame, keys: Sequence[SortKey], order: Sequence[Column], first: int, size: int, most: int
) -> tuple[DataFrame, int]:
    """The rows of a range of the order that holds the page, and how many of them come before it.

    Rows with the smallest hashes cut the range; the rows before each cut are counted exactly in one
    aggregate, and the narrowest pair of cuts around the page is the next range.
    """
    n = df.count()
    while n > most and first < n:
        names = [k.name for k in keys]
        drawn = df.select(*names).orderBy(F.xxhash64(*names), *order).limit(PIVOTS)
        cuts = [tuple(r) for r in drawn.orderBy(*order).collect()]
        counts = df.agg(*[F.count_if(_before(keys, cut)).alias(f"n{i}") for i, cut in enumerate(cuts)]).first()
        low = max(((c, i) for i, c in enumerate(counts) if c <= first), default=(0, None))
        high = min(((c, i) for i, c in enumerate(counts) if c >= first + size), default=(n, None))
        if high[0] - low[0] == n:
            break  # cuts are all alike or the page spans the range
        if high[1] is not None:
            df = df.where(_before(keys, cuts[high[1]]))
        if low[1] is not None:
            df = df.where(~_before(keys, cuts[low[1]]))
        n, first = high[0] - low[0], first - low[0]
    return df, first


def page(
    df: DataFrame, order_by: Sequence[str | Column], page_no: int, size: int = 20, most: int = SORTED
) -> DataFrame:
    """Page ``page_no`` (from 0), at any depth: exact counts narrow the order to a range of about
    ``most`` rows that holds the page, and only that range is sorted. The number of passes grows
    with the logarithm of the rows; nothing is written."""
    keys, order = sort_keys(order_by), _ordered(order_by)
    found, skipped = _narrowed(df, keys, order, page_no * size, size, most)
    return found.orderBy(*order).offset(skipped).limit(size)


def page_token(row: Row | Mapping[str, object], order_by: Sequence[str | Column]) -> list[object]:
    """Where a page ends: the key values of its last row."""
    return [row[k.name] for k in sort_keys(order_by)]


def page_after(df: DataFrame, order_by: Sequence[str | Column], token: Sequence[object], size: int = 20) -> DataFrame:
    """The page that follows the row of ``token``: one filter and the first rows, at any depth."""
    keys = sort_keys(order_by)
    here = reduce(lambda a, b: a & b, (k.same(v) for k, v in zip(keys, token)))
    return df.where(~_before(keys, token) & ~here).orderBy(*_ordered(order_by)).limit(size)
