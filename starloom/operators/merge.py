"""Combining a table with newly arrived rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.operators.keys import keep_first, keep_last


def append_aligned(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows of both; a column only one side has is NULL on the other."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def upsert_latest(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """One row per key: the last in ``order_by`` over both sides, incoming after existing."""
    both = append_aligned(
        existing.withColumn("_side", F.lit(0)), incoming.withColumn("_side", F.lit(1))
    )
    return keep_last(both, keys, ["_side", *order_by]).drop("_side")


def new_rows(
    existing: DataFrame, incoming: DataFrame, key: str, order_by: Sequence[str]
) -> DataFrame:
    """The incoming rows an insert-if-absent adds: first per key, key not there yet."""
    first = keep_first(incoming.where(F.col(key).isNotNull()), [key], order_by)
    return first.join(existing.select(key), key, "left_anti").select(*incoming.columns)


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, key: str, order_by: Sequence[str]
) -> DataFrame:
    """The table after an insert-if-absent: existing rows win over incoming ones."""
    return append_aligned(existing, new_rows(existing, incoming, key, order_by))
