"""Attribute changes between snapshots and over a history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from starloom.operators.joins import as_lookup


def snapshot_changes(
    previous: DataFrame, current: DataFrame, key: str, attributes: Sequence[str]
) -> DataFrame:
    """Rows of ``current`` whose first attribute differs from the previous snapshot.

    Every attribute comes back twice, as ``Current_*`` and ``Previous_*``. A value that
    appears or disappears is a change; two missing values are not. Both snapshots hold
    one row per key.
    """
    before = previous.select(key, *[F.col(a).alias("Previous_" + a) for a in attributes])
    now = current.withColumnsRenamed({a: "Current_" + a for a in attributes})
    same = F.col("Current_" + attributes[0]).eqNullSafe(F.col("Previous_" + attributes[0]))
    return now.join(before, key).where(~same)


def history_changes(
    history: DataFrame, key: str, batch: str, order_by: str, attributes: Sequence[str]
) -> DataFrame:
    """Changes from each batch to the batch before it in which the key occurred.

    A key's rows are first reduced to its last state per batch with a partial aggregate,
    so the ordered window sees at most one row per key and batch, however often the key
    occurs.
    """
    last = F.max_by(F.struct(*attributes), F.col(order_by)).alias("_state")
    states = history.groupBy(key, batch).agg(last)
    before = Window.partitionBy(key).orderBy(batch)
    compared = states.select(
        key,
        batch,
        F.col("_state"),
        F.lag("_state").over(before).alias("_before"),
        F.lag(batch).over(before).alias("Previous_" + batch),
    ).where(F.col("Previous_" + batch).isNotNull())
    first = attributes[0]
    changed = compared.where(~F.col(f"_state.{first}").eqNullSafe(F.col(f"_before.{first}")))
    return changed.select(
        key,
        batch,
        "Previous_" + batch,
        *[F.col(f"_state.{a}").alias("Current_" + a) for a in attributes],
        *[F.col(f"_before.{a}").alias("Previous_" + a) for a in attributes],
    )


def keys_with_many_values(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys with more than one distinct non-null value.

    Smallest < largest says the same as count(distinct) > 1 and needs one shuffle of one
    row per key and task instead of one row per key and value.
    """
    return (
        df.groupBy(key)
        .agg(F.min(attribute).alias("_low"), F.max(attribute).alias("_high"))
        .where("_low < _high")
        .select(key)
    )


def multi_value_history(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """All versions of the keys whose attribute took more than one value."""
    many = as_lookup(keys_with_many_values(df, key, attribute), "changed-keys")
    return df.join(many, key, "left_semi")
