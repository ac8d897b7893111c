"""Declared constraints as checks: primary keys, foreign keys, NOT NULL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent row, with their row counts.

    Counted per value before the join, so a frequent value travels once per task.
    """
    used = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk)).agg(F.count("*").alias("n_rows"))
    return used.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def null_out_orphans(
    child: DataFrame, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Set foreign keys without a parent row to NULL (ON DELETE SET NULL).

    ``references`` maps a child column to its parent and the parent's (unique) key.
    """
    columns = child.columns
    for fk, (parent, pk) in references.items():
        known = parent.select(F.col(pk).alias("_known"))
        child = child.join(known, child[fk] == known["_known"], "left")
        child = child.withColumn(fk, F.col("_known")).drop("_known")
    return child.select(*columns)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: how many rows break NOT NULL."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns]
    return counted.select(F.inline(F.array(*entries)))
