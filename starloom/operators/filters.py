"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def search(df: DataFrame, query: str) -> DataFrame:
    """Rows in which any column contains ``query``, ignoring case."""
    cells = F.array(*[F.lower(F.col(c).cast("string")) for c in df.columns])
    needle = F.lit(query.lower())
    return df.where(F.exists(cells, lambda cell: F.coalesce(F.contains(cell, needle), F.lit(False))))


def hash_sample(df: DataFrame, key: str, percent: int, seed: int = 0) -> DataFrame:
    """About ``percent`` % of the keys, with all their rows.

    The choice depends on key and seed only, so it is the same however the rows are
    partitioned, and a recomputed task or another engine picks the same rows again. Rows
    without a key are one key.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return df.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100 < percent)
