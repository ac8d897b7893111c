"""Aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def totals(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Sum per key; rows with a missing key are left out, an all-missing sum is 0."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.where(complete)
        .groupBy(*keys)
        .agg(F.coalesce(F.sum(amount), F.lit(0)).alias(amount))
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Row count per value, most frequent first; missing values are left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def share_of_max(counts: DataFrame, n: str = "n") -> DataFrame:
    """Each count as a whole percentage of the largest one (bar width)."""
    largest = counts.agg(F.max(n)).scalar()
    return counts.withColumn("pct", F.round(F.lit(100) * F.col(n) / largest).cast("bigint"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and first four columns of every table."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table"), "n_rows", F.lit(", ".join(df.columns[:4])).alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
