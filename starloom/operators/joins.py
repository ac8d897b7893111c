"""Joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits a hot partition of a sort-merge join only when both inputs
come straight out of a shuffle, and only on the side the join type lets it split. The
helpers here bring a join into that form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.session import stage


def as_lookup(df: DataFrame, name: str = "lookup") -> DataFrame:
    """Write a derived lookup (one row per key) and read it back.

    A written table has a known size, so Catalyst broadcasts it only when it is below
    ``spark.sql.autoBroadcastJoinThreshold``; above that it is shuffled as a plain scan,
    which leaves hot keys of the other side splittable. A frame that was just grouped on
    the join key would be neither.
    """
    return stage(df, name)


def left_to_many(one: DataFrame, many: DataFrame, on: str) -> DataFrame:
    """``one`` LEFT JOIN ``many`` where a key may have very many rows in ``many``.

    A left join cannot split its right side, an inner join can. So: the inner join, plus
    the rows of ``one`` without a partner, found against the distinct keys of ``many``.
    Column names other than ``on`` must differ. ``one`` should be a written table.
    """
    matched = one.join(many, on)
    lonely = one.join(many.select(on).distinct(), on, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def keep_keys(df: DataFrame, ids: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key occurs in ``ids`` (which may repeat keys)."""
    return df.join(ids, on, "left_semi")
