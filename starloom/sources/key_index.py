"""Current keys: one row per natural key, in hash buckets that a load replaces one by one.

A load merges the keys of its batch into the buckets that they fall into and writes these anew; the
manifest notes which buckets a batch wrote. The state after a batch is, per bucket, the newest one written
up to it, so a batch that is loaded again sees what it saw the first time. A lookup opens the buckets of
the keys it asks for: how many files that are does not depend on the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.schemas import GOLD
from starloom.sources.raw import empty
from starloom.sources.warehouse import Load, Warehouse

BUCKETS = 64
BUCKET, LAST = "bucket", "_last"


@dataclass(frozen=True)
class KeyIndex:
    """``first``: columns that keep their smallest value; ``latest``: those of the row with the largest ``order``."""

    table: str
    key: str
    first: tuple[str, ...]
    latest: tuple[str, ...] = ()
    order: str | None = None

    @property
    def schema(self) -> T.StructType:
        known = {f.name: f for t in ("dim_policy", "dim_customer", "dim_address") for f in GOLD[t].fields}
        order = [T.StructField(LAST, T.LongType())] if self.order else []
        return T.StructType([known[c] for c in (self.key, *self.first, *self.latest)] + order)


POLICY_KEYS = KeyIndex(
    "policy_keys", "Policy_Id", ("Policy_SK",), ("Next_Premium_Dt", "Policy_Type_Id", "Policy_Type"), "Policy_SK"
)
CUSTOMER_KEYS = KeyIndex("customer_keys", "Customer_ID", ("Customer_SK", "Address_SK"))


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def buckets_of(ids: DataFrame, key: str) -> list[int]:
    """The buckets that some keys fall into, at most ``BUCKETS`` numbers."""
    return sorted(r[0] for r in ids.where(F.col(key).isNotNull()).select(bucket_of(key)).distinct().collect())


def state(
    warehouse: Warehouse, index: KeyIndex, buckets: list[int], batches: Callable[[int], bool]
) -> DataFrame | None:
    """The keys of some buckets after the batches that ``batches`` takes; None where a batch was
    loaded without an index."""
    entries = sorted(((b, e) for b, e in warehouse.version().batches.items() if batches(b)), reverse=True)
    if any(index.table not in e.buckets for _, e in entries):
        return None
    paths = []
    for bucket in buckets:
        newest = next(((b, e) for b, e in entries if bucket in e.buckets[index.table]), None)
        if newest:
            paths.append(f"{warehouse.folder('index', index.table, newest[0], newest[1].load)}/{BUCKET}={bucket}")
    if not paths:
        return empty(warehouse.spark, index.schema)
    return warehouse.spark.read.schema(index.schema).parquet(*paths)


def extend(load: Load, index: KeyIndex, new: DataFrame, batch_id: int) -> None:
    """Merge the keys of a batch (rows as in its dimensions, several per key at will) into their buckets."""
    if index.order:
        new = new.withColumn(LAST, F.col(index.order))
    new = new.where(F.col(index.key).isNotNull()).select(*index.schema.names)
    touched = buckets_of(new, index.key)
    old = state(load, index, touched, lambda b: b < batch_id)
    if old is None:  # the batches before have none: leave it out, lookups search the dimensions
        return
    merged = old.unionByName(new).groupBy(index.key).agg(
        *[F.min(c).alias(c) for c in index.first],
        *[F.max_by(c, LAST).alias(c) for c in index.latest],
        *([F.max(LAST).alias(LAST)] if index.order else []),
    )
    # One file per bucket, more where a bucket is large.
    placed = merged.withColumn(BUCKET, bucket_of(index.key)).hint("rebalance", F.col(BUCKET))
    load.write(placed, "index", index.table, batch_id, [BUCKET])
    load.note_buckets(index.table, batch_id, touched)
