"""The incremental load: one batch after the other into the warehouse.

Per batch: land the raw files, validate, standardize, extend the dimensions, build the
fact, detect changes, report. Every table is partitioned by batch and a batch only ever
replaces its own partition, so loading it again changes nothing and the cost follows the
increment. All tables of a load are written aside and published as one version: a load that
is refused or lost leaves every table, silver and report included, as it was. Surrogate keys go
on from the largest key of the earlier batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.operators import keys, model
from starloom.operators.changes import multi_value_history, snapshot_changes
from starloom.operators.joins import as_lookup, keep_keys
from starloom.operators.keys import ORDINAL
from starloom.operators.quality import RAW, REJECTED_BY, quarantine_all
from starloom.operators.standardize import standardize
from starloom.schemas import DEFAULTS, FACT_TOTALS, GOLD, conform
from starloom.session import staging, together
from starloom.sources import key_index
from starloom.sources.key_index import CUSTOMER_KEYS, POLICY_KEYS, KeyIndex
from starloom.sources.raw import read_batch
from starloom.sources.warehouse import Load, Warehouse


def land(load: Load, raw: Mapping[str, DataFrame], batch_id: int) -> dict[str, DataFrame]:
    """Write raw rows once, with their place in the file, and read them from there.

    Only for the tables with a uniqueness rule, which are read several times. Transactions
    are by far the largest and have none; they go from the file straight to silver.
    """
    landed = {t: df for t, df in raw.items() if t != "transactions"}
    bronze = dict(raw)

    def write(table: str) -> None:
        bronze[table] = load.write(landed[table], "bronze", table, batch_id)

    together(*[partial(write, t) for t in landed])
    return bronze


@contextmanager
def _a_writer_per_rule(spark: SparkSession) -> Iterator[None]:
    """Tasks keep the files of all rules open, instead of sorting their rows by rule first: rows
    stay in file order, which the numbering of transactions uses."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "64")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def clean(
    load: Load, bronze: Mapping[str, DataFrame], batch_id: int, strict: bool = False
) -> dict[str, DataFrame]:
    """Validate and standardize; write silver, the rejected rows beside the good ones under the
    number of their rule, and the validation report, which is counted from these numbers."""
    checked = quarantine_all(bronze, [ORDINAL], strict)
    written: dict[str, DataFrame] = {}

    def write(table: str) -> None:
        rows = standardize(checked[table].rows, table)
        written[table] = load.write(rows, "silver", table, batch_id, [REJECTED_BY])

    with _a_writer_per_rule(load.spark):
        together(*[partial(write, t) for t in checked])
    report = None
    for table, tagged in checked.items():
        one = tagged.report(written[table])
        report = one if report is None else report.unionByName(one)
    load.write(report.coalesce(1), "gold", "validation_report", batch_id)
    return {t: df.where(F.col(REJECTED_BY) == 0).drop(REJECTED_BY, RAW) for t, df in written.items()}


def _differ(one: DataFrame, other: DataFrame) -> bool:
    """Whether two tables hold different rows, keys included, however often."""
    return not (one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty())


def _extend(
    load: Load, batch_id: int, fixed: bool, table: str, key: str, build: Callable[[int], DataFrame]
) -> None:
    """Write a batch of a keyed table; ``build`` gets the largest earlier key. ``fixed``: later
    batches refer to this one, so it may only be published as it is."""
    start = load.last_key(table, batch_id)
    rows = load.write(build(start), "gold", table, batch_id)
    if fixed:
        published = load.published().gold(table, lambda b: b == batch_id)
        if _differ(published.select(*rows.columns), rows):
            raise ValueError(
                f"{table}: the rows or keys of batch {batch_id} changed, and later batches refer to "
                "them; load it and all later batches with reload=True"
            )
    load.note_last_key(table, batch_id, rows.agg(F.max(key)).first()[0] or start)


def transform(
    load: Load,
    silver: Mapping[str, DataFrame],
    batch_id: int,
    same_batch_only: bool = False,
    reload: bool = False,
) -> None:
    """Extend dimensions, fact and change tables by one batch.

    Keys, due dates and former types are looked up in the index of current keys after this batch
    (in all dimension rows where batches were loaded without one), or in this batch's rows only
    with ``same_batch_only``.
    """
    fixed = not reload and any(b > batch_id for b in load.loaded())
    extend = partial(_extend, load, batch_id, fixed)
    together(
        partial(extend, "dim_customer", "Customer_SK",
                lambda start: model.dim_customer(silver["customers"], [ORDINAL], start)),
        partial(extend, "dim_policy", "Policy_SK",
                lambda start: model.dim_policy(silver["policies"], [ORDINAL], start)),
        partial(extend, "dim_address", "Address_SK",
                lambda start: model.dim_address(silver["address"], [ORDINAL], start)),
    )

    own = partial(load.gold, batches=lambda b: b == batch_id)
    customers = own("dim_customer").select("Customer_ID", "Customer_SK").unionByName(
        own("dim_address").select("Customer_ID", "Address_SK"), allowMissingColumns=True
    )
    together(
        partial(key_index.extend, load, POLICY_KEYS, own("dim_policy"), batch_id),
        partial(key_index.extend, load, CUSTOMER_KEYS, customers, batch_id),
    )

    def arrived(key: str, index: KeyIndex, *tables: str) -> list[DataFrame]:
        # Only the keys that the batch pays for are looked up; a written list has a known size.
        ids = as_lookup(silver["transactions"].select(key).where(F.col(key).isNotNull()).distinct(), "arrived-keys")
        current = None if same_batch_only else _current(load, index, ids, lambda b: b <= batch_id)
        if current is not None:
            return [current] * len(tables)
        known = [load.gold(t, lambda b: b == batch_id if same_batch_only else b <= batch_id) for t in tables]
        return [keep_keys(df, ids, key) for df in known]

    def fact(start: int) -> DataFrame:
        numbered = keys.number_as_written(silver["transactions"], "Transaction_SK", start)
        by_customer = arrived("Customer_ID", CUSTOMER_KEYS, "dim_customer", "dim_address")
        rows = model.fact_rows(numbered, by_customer[0], *arrived("Policy_Id", POLICY_KEYS, "dim_policy"), by_customer[1])
        return conform(rows, GOLD["fact_transactions"], DEFAULTS["fact_transactions"])

    def fact_and_totals() -> None:
        extend("fact_transactions", "Transaction_SK", fact)
        summed = ["Premium_Amt", "Total_Policy_Amt", "Late_Fee"]
        totals = own("fact_transactions").groupBy("Customer_ID", "Customer_SK", "Policy_SK").agg(
            F.count("*").alias("n_rows"), *[F.sum(c).alias(c) for c in summed]
        )
        load.write(conform(totals, FACT_TOTALS), "gold", "fact_totals", batch_id)

    def changes(table: str, find: Callable[[], DataFrame]) -> None:
        load.write(find(), "gold", table, batch_id)

    together(
        fact_and_totals,
        partial(changes, "policy_changes", lambda: policy_changes(load, silver["policies"], batch_id)),
        partial(changes, "marital_changes", lambda: marital_changes(load, silver["customers"], batch_id)),
    )


def _current(load: Load, index: KeyIndex, ids: DataFrame, batches: Callable[[int], bool]) -> DataFrame | None:
    """One row for each of the keys that the index holds after some batches; None without an index."""
    found = key_index.state(load, index, key_index.buckets_of(ids, index.key), batches)
    return None if found is None else keep_keys(found, ids, index.key)


def marital_changes(load: Load, customers: DataFrame, batch_id: int) -> DataFrame:
    """Versions of a batch's customers with several marital statuses that no earlier batch has told.

    The first change of a customer brings all versions so far, later batches the new ones only.
    """
    arrived = customers.select("Customer_ID")
    known = load.gold("dim_customer", lambda b: b <= batch_id)
    versions = keep_keys(known, arrived, "Customer_ID")
    history = conform(
        multi_value_history(versions, "Customer_ID", "Marital_Status"), GOLD["marital_changes"]
    )
    told = keep_keys(load.gold("marital_changes", lambda b: b < batch_id), arrived, "Customer_ID")
    return history.exceptAll(told.select(*history.columns))


def policy_changes(load: Load, policies: DataFrame, batch_id: int) -> DataFrame:
    """Policies of a batch whose type differs from their latest earlier version."""
    attributes = ["Policy_Type_Id", "Policy_Type"]
    arrived = policies.select("Policy_Id")
    latest = _current(load, POLICY_KEYS, arrived, lambda b: b < batch_id)
    if latest is None:
        earlier = keep_keys(load.gold("dim_policy", lambda b: b < batch_id), arrived, "Policy_Id")
        latest = earlier.groupBy("Policy_Id").agg(*[F.max_by(a, "Policy_SK").alias(a) for a in attributes])
    latest = latest.select("Policy_Id", *attributes)
    changed = snapshot_changes(latest, policies, "Policy_Id", attributes)
    return conform(changed, GOLD["policy_changes"])


def add_batch(
    load: Load,
    raw: Mapping[str, DataFrame],
    batch_id: int,
    strict: bool = False,
    same_batch_only: bool = False,
    reload: bool = False,
) -> bool:
    """Add one batch to a load that is not yet published; False when all its tables are empty."""
    if all(df.isEmpty() for df in raw.values()):
        return False
    with staging(load.spark):
        bronze = land(load, raw, batch_id)
        silver = clean(load, bronze, batch_id, strict)
        transform(load, silver, batch_id, same_batch_only, reload)
    return True


def load_batch(warehouse: Warehouse, raw: Mapping[str, DataFrame], batch_id: int, **options: bool) -> bool:
    """Load and publish one batch; False when all its tables are empty and it was skipped.

    A batch may be loaded again at any time. If its content changed, that and every later
    batch has to be loaded with ``reload``, because their keys move or what they looked up does.
    """
    with warehouse.begin() as load:
        return add_batch(load, raw, batch_id, **options)


def load_batches(
    spark: SparkSession,
    source_root: str,
    warehouse_root: str,
    batch_ids: Iterable[int],
    multiline: bool = True,
    reload: bool = False,
    **options: bool,
) -> list[int]:
    """Load batches of raw CSV files in order; returns the ids that held data.

    Each batch is published by itself. With ``reload`` all of them are published at once, as the
    later ones do not fit the earlier ones until they are loaded again.
    """
    warehouse, ids = Warehouse(spark, warehouse_root), sorted(batch_ids)

    def raw(batch_id: int) -> dict[str, DataFrame]:
        return read_batch(spark, source_root, batch_id, multiline=multiline)

    if not reload:
        return [b for b in ids if load_batch(warehouse, raw(b), b, **options)]
    with warehouse.begin() as load:
        return [b for b in ids if add_batch(load, raw(b), b, reload=True, **options)]
