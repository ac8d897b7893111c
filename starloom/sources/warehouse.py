"""The warehouse: Parquet tables in one folder per batch and load, published as whole versions."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.functions import numbers
from starloom.functions.dates import parse_date
from starloom.operators import aggregates, merge
from starloom.operators.columns import load_values_all
from starloom.operators.keys import ORDINAL, POSITION, with_position
from starloom.operators.quality import RAW, REJECTED_BY, rules_for
from starloom.schemas import DEFAULTS, FACT_TOTALS, GOLD, LOAD_ORDER, PRIMARY_KEYS, SILVER, conform
from starloom.session import stage, together
from starloom.sources import versions
from starloom.sources.raw import empty
from starloom.sources.versions import Entry, Version

BATCH, LOAD = "batch_id", "load"
CODEC = "zstd"  # about 0.6 of the size that Spark's default gives, written and read as fast
_STAMP = "%Y%m%dT%H%M%S"


@dataclass(frozen=True)
class Warehouse:
    """Tables below one root folder. ``layer`` is bronze, silver or gold.

    What is read is the newest published version, or version ``number``. Nothing that is
    published is ever written over: a load (:meth:`begin`) writes into folders of its own and is
    published as a whole, so whatever becomes of it, readers see all of it or nothing.
    """

    spark: SparkSession
    root: str
    number: int | None = None

    @property
    def _files(self) -> versions.Files:
        return versions.Files(self.spark)

    @property
    def _root(self) -> str:
        return self.root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self._root}/{layer}/{table}"

    def versions(self) -> list[int]:
        """Numbers of the versions that can be read, oldest first."""
        return versions.published(self._files, self._root)

    def version(self) -> Version:
        """The version that this warehouse reads."""
        number = max(self.versions(), default=0) if self.number is None else self.number
        return versions.read_version(self._files, self._root, number)

    def at(self, number: int) -> Warehouse:
        """The warehouse as published under ``number``, whatever is published later."""
        return Warehouse(self.spark, self.root, number)

    def folder(self, layer: str, table: str, batch_id: int, load: str) -> str:
        return f"{self.path(layer, table)}/{BATCH}={batch_id}/{LOAD}={load}"

    def read(
        self, layer: str, table: str, schema: T.StructType, batches: Callable[[int], bool] | None = None
    ) -> DataFrame:
        """A table with its declared schema plus ``batch_id``, of all batches or those that
        ``batches`` takes (the folders of others are not opened); no rows if never written."""
        full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        found = [
            self.folder(layer, table, b, e.load) for b, e in sorted(self.version().batches.items())
            if f"{layer}/{table}" in e.tables and (batches is None or batches(b))
        ]
        if not found:
            return empty(self.spark, full)
        return self.spark.read.schema(full).option("basePath", self.path(layer, table)).parquet(*found).select(*full.names)

    def read_batch(self, layer: str, table: str, batch_id: int) -> DataFrame:
        """One batch exactly as written, with helper columns."""
        return self.spark.read.parquet(self.folder(layer, table, batch_id, self.version().batches[batch_id].load))

    def loaded(self) -> list[int]:
        """Batches that the warehouse holds."""
        return sorted(self.version().batches)

    def last_key(self, table: str, before: int) -> int:
        """Largest key of the batches before one, from the number that each load notes beside its
        tables; the table itself is only searched when one is missing."""
        earlier = [e.last_keys.get(table) for b, e in self.version().batches.items() if b < before]
        if any(k is None for k in earlier):
            found = self.gold(table, lambda b: b < before).agg(F.max(PRIMARY_KEYS[table])).first()[0]
            return found or 0
        return max(earlier, default=0)

    def gold(self, table: str, batches: Callable[[int], bool] | None = None) -> DataFrame:
        return self.read("gold", table, GOLD[table], batches)

    def silver(self, table: str) -> DataFrame:
        """The standardized rows that passed all rules, in declared types (amounts that a rule reads
        are stored unrounded)."""
        exact = {r.column for r in rules_for(table) if r.coerce is numbers.to_exact}
        kept = [T.StructField(f.name, numbers.EXACT if f.name in exact else f.dataType) for f in SILVER[table].fields]
        rows = self.read("silver", table, T.StructType([*kept, T.StructField(REJECTED_BY, T.IntegerType())]))
        return rows.where(F.col(REJECTED_BY) == 0).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER[table].fields], BATCH
        )

    def fact_totals(self) -> DataFrame:
        """The fact summed per customer, customer version and policy, one row for each in a batch.

        Sums of these sums are those of the fact, so the frame can stand for it wherever totals by
        customer or policy are asked for; its size follows the keys of each batch, not its rows, and a
        batch that is loaded again replaces its own sums."""
        return self.read("gold", "fact_totals", FACT_TOTALS).drop(BATCH)

    def tables(self) -> dict[str, DataFrame]:
        """The star schema of one version, without partition columns."""
        pinned = self.at(self.version().number)
        return {t: pinned.gold(t).drop(BATCH) for t in LOAD_ORDER}

    def inventory(self) -> DataFrame:
        pinned = self.at(self.version().number)
        return aggregates.inventory({t: pinned.gold(t).drop(BATCH) for t in GOLD})

    def rejected(self, table: str, strict: bool = False) -> DataFrame:
        """Rows that the rules dropped: batch_id, rule_no, rule, column, raw (their texts as JSON).
        Good rows stand in a folder of their own and are not opened."""
        kept = T.StructType([T.StructField(RAW, T.StringType()), T.StructField(REJECTED_BY, T.IntegerType())])
        rows = self.read("silver", table, kept).where(F.col(REJECTED_BY) > 0)
        names = ", ".join(
            f"struct({i} AS {REJECTED_BY}, '{r.name}' AS rule, '{r.column}' AS column)"
            for i, r in enumerate(rules_for(table, strict), start=1)
        )
        rules = F.expr(f"filter(array({names}), r -> r.{REJECTED_BY} = {REJECTED_BY})[0]")
        told = rows.withColumn("_rule", rules)
        return told.select(BATCH, F.col(REJECTED_BY).alias("rule_no"), "_rule.rule", "_rule.column", RAW)

    @contextmanager
    def begin(self) -> Iterator[Load]:
        """A load: published when the block ends, taken back when it fails."""
        stamp = dt.datetime.now(dt.timezone.utc).strftime(_STAMP)
        load = Load(self.spark, self.root, base=self.version(), load_id=f"{stamp}-{uuid.uuid4().hex[:12]}")
        try:
            yield load
            load.publish()
        except BaseException:
            load.discard()
            raise

    def expire(self, keep: int = 10, abandoned_hours: float = 48) -> list[str]:
        """Forget all but the newest ``keep`` versions, then delete the folders that no kept version
        names and that are older than ``abandoned_hours`` (left by killed loads or named by the
        forgotten versions only). Returns the deleted folders. Readers of forgotten versions fail."""
        files, kept = self._files, self.versions()
        for number in kept[: max(0, len(kept) - max(1, keep))]:
            versions.forget(files, self._root, number)
        named = {
            (b, e.load)
            for number in self.versions()
            for b, e in versions.read_version(files, self._root, number).batches.items()
        }
        limit = (dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=abandoned_hours)).strftime(_STAMP)
        gone = []
        for folder in files.find(f"{self._root}/*/*/{BATCH}=*/{LOAD}=*"):
            batch, load = (part.partition("=")[2] for part in folder.rsplit("/", 2)[1:])
            if (int(batch), load) not in named and load.partition("-")[0] <= limit:
                files.delete(folder)
                gone.append(folder)
        return gone


@dataclass(frozen=True)
class Load(Warehouse):
    """Writes aside; reads the version it began with, its own batches in place of the published ones.

    A batch that a load writes replaces the published batch as a whole.
    """

    base: Version = field(default_factory=Version)
    load_id: str = ""
    own: dict[int, Entry] = field(default_factory=dict)

    def version(self) -> Version:
        return Version(self.base.number, {**self.base.batches, **self.own})

    def at(self, number: int) -> Warehouse:
        return self if number == self.base.number else super().at(number)

    def published(self) -> Warehouse:
        """The warehouse without this load."""
        return Warehouse(self.spark, self.root, self.base.number)

    def _note(self, batch_id: int, change: Callable[[Entry], Entry]) -> None:
        self.own[batch_id] = change(self.own.get(batch_id, Entry(self.load_id)))

    def write(
        self, df: DataFrame, layer: str, table: str, batch_id: int, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write one batch of a table aside; returns what was written, all columns."""
        folder, name = self.folder(layer, table, batch_id, self.load_id), f"{layer}/{table}"
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder, compression=CODEC)
        self._note(batch_id, lambda e: replace(e, tables=tuple({*e.tables, name})))
        return self.spark.read.schema(df.schema).parquet(folder)

    def note_last_key(self, table: str, batch_id: int, key: int) -> None:
        self._note(batch_id, lambda e: replace(e, last_keys={**e.last_keys, table: key}))

    def note_buckets(self, index: str, batch_id: int, buckets: Sequence[int]) -> None:
        self._note(batch_id, lambda e: replace(e, buckets={**e.buckets, index: tuple(buckets)}))

    def publish(self) -> Version:
        """Make all batches of this load the current ones, by one rename."""
        if not self.own:
            return self.base
        version = Version(self.base.number + 1, {**self.base.batches, **self.own})
        versions.publish(self._files, self._root, version)
        return version

    def discard(self) -> None:
        """Delete what an unpublished load wrote."""
        for batch_id, entry in self.own.items():
            for name in entry.tables:
                self._files.delete(self.folder(*name.split("/"), batch_id, self.load_id))


def retype_dates(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns that ``schema`` declares as dates, parsed from any known shape."""
    declared = {f.name for f in schema.fields if isinstance(f.dataType, T.DateType)}
    texts = [f.name for f in df.schema.fields if f.name in declared and isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: parse_date(F.col(c)) for c in texts}) if texts else df


def insert_if_absent(
    spark: SparkSession, path: str, incoming: DataFrame, table: str, order_by: list[str] | None = None
) -> DataFrame:
    """Append the rows of ``incoming`` whose primary key the table at ``path`` lacks.

    Missing-value texts become NULL, text dates of any known shape are parsed, columns get their
    declared types and defaults. The
    first row per key wins (by ``order_by``; without it by the rows' place in their file where
    known, else as they come) and a key already there stays as it is, so loading the same
    rows twice adds nothing. Returns one row: table, rows_in, inserted, ignored.
    """
    key, schema = PRIMARY_KEYS[table], GOLD[table]
    try:
        existing = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = empty(spark, schema)
    before = existing.count()  # from the files' footers, like the two counts below
    rows, wanted = incoming, schema
    if order_by is None:
        rows = rows if ORDINAL in rows.columns else with_position(rows)
        place = rows.schema[ORDINAL if ORDINAL in rows.columns else POSITION]
        wanted, order_by = T.StructType([*schema.fields, place]), [place.name]
    rows = stage(rows, "incoming")  # read twice: counted, and searched for new keys
    clean = conform(retype_dates(load_values_all(rows), schema), wanted, DEFAULTS.get(table))
    merge.new_rows(existing, clean, key, order_by).select(*schema.names).write.mode("append").parquet(path)
    rows_in, inserted = rows.count(), spark.read.schema(schema).parquet(path).count() - before
    return spark.createDataFrame(
        [(table, rows_in, inserted, rows_in - inserted)], "table string, rows_in long, inserted long, ignored long"
    )


def load_warehouse(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Insert-if-absent of a whole star schema: the dimensions, then the fact."""
    results: dict[str, DataFrame] = {}

    def load(table: str) -> None:
        path = f"{root.rstrip('/')}/{table}"
        results[table] = insert_if_absent(spark, path, tables[table], table)

    present = [t for t in LOAD_ORDER if t in tables]
    together(*[partial(load, t) for t in present if t.startswith("dim_")])
    together(*[partial(load, t) for t in present if not t.startswith("dim_")])
    return reduce(DataFrame.unionByName, [results[t] for t in present])
