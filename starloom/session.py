"""Session construction and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

# AQE does the run-time work: it sizes shuffle partitions, turns sort-merge joins
# into broadcast joins once a side is known to be small, and splits hot partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this package is designed for; ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_staging: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    It is the folder named by ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder of its own; a cluster without it is an error,
    because a machine-local folder would lose data with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app_id = spark.sparkContext.applicationId
    if app_id not in _local_staging:
        _local_staging[app_id] = tempfile.mkdtemp(prefix="starloom-")
    return _local_staging[app_id]


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the staging folder."""
    return f"{staging_root(spark)}/starloom/{name}-{uuid.uuid4().hex}"


_kept_until_end: ContextVar[list[str] | None] = ContextVar("kept_until_end", default=None)


# Else shuffle files stay until the driver's JVM happens to collect the plan that made them.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove what :func:`stage` writes inside the block when the block ends, and the shuffle files of
    each action when the action ends.

    For work that ends with its results written; no frame made inside may be read afterwards.
    """
    paths: list[str] = []
    token, before = _kept_until_end.set(paths), spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
        _kept_until_end.reset(token)
        for path in paths:
            _remove(spark, path)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh path below the staging folder, removed when the block ends."""
    path = staging_path(spark, name)
    try:
        yield path
    finally:
        _remove(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a frame reading the written table.

    Cuts the lineage and pins row placement: whatever happens to executors later, a
    second pass sees exactly the rows (and positions) of the first one.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    if (paths := _kept_until_end.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_PER_TASK = 250_000
_PARTITIONS = "spark.sql.shuffle.partitions"
# Compressed shuffle bytes that adaptive execution may put together or cut a hot partition into;
# sorted rows take about ten times as much memory.
_TASK_BYTES = "8m"


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for so many wide rows: some 250,000 each, and none of the cores idle."""
    cores = min(int(spark.conf.get(_PARTITIONS)), spark.sparkContext.defaultParallelism)
    return max(cores, -(-rows // ROWS_PER_TASK))


@contextmanager
def sized_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plan the shuffles of what runs inside the block for so many rows.

    They get at least the session's number of partitions, and more where the rows ask for it, as
    plain shuffles that adaptive execution can still merge and split (a repartition by a given
    number is neither). Only actions inside the block count; afterwards the settings are as before.
    """
    most = max(int(spark.conf.get(_PARTITIONS)), tasks_for(spark, rows))
    wanted = {_PARTITIONS: str(most), "spark.sql.adaptive.advisoryPartitionSizeInBytes": _TASK_BYTES}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def together(*jobs: Callable[[], None]) -> None:
    """Run independent Spark actions side by side, so small ones fill the gaps of big ones.

    All of them finish before the first error, if any, is raised.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = [pool.submit(copy_context().run, job) for job in jobs]
    for job in running:
        job.result()
