"""Load batches as their files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.plans.batches import add_batch
from starloom.schemas import TABLES
from starloom.sources.raw import read_batch
from starloom.sources.warehouse import Warehouse

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def load_arrivals(
    spark: SparkSession,
    source_root: str,
    warehouse_root: str,
    checkpoint: str,
    files_per_trigger: int = 1000,
    multiline: bool = True,
    **options: bool,
) -> None:
    """Load every batch with a new file of any of its tables since the last call, then stop.

    The stream only watches file names (contents are pruned from its scan). A batch with
    a new file is loaded from all its files. When later batches are there already, they are
    loaded again after it, in order, because their keys go on from its keys; so the warehouse
    is the one that an ordered load of all files gives. Within a call, a later trigger does not
    load a batch again for files that it was loaded from already.
    """
    warehouse = Warehouse(spark, warehouse_root)
    name = rf"day(\d+)_(?:{'|'.join(TABLES)})\.csv"
    batch = F.regexp_extract("path", name, 1).cast("bigint")
    listed = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}

    def known(found: DataFrame) -> DataFrame:
        return found.where(F.col("path").rlike(name)).select(batch.alias("batch_id"), "path", "modificationTime", "length")

    arrivals = known(
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .options(**listed)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(source_root)
    )
    loaded_from: set[tuple] = set()

    def load(files: DataFrame, _epoch: int) -> None:
        # Names of files, which the stream's own log holds too; the rows themselves stay in Spark.
        arrived = {row[0] for row in {tuple(r) for r in files.collect()} - loaded_from}
        if not arrived:
            return
        there = [tuple(r) for r in known(spark.read.format("binaryFile").options(**listed).load(source_root)).collect()]
        with warehouse.begin() as load_all:  # one version for all of them: a lost trigger leaves nothing
            after = [b for b in load_all.loaded() if b > min(arrived)]
            batches = sorted(arrived.union(after))
            for batch_id in batches:
                raw = read_batch(spark, source_root, batch_id, multiline=multiline)
                add_batch(load_all, raw, batch_id, **{**options, "reload": True})
        loaded_from.update(r for r in there if r[0] in batches)

    query = (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
