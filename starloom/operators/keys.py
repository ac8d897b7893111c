"""De-duplication and surrogate keys.

Both are safe for a key that holds a large share of the rows: the row-number filter
is planned with a per-task limit below the shuffle (one row per key and task travels),
and keys are numbered per sorted range, never in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.operators.columns import key_first
from starloom.session import stage

ORDINAL = "_ordinal"  # struct (file, block, row): a row's place in its source file
POSITION = "_position"
_ROW_BITS = 33  # monotonically_increasing_id = partition << 33 | row within the partition


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order_by`` (make it a total order)."""
    return _first_by(df, keys, [F.col(c).asc() for c in order_by])


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order_by`` (make it a total order)."""
    return _first_by(df, keys, [F.col(c).desc() for c in order_by])


def with_position(df: DataFrame) -> DataFrame:
    """Record where each row comes out: the rows of one scanned file block stay together
    and in order as long as nothing above the scan shuffles."""
    return df.withColumn(POSITION, F.monotonically_increasing_id())


def place(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Sort globally and record each row's place. Write the result before numbering it:
    the sort samples its ranges, so a second evaluation may cut them elsewhere."""
    order = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order_by]
    return with_position(df.orderBy(*order))


def number(placed: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Dense keys ``start + 1 .. start + n`` for a *written* frame made by :func:`place`.

    Rows are not moved: each range only needs the number of rows in earlier ranges.
    That offset table has one row per sort partition, which bounds the broadcast.
    """
    part = F.shiftright(F.col(POSITION), _ROW_BITS)
    row = F.col(POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    numbered = numbered.withColumn(key, F.lit(start) + F.col("_offset") + row + 1)
    return key_first(numbered.drop("_part", "_offset", POSITION), key)


def number_in_file_order(rows: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Dense keys in file order without moving the rows.

    ``rows`` is a *written* frame with the source ordinal and a position taken right above
    the file scan (:func:`with_position`). A block's rows then have consecutive positions,
    so a row's number is its distance from the block's first position plus the rows of
    the blocks before. That is checked; rows that did get shuffled are sorted instead.
    The numbers do not depend on how the files were cut into blocks or tasks. A block is
    found by two numbers, the hash of its path (checked to be its own) and its start, so that
    the table of all blocks stays below the broadcast threshold for some 100,000 of them.
    """
    blocks = stage(
        rows.groupBy(
            F.col(f"{ORDINAL}.file").alias("_file"), F.col(f"{ORDINAL}.block").alias("_block")
        ).agg(
            F.count("*").alias("_n"),
            F.min(POSITION).alias("_low"),
            F.max(POSITION).alias("_high"),
        ),
        "blocks",
    )
    blocks = blocks.withColumn("_path", F.xxhash64("_file"))
    broken, n, distinct = blocks.agg(
        F.count_if(F.expr("_high - _low + 1 <> _n")), F.count("*"),
        F.count_distinct(F.struct("_path", "_block")),
    ).first()
    if broken or n != distinct:
        return assign_keys(rows.drop(POSITION), key, [ORDINAL], start)
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_low")
    shifts = blocks.select("_path", "_block", shift.alias("_shift"))
    here = (F.xxhash64(F.col(f"{ORDINAL}.file")) == F.col("_path")) & (F.col(f"{ORDINAL}.block") == F.col("_block"))
    numbered = rows.join(shifts, here).withColumn(
        key, F.lit(start) + F.col("_shift") + F.col(POSITION) + 1
    )
    return key_first(numbered.drop("_path", "_block", "_shift", POSITION), key)


def number_as_written(rows: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Dense keys in source order for rows read back from Parquet, without moving them.

    ``rows`` scans written files (filters on partition columns only) and carries the source ordinal. A
    task writes the rows of one source block together and in order, so a row's number is its place
    in the written file, less the block's first place, plus the rows of the blocks before. Unlike
    positions counted by a task, places in a file stay the same however the files are
    read. Blocks whose rows are not together in their file, or interleaved over files, are
    detected, and the rows sorted instead. The table of pieces has no broadcast hint.
    """
    placed = rows.select(
        "*", F.xxhash64(F.col("_metadata.file_path")).alias("_written"), F.col("_metadata.row_index").alias("_at")
    )
    file, block, row = (F.col(f"{ORDINAL}.{c}") for c in ("file", "block", "row"))
    pieces = stage(
        placed.groupBy(file.alias("_file"), block.alias("_block"), "_written").agg(
            F.count("*").alias("_n"), F.min("_at").alias("_low"), F.max("_at").alias("_high"),
            F.min(row).alias("_first"), F.max(row).alias("_last"),
        ),
        "pieces",
    ).withColumn("_path", F.xxhash64("_file"))
    in_block = Window.partitionBy("_file", "_block").orderBy("_first")
    mixed = pieces.select("_n", "_low", "_high", "_first", F.lag("_last").over(in_block).alias("_before"))
    broken = mixed.where((F.col("_high") - F.col("_low") + 1 != F.col("_n")) | (F.col("_before") >= F.col("_first")))
    one_name = pieces.groupBy("_path", "_block", "_written").count().where("count > 1")
    if not (broken.isEmpty() and one_name.isEmpty()):
        return assign_keys(rows, key, [ORDINAL], start)
    earlier = Window.orderBy("_file", "_block", "_first").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_low")
    shifts = pieces.select("_path", "_block", F.col("_written").alias("_in"), shift.alias("_shift"))
    here = (F.xxhash64(file) == F.col("_path")) & (block == F.col("_block")) & (F.col("_written") == F.col("_in"))
    numbered = placed.join(shifts, here).withColumn(key, F.lit(start) + F.col("_shift") + F.col("_at") + 1)
    return key_first(numbered.drop("_path", "_block", "_shift", "_in", "_at", "_written"), key)


def assign_keys(
    df: DataFrame, key: str, order_by: Sequence[str | Column], start: int = 0
) -> DataFrame:
    """Dense surrogate keys ``start + 1 ..`` in ``order_by`` order, as the first column."""
    return number(stage(place(df, order_by), key), key, start)


def max_key(df: DataFrame, key: str) -> int:
    """Largest key so far, 0 for an empty table."""
    return df.agg(F.max(key)).first()[0] or 0
