"""CSV files with quoted line breaks, read by many tasks.

Spark's ``multiLine`` reader gives a whole file to one task. Here a large file is read as lines, split
like any text. One aggregate per file block counts quotes: a line with an odd number of them changes
between inside and outside of a quoted text, doubled quotes don't. A running sum of the blocks'
parities tells whether a block begins inside, a running sum within the block tells it of each line. Lines
outside of quotes at both ends are records; the others are put together, over block borders too, and
``from_csv`` parses the records. Blocks without an odd line need no shuffle.

That holds for texts whose quotes stand at the borders of fields (RFC 4180). Files with a quote amid an
unquoted text, or with an open quote at their end, are read whole by ``multiLine`` instead, and so are
files below ``WHOLE_BELOW`` bytes, which one task reads anyway. A quote that only the order of lines
shows to be out of place is an error. Rows, values and order are those of the ``multiLine`` reader.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from starloom.operators.joins import as_lookup
from starloom.operators.keys import ORDINAL
from starloom.sources.versions import Files

WHOLE_BELOW = 32 << 20
_OPTIONS = {"header": "true", "escape": '"'}


def _place() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(ORDINAL)


def _read(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None, whole: bool) -> DataFrame:
    reader = spark.read.options(**_OPTIONS).option("multiLine", whole)
    reader = reader.option("enforceSchema", False) if schema is None else reader.schema(schema)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    return df.select("*", _place())


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select("value", _place())
    return lines.select("value", f"{ORDINAL}.*", (quotes % 2).cast("int").alias("odd"))


def _blocks(lines: DataFrame) -> DataFrame:
    """One row per file block: does it begin and end inside a quoted text, has it odd lines, is a
    quote out of place (and is the file's last one open)."""
    amid = F.replace("value", F.lit('""')).rlike('[^,"]"[^,"\r]')
    blocks = as_lookup(
        lines.groupBy("file", "block").agg(
            F.sum("odd").alias("n_odd"), F.max(amid).alias("amid"),
            F.min_by(F.endswith("value", F.lit("\r")), "row").alias("crlf"),
        ),
        "csv_blocks",
    )
    in_file = Window.partitionBy("file").orderBy("block")
    until = F.sum("n_odd").over(in_file.rowsBetween(Window.unboundedPreceding, 0))
    whole_file = Window.partitionBy("file")
    return as_lookup(
        blocks.select(
            "file", "block", "n_odd", ((until - F.col("n_odd")) % 2).cast("int").alias("inside"),
            (until % 2).cast("int").alias("open_end"),
            (F.max("amid").over(whole_file) | (F.sum("n_odd").over(whole_file) % 2 == 1)).alias("irregular"),
            F.first("crlf").over(in_file).alias("crlf"), F.max("n_odd").over(whole_file).alias("file_odd"), F.min("block").over(whole_file).alias("first_block"),
        ),
        "csv_states",
    )


def _records(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """``record`` texts with their place (that of the first line), whether their file's lines end
    in two characters, and whether they are a file's first."""
    states = blocks.select("file", "block", "n_odd", "inside", "open_end", "first_block", "crlf")
    known = lines.join(states, ["file", "block"])
    at_head = F.col("block") == F.col("first_block")
    plain = (F.col("n_odd") == 0) & (F.col("inside") == 0) & ~at_head

    in_block = Window.partitionBy("file", "block").orderBy("row")
    before = F.coalesce(F.sum("odd").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    mixed = known.where(~plain).withColumn("inside", ((F.col("inside") + before) % 2).cast("int"))
    starts = F.sum(F.when(F.col("inside") == 0, 1).otherwise(0)).over(in_block)
    mixed = mixed.withColumn("number", starts).withColumn("is_first", at_head & (F.row_number().over(in_block) == 1))
    alone = (F.col("inside") == 0) & (F.col("odd") == 0)
    last = Window.partitionBy("file", "block")
    broken = mixed.withColumn("last", F.max("number").over(last)).where(~alone)
    # Number 0 goes on from an earlier block; the last number of a block that ends inside goes on in the next.
    pieces = broken.groupBy("file", "block", "number").agg(
        F.min("row").alias("row"), F.bool_or("crlf").alias("crlf"), F.bool_or("is_first").alias("is_first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "value"))), lambda x: x["value"]), "\n").alias("record"),
        F.max((F.col("number") == 0) | ((F.col("number") == F.col("last")) & (F.col("open_end") == 1))).alias("_over"),
    )
    pieces = as_lookup(pieces, "csv_pieces")
    chain = F.sum(F.when(F.col("number") > 0, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("block", "number"))
    joined = pieces.where("_over").withColumn("chain", chain).groupBy("file", "chain").agg(
        F.min(F.struct("block", "row", "crlf", "is_first")).alias("_at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "number", "record"))), lambda x: x["record"]), "\n").alias("record"),
    )
    names = ["file", "block", "row", "crlf", "is_first", "record"]
    assembled = pieces.where(~F.col("_over")).select(*names).unionByName(joined.select("file", "_at.*", "record").select(*names))
    bare = F.regexp_replace("record", '"[^"]*+"', "\x00")
    wrong = bare.contains('"') | bare.rlike('[^,\x00\r\n]\x00|\x00[^,\x00\r\n]')
    message = F.concat(F.lit("quotes out of place, read this file whole: "), "file", F.lit(", "), F.left("record", F.lit(200)))
    checked = assembled.withColumn("record", F.when(wrong, F.raise_error(message)).otherwise(F.col("record")))
    line = ["file", "block", "row", "crlf", "is_first", F.col("value").alias("record")]
    plain_lines = known.where(plain).withColumn("is_first", F.lit(False)).select(*line)
    return plain_lines.unionByName(mixed.where(alone).select(*line)).unionByName(checked)


def _split(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, blocks: DataFrame, check_header: bool
) -> DataFrame:
    records = _records(_lines(spark, paths), blocks)
    unix = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), "\r$", "")  # as the one-task reader does
    records = records.withColumn("record", F.when(F.col("crlf"), unix).otherwise(F.col("record"))).where("record <> ''")
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = records.withColumn("_row", F.from_csv("record", declared, {"escape": '"'}))
    if check_header:
        names = F.struct(*[F.lit(f.name).alias(f.name) for f in schema.fields])
        other = F.raise_error(F.concat(F.lit("other columns in the header of "), "file")).cast("boolean")
        rows = rows.where(F.when(F.col("is_first") & (F.col("_row") != names), other).otherwise(~F.col("is_first")))
    else:
        rows = rows.where(~F.col("is_first"))
    return rows.select("_row.*", F.struct("file", "block", "row").alias(ORDINAL))


def read_records(
    spark: SparkSession, path: str, schema: T.StructType | None = None, whole_below: int = WHOLE_BELOW
) -> DataFrame:
    """CSV files with a header and their ordinal: text columns by header names, or ``schema``'s."""
    whole = _read(spark, path, schema, True)
    large = Files(spark).larger_than(whole.inputFiles(), whole_below)
    if not large:
        return whole
    small = sorted(set(whole.inputFiles()) - set(large))
    blocks = _blocks(_lines(spark, large))
    # One row per file, of those that the reader has listed by name already.
    kinds = blocks.groupBy("file").agg(F.bool_or("irregular").alias("irregular"), F.max("file_odd").alias("odd")).collect()
    irregular = [r["file"] for r in kinds if r["irregular"]]
    regular = [r["file"] for r in kinds if not r["irregular"] and not r["odd"]]
    broken = [r["file"] for r in kinds if not r["irregular"] and r["odd"]]
    columns = T.StructType(whole.schema.fields[:-1])
    parts = [_read(spark, found, schema, True) for found in (small + irregular,) if found]
    parts += [_read(spark, found, schema, False) for found in (regular,) if found]
    if broken:
        mine = blocks.where(F.col("file").isin(broken)) if irregular or regular else blocks
        parts.append(_split(spark, broken, columns, mine, schema is None))
    return reduce(DataFrame.unionByName, parts) if parts else whole
