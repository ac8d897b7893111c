"""Reading raw CSV extracts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.operators.columns import null_tokens_all, select_present
from starloom.operators.keys import ORDINAL
from starloom.schemas import BRONZE, TABLES
from starloom.sources.split_csv import read_records

_ORDINAL_TYPE = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("row", T.LongType()),
])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_csv(
    spark: SparkSession, path: str, ordinal: bool = False, multiline: bool = False
) -> DataFrame:
    """A CSV file or folder with a header, every column text, missing-value texts as NULL.

    Columns follow the header names. ``ordinal`` adds the place of a row in its file
    (path, split start, row), which orders rows the same way however the file is split.
    ``multiline``: quoted texts may hold line breaks; large files are split all the same.
    """
    if multiline:
        df = read_records(spark, path)
        return null_tokens_all(df if ordinal else df.drop(ORDINAL))
    df = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False).csv(path)
    columns = df.columns
    if not ordinal:
        return null_tokens_all(df)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return null_tokens_all(df.select(*columns, place.alias(ORDINAL)))


def read_columns(spark: SparkSession, path: str, columns: list[str], multiline: bool = True) -> DataFrame:
    """The listed columns of a raw CSV file; the others are not parsed."""
    return select_present(read_csv(spark, path, multiline=multiline), columns)


def _not_found(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_raw_table(spark: SparkSession, path: str, table: str, multiline: bool = True) -> DataFrame:
    """One raw table with its ordinal; an absent file gives an empty table with the declared columns.

    Quoted texts may hold line breaks (see :mod:`starloom.sources.split_csv`). Declare
    ``multiline=False`` for sources without such breaks: their lines are not searched for quotes.
    """
    try:
        return read_csv(spark, path, ordinal=True, multiline=multiline)
    except AnalysisException as error:
        if not _not_found(error):
            raise
        declared = [*BRONZE[table].fields, T.StructField(ORDINAL, _ORDINAL_TYPE)]
        return empty(spark, T.StructType(declared))


def read_batch(
    spark: SparkSession, root: str, batch_id: int, template: str = "{root}/day{batch}_{table}.csv",
    multiline: bool = True,
) -> dict[str, DataFrame]:
    """The four raw tables of one batch."""
    return {
        table: read_raw_table(spark, template.format(root=root, batch=batch_id, table=table), table, multiline)
        for table in TABLES
    }


def read_csv_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored CSV result with its declared schema, or no rows if it was never written."""
    try:
        return read_records(spark, path, schema).drop(ORDINAL)
    except AnalysisException as error:
        if not _not_found(error):
            raise
        return empty(spark, schema)
