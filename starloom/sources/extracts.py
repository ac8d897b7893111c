"""Writing results: CSV, report JSON, capped JSON extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.numbers import half_even


def write_csv(df: DataFrame, path: str) -> None:
    """A query result as CSV with header, dates as yyyy-MM-dd, texts kept as they are."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("dateFormat", "yyyy-MM-dd").csv(path)


def report_json(report: DataFrame) -> DataFrame:
    """One JSON text per batch: its table reports in table order."""
    entry = F.struct("table", "issues", "rows_in", "rows_out")
    grouped = report.groupBy("batch_id").agg(F.sort_array(F.collect_list(entry)).alias("tables"))
    return grouped.select("batch_id", F.to_json("tables").alias("report"))


def write_report(report: DataFrame, path: str) -> None:
    """The report as JSON lines, one object per batch."""
    entry = F.struct("table", "issues", "rows_in", "rows_out")
    grouped = report.groupBy("batch_id").agg(F.sort_array(F.collect_list(entry)).alias("tables"))
    grouped.write.mode("overwrite").json(path)


def json_records(df: DataFrame, order_by: Sequence[str | Column], limit: int | None = None) -> DataFrame:
    """All rows, or the first ``limit``, as JSON records, fractional numbers rounded to 2 digits.

    The order columns stay next to ``record``-named JSON so the extract can be re-sorted.
    """
    fractional = {
        f.name: half_even(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))
    }
    rows = df.orderBy(*order_by)
    rows = rows if limit is None else rows.limit(limit)
    rows = rows.withColumns(fractional) if fractional else rows
    everything = F.struct(*rows.columns)
    return rows.select(F.to_json(everything, {"ignoreNullFields": "false"}).alias("record"))
