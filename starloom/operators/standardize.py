"""Standardization: strip, canonical codes, title case, dates, typed silver columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from starloom.functions import codes, dates, numbers, text
from starloom.operators.columns import strip_all
from starloom.schemas import MONEY, SILVER


@dataclass(frozen=True)
class Standard:
    """Which columns of a table get which treatment."""

    codes: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    titles: tuple[str, ...] = ()


STANDARDS: dict[str, Standard] = {
    "customers": Standard(
        codes={
            "Region": codes.REGIONS,
            "Marital_Status": codes.MARITAL_STATUSES,
            "Gender": codes.GENDERS,
        },
        titles=("Customer_First_Name", "Customer_Last_Name"),
    ),
    "policies": Standard(codes={"Region": codes.REGIONS, "Policy_Term": codes.TERMS}),
    "address": Standard(codes={"Region": codes.REGIONS}, titles=("Country", "State", "City")),
    "transactions": Standard(codes={"Region": codes.REGIONS}),
}


def standardize(df: DataFrame, table: str) -> DataFrame:
    """Canonical, typed silver rows; extra columns (ordinals) pass through."""
    spec, schema = STANDARDS[table], SILVER[table]
    df = strip_all(df)
    current = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for column in schema.fields:
        name, kind = column.name, column.dataType
        if name not in current:
            changed[name] = F.lit(None).cast(kind)
        elif name in spec.codes:
            changed[name] = text.canonical(F.col(name), spec.codes[name])
        elif name in spec.titles:
            changed[name] = text.title_case(F.col(name))
        elif isinstance(current[name], T.StringType):
            if isinstance(kind, T.DateType):
                changed[name] = dates.parse_date(F.col(name))
            elif isinstance(kind, T.LongType):
                changed[name] = numbers.to_id(F.col(name))
            elif kind == MONEY:
                changed[name] = numbers.to_amount(F.col(name))
    df = df.withColumns(changed) if changed else df
    extra = [c for c in df.columns if c not in schema.names]
    return df.select(*schema.names, *extra)


def standardize_all(validated: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {table: standardize(df, table) for table, df in validated.items()}


def unknown_values(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Texts of ``column`` that no alias covers, with their row counts."""
    value = text.strip(F.col(column))
    return (
        df.select(value.alias("value"))
        .where(F.col("value").isNotNull() & ~F.lower("value").isin(*mapping))
        .groupBy("value")
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(column).alias("column"), "value", "n_rows")
    )


def unknown_report(df: DataFrame, table: str, first: int = 5) -> DataFrame:
    """The ``first`` unknown texts (in text order) of every coded column of a table."""
    reports = [
        unknown_values(df, c, mapping).orderBy("value").limit(first)
        for c, mapping in STANDARDS[table].codes.items()
    ]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result
