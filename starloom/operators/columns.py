"""Projections that work on whole column lists."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from starloom.functions import numbers, text


def select_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def key_first(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[c for c in df.columns if c != key])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def strip_all(df: DataFrame) -> DataFrame:
    """Strip every text column."""
    return df.withColumns({c: text.strip(F.col(c)) for c in string_columns(df)})


def null_tokens_all(df: DataFrame) -> DataFrame:
    """Missing-value texts to NULL in every text column, as a CSV read does."""
    return df.withColumns({c: text.null_token(c) for c in string_columns(df)})


def load_values_all(df: DataFrame) -> DataFrame:
    """Blank / nan / NaT / None to NULL in text columns, NaN to NULL in floating ones."""
    fixes = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            fixes[field.name] = text.load_value(F.col(field.name))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            fixes[field.name] = numbers.nan_to_null(F.col(field.name))
    return df.withColumns(fixes) if fixes else df


def suffix_overlap(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Rename columns both sides share (join keys excepted) so a join keeps them apart."""
    shared = [c for c in left.columns if c in set(right.columns) - set(on)]
    return (
        left.withColumnsRenamed({c: c + suffixes[0] for c in shared}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in shared}),
    )
