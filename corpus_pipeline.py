"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. SimHash needs XXH64 and the graph search, which SQL does
not express, so there is no SQL for the whole; tests compare it with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontaminate, line_dedup, mixing, quality, simhash
from starloom.llm.common import table
from starloom.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later copies of repeated line runs cut out, ``n_chars`` kept true."""
    return line_dedup.remove_repeated_runs(docs, length="n_chars" if "n_chars" in docs.columns else None)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one_per_group(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``size``, ``taken`` and ``copies``."""
    return mixing.select_mixture(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("benchmark_decontamination", remove_benchmark),
    ("mix_sources", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
