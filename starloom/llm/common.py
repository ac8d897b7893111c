"""Column helpers and joins shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text that is not null."""
    return F.array_remove(F.split(text, WHITE), "")


def n_words(text: str | Column) -> Column:
    return F.size(words(whole(text))).cast("long")


def text_key(text: str | Column) -> Column:
    """Hash that, next to the id, names a document where ids repeat."""
    return F.xxhash64(whole(text))


def with_lookup(big: DataFrame, lookup: DataFrame, condition: Column, how: str) -> DataFrame:
    """Join wide rows to a narrower table with one row per document, without sorting the wide rows.

    Both sides are hashed by the key and the wide rows stream past the lookup's part. The lookup
    grows with the documents, so it is never broadcast, and the plan is the same at every size.
    """
    return big.join(lookup.hint("shuffle_hash"), condition, how)


def drop_documents(docs: DataFrame, dropped: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents of ``dropped`` (``_id``, ``_key`` = :func:`text_key`), a written table."""
    same = docs[doc_id].eqNullSafe(dropped["_id"]) & (text_key(docs[text]) == dropped["_key"])
    return with_lookup(docs, dropped, same, "left_anti")
