"""Registered queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import (
    chat, decontaminate, embedding_dedup, html_extract, line_dedup, mixing, periodic_runs, pii, quality, secrets, simhash,
    spelling, token_counts,
)
from starloom.llm.common import table, whole, words


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    text = F.col("main_text")
    return pages.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("_id").alias("doc_id"), "item_id", "covered", "item_words", "exact")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.remove_repeated_runs(docs, length="n_chars")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], given.schema)
    return chat.read_back(chat.format_conversations(chat.from_turns(given.unionByName(probe))))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), carry=["doc_id"])


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a run put into the text of every tenth document, by the checksum of its id."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    split = docs.withColumn("_words", F.when(h % 10 == 0, words(whole("text")))).withColumn("_n", F.size("_words"))
    g = F.floor(h / 10).cast("long")
    split = split.withColumn("_a", F.when(F.col("_n") > 0, g % F.col("_n")).cast("int"))
    split = split.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8))).cast("int"))
    a, p, rest = F.col("_a"), F.col("_p"), F.col("_n") - F.col("_a")
    period = F.slice("_words", a + 1, p)
    repeated = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / p).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice("_words", F.lit(1), a), repeated), " ")
    return split.withColumn("text", F.when(F.col("_n") > 0, planted).otherwise(F.col("text"))).drop("_words", "_n", "_a", "_p")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find_runs(docs)
    runs = F.col("periodic.runs")
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    told = found.select("doc_id", runs.alias("runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), F.col("periodic.collapsed").alias("collapsed"))
    length, period = -F.col("best.less"), F.col("best.period")
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("_id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def words_with_slips(docs: DataFrame) -> DataFrame:
    """``word``: the lower-cased letter runs of all texts, one letter left out of every 31st by checksum."""
    given = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(given.alias("_doc"), F.explode(spelling.letter_runs("text")).alias("run"))
    h = F.crc32(F.concat("_doc", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(h % 31 == 0, cut).otherwise(F.col("run")).alias("word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(words_with_slips(table(spark, sf_dir, "documents")), "word"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_pii, op3_secret_scan, op4_simhash, op5_token_counts, op6_decontamination,
        op7_line_dedup, op8_chat_format, op9_mixing, op10_quality_rules, op11_periodic_runs, op12_embedding_dedup,
        op13_spelling_variants, pipeline,
    )
}

_TAIL = r"(\|[a-z_]+\|>|/?s>|/?INST\]|/?SYS>>)"
ORACLE: dict[str, str] = {
    "op8_chat_format": rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), sized AS (
            SELECT *, length(text) + len(regexp_extract_all(text, '[<\[]\\*{_TAIL}')) AS written FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(role) + written + 12 + 1 + 10 + 1)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id""",
}
