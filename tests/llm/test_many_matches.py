"""Texts with more matches than one block and longer than one piece."""

import re

from pyspark.sql import functions as F

from starloom.llm import pii, secrets


def test_many_matches_keep_their_places(spark):
    text = "é write to bob@example.com\n" * (2 * pii.BLOCK + 3) + "x"
    row = pii.candidates(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string"))
    found = {r["doc_id"]: [(c["s"], c["e"]) for c in r["found"]] for r in row.collect()}
    assert found == {1: [m.span() for m in re.finditer(r"bob@example\.com", text)], 2: [], 3: []}


def test_cut_reads_across_pieces(spark):
    text = "".join(chr(0x1F600 + i % 50) if i % 7 == 0 else chr(97 + i % 26) for i in range(3 * pii.PIECE + 5))
    starts = [0, 1, pii.PIECE - 1, pii.PIECE, 2 * pii.PIECE - 20, 3 * pii.PIECE, len(text) - 3, len(text)]
    rows = spark.createDataFrame([(s, text) for s in starts], "s int, t string").withColumn("p", pii.pieces(F.col("t")))
    got = {r["s"]: r["c"] for r in rows.select("s", pii.cut(F.col("p"), F.col("s"), 32).alias("c")).collect()}
    assert got == {s: text[s : s + 32] for s in starts}


def test_tokens_beside_many_assignments(spark):
    n = pii.BLOCK + 10
    text = "token=a1b2c3d4e5f6g7h8 key 9f8e7d6c5b4a39281706 " * n
    docs = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    got = sorted((r["begin"], r["end"]) for r in secrets.candidates(docs).collect())
    want = [m.span() for m in re.finditer(r"a1b2c3d4e5f6g7h8|9f8e7d6c5b4a39281706", text)]
    assert got == want and len(got) == 2 * n
