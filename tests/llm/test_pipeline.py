"""The pipeline against a brute-force run of its stages, and the registered queries."""

from __future__ import annotations

import re

import corpus_pipeline
from starloom.llm import mixing, quality, queries
from starloom.llm.common import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    rows = {r.doc_id: r.asDict() for r in docs.collect()}
    frame = docs
    for name, step in corpus_pipeline.STAGES[:4]:
        frame = step(spark, frame, SF)
        assert frame.columns == columns
        frame = spark.createDataFrame(frame.collect(), docs.schema)
        got = {r.doc_id: r.asDict() for r in frame.collect()}
        if name == "quality_rules":
            verdict = {r.doc_id: r.kept for r in quality.assess(docs, carry=["doc_id"]).collect()}
            rows = {i: r for i, r in rows.items() if verdict[i]}
        elif name == "line_dedup":
            ids = sorted(rows)
            for i, text in zip(ids, brute.cut_lines([rows[i]["text"] for i in ids])):
                rows[i] = rows[i] | {"text": text, "n_chars": len(text) if text != rows[i]["text"] else rows[i]["n_chars"]}
        elif name == "simhash_near_dedup":
            prints = {i: brute.simhash(r["text"]) for i, r in rows.items()}
            label = brute.components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
            first = {}
            for i in sorted(rows):
                first.setdefault(label[prints[i]], i)
            rows = {i: rows[i] for i in first.values()}
        else:
            items = [" ".join(r.text.split()) for r in table(spark, SF, "benchmark").collect()]
            leaked = {i for i, r in rows.items() if any(t in " ".join(r["text"].split()) for t in items)}
            assert leaked and not leaked & set(got)
            rest = [i for i in rows if i not in leaked and i not in got]
            word = lambda t: re.sub(r"[^\w ]", "", " ".join(t.lower().split())).split()
            windows = {tuple(w[k:k + 8]) for t in items for w in [word(t)] for k in range(len(w) - 7)}
            for i in rest:  # what else goes shares a run of words with an item
                w = word(rows[i]["text"])
                assert any(tuple(w[k:k + 8]) in windows for k in range(len(w) - 7))
            rows = {i: r for i, r in rows.items() if i in got}
        assert got == rows, name
    mixed = corpus_pipeline.mix_sources(spark, frame, SF).collect()
    taken = {r._id: r.taken for r in mixing.mix(frame).collect()}
    assert {r.doc_id: r.taken for r in mixed} == {i: t for i, t in taken.items() if t}
    assert all(r.taken == r.size * r.copies for r in mixed)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "taken", "copies"] and out.count() > 50


def test_stages_take_empty_and_odd_tables(spark):
    rows = [(None, None, None, None, None), (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "one two " * 30, "en", None, 240), (3, "one two " * 30, "en", None, 240)]
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema)
    for frame in (docs, docs.limit(0)):
        for _, step in corpus_pipeline.STAGES:
            assert step(spark, frame, SF).count() <= frame.count()


def test_all_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(queries.QUERIES) <= set(names)
    assert sum(n.startswith("op") for n in queries.QUERIES) == 13 and "pipeline" in names
