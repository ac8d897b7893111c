"""Periodic runs, near embeddings and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from starloom.llm import embedding_dedup, periodic_runs, queries, spelling
from starloom.llm.common import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, runs string, periodic_ string, word string, n long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- periodic runs ------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=7), st.integers(1, 9)), max_size=6))
def test_runs_of_any_words(parts):
    words = list("".join(word * times for word, times in parts))
    assert periodic_runs.runs_of(words) == brute.periodic_runs(words)


def test_runs_of_few_words_over_many():
    chance = random.Random(3)
    for letters in ("a", "ab", "abc"):
        for _ in range(60):
            words = chance.choices(letters, k=chance.randrange(120))
            assert periodic_runs.runs_of(words) == brute.periodic_runs(words)


def test_long_runs():
    period = [f"w{i}" for i in range(5000)]
    assert periodic_runs.runs_of(["x", *period * 40, "y"]) == [(1, 200_000, 5000)]
    assert periodic_runs.runs_of(["a"] * 300_000) == [(0, 300_000, 1)]


def expected_runs(doc_id, text):
    words = brute.plant_run(doc_id, text)
    runs = brute.periodic_runs(words) if len(words) < 3000 else periodic_runs.runs_of(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, milli, sha(lines), sha(brute.collapsed(words, runs)))


def test_periodic_runs_query(spark):
    got = queries.op11_periodic_runs(spark, SF).collect()
    given_rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted(expected_runs(*r) for r in given_rows)
    assert sum(r.n_runs > 0 for r in got) >= 8


def test_periodic_runs_of_odd_rows(spark):
    texts = [None, "", " \t\n", "a", "a a a a a a", "a\tb a\nb a b a b c", "é 😀 " * 8, "x " * 30_000, "a a a a a a", "to to to " * 9]
    odd = spark.createDataFrame([(None if i == 3 else i % 7, t, "r", "p", "w", 1) for i, t in enumerate(texts)], DOC)
    got = periodic_runs.find_runs(odd).collect()
    assert odd.columns == [c for c in got[0].asDict() if c != "periodic"]
    for r in got:
        words = brute.WORD.findall(r.text or "")
        runs = brute.periodic_runs(words) if len(words) < 999 else [(0, 30_000, 1)]
        assert [(x.start, x.length, x.period) for x in r.periodic.runs] == runs
        assert r.periodic.collapsed == brute.collapsed(words, runs) and r.periodic.n_words == len(words)
    assert periodic_runs.find_runs(odd.limit(0)).count() == 0


# ---- near embeddings ----------------------------------------------------------------


def brute_links(vectors):
    """(n_links, component's first row) of each row; None for rows that cannot be compared."""
    usable = [i for i, v in enumerate(vectors) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    n, near = len(vectors), {i: set() for i in range(len(vectors))}
    for i in usable:
        for j in usable:
            if i < j and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], dtype=float), np.array(vectors[j], dtype=float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if vectors[i] == vectors[j] or a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.9:
                    near[i].add(j)
                    near[j].add(i)
    root = brute.components(list(range(n)), lambda a, b: b in near[a])
    return near, root


@pytest.mark.parametrize("bucket,block", [(1024, 2048), (8, 16)])
def test_near_vectors(spark, bucket, block):
    chance = np.random.default_rng(5)
    rows = []
    for centre in chance.standard_normal((12, 24)):
        for spread in chance.uniform(0, 0.5, 18):
            rows.append((centre + spread * chance.standard_normal(24)).astype("float32").astype(float).tolist())
    rows += [rows[0]] * 40 + chance.standard_normal((150, 24)).tolist()
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [math.nan] + [1.0] * 23, [math.inf] + [1.0] * 23, [1.0], [2.0], [1e300, 1e300], [2e300, 2e300]]
    rows += odd + [None, [0.0] * 24]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, component string, n long")
    got = {r._id: r for r in embedding_dedup.near_duplicates(frame, bucket=bucket, block=block).collect()}
    near, root = brute_links(rows)
    assert sorted(got) == list(range(len(rows)))
    true = sum(map(len, near.values()))
    assert 0.95 * true <= sum(r.n_links for r in got.values()) <= true
    assert all(r.n_links <= len(near[i]) and r.kept == (r.component == i) for i, r in got.items())
    assert sum(got[i].component == root[i] for i in got) >= 0.97 * len(rows)
    for i in range(len(rows) - len(odd) - 2, len(rows)):
        assert (got[i].n_links, got[i].component) == (len(near[i]), root[i])
    assert got[0].n_links >= 40


def test_near_vectors_odd_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], kind)).count() == 0
    rows = [(None, [1.0, 0.0]), (5, [1.0, 0.1]), (5, [0.0, 1.0]), (None, [-1.0, 0.0]), (None, None)]
    got = [tuple(r) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, kind)).collect()]
    assert sorted(got, key=str) == sorted([(None, 1, 5, False), (5, 1, 5, True), (5, 0, 5, True), (None, 0, None, True), (None, 0, None, True)], key=str)


def test_plan_meets_the_recall():
    for n in (1, 1000, 50_000, 10**7, 10**9):
        k, t = embedding_dedup.plan(n)
        assert 1 - (1 - embedding_dedup.meeting(embedding_dedup.WIDTH) ** k) ** t >= embedding_dedup.RECALL
    chance = np.random.default_rng(1)
    a = chance.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = chance.standard_normal((4000, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    k, t = embedding_dedup.plan(50_000)
    one, two = (embedding_dedup.bucket_numbers(x, k, t) for x in (a, 0.9 * a + math.sqrt(1 - 0.81) * side))
    assert (one == two).any(axis=1).mean() >= 0.95


def test_near_vectors_query(spark):
    got = queries.op12_embedding_dedup(spark, SF).collect()
    rows = table(spark, SF, "embeddings").orderBy("vec_id").collect()
    near, root = brute_links([list(r.embedding) for r in rows])
    assert sorted(map(tuple, got)) == [(r.vec_id, len(near[i]), rows[root[i]].vec_id, root[i] == i) for i, r in enumerate(rows)]


# ---- spelling variants --------------------------------------------------------------


def test_spelling_query(spark):
    got = queries.op13_spelling_variants(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect())) == brute.spelling(brute.spelled_words(docs))


def test_spelling_of_odd_rows(spark):
    texts = ["kingdom " * 200 + "Kingdum kingdoms kingdum Kingdoms KINGDOMS kingdo×m", None, "", "ÀÉÎÕÜÿß àéîõüÿß ÀÉÎÕÜÿß", "kindgom kindgom kingdom",
             "a" * 5000 + " " + "a" * 5001 + " " + "a" * 5000 + "\n" + "a" * 5001, "aaaaaaa aaaaaaaa aaaaaaa aaaaaaaa", "kingdoms"]
    odd = spark.createDataFrame([(None if i == 3 else i, t, "r", "p", "w", 1) for i, t in enumerate(texts)], DOC)
    counted = spelling.word_counts(queries.words_with_slips(odd), "word")
    expected = brute.spelling(brute.spelled_words([(None if i == 3 else i, t) for i, t in enumerate(texts)]))
    assert sorted(map(tuple, spelling.variants(counted).collect())) == expected
    assert {r[0]: r[1] for r in expected}["kingdum"] == "kingdom"
    empty = spelling.word_counts(queries.words_with_slips(odd.limit(0)), "word")
    assert spelling.variants(empty).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=7, max_size=14), st.integers(0, 13), st.sampled_from("abc"), st.sampled_from("ids"), st.sets(st.text("ab\x02\x03", min_size=3, max_size=5), max_size=12))
def test_near_words_share_a_list(word, at, letter, kind, frequent):
    at %= len(word)
    near = {"i": word[:at] + letter + word[at:], "d": word[:at] + word[at + 1:], "s": word[:at] + letter + word[at + 1:]}[kind]
    if near == word or len(near) < 7:
        return
    common = {g: len(g) for g in frequent}
    one, two = spelling.index_rows(word, common), spelling.index_rows(near, common)
    side = {0} if len(word) == len(near) else {0, 1}
    assert {k for k, _, _ in one if k & 1 in side} & {k for k, _, _ in two}
    (_, bits, bound), (_, other, most) = one[0], two[0]
    assert (bits & ~other & (1 << 64) - 1).bit_count() <= bound and (other & ~bits & (1 << 64) - 1).bit_count() <= most


def test_dictionary_has_a_bound(spark):
    words = spark.createDataFrame([(w,) for w in {"".join(random.Random(i).choices("abcd", k=9)) for i in range(3000)}], "word string")
    found = spelling.gram_dictionary(words, most=500)
    assert 0 < len(found) <= 500
    counts = {r.gram: r.n for r in spelling._gram_counts(words, 6).collect()}
    limit = max(spelling.FEWEST, -(-sum(counts.values()) // 500))
    assert found == {g: n for g, n in counts.items() if n > limit}


def test_forms_chain_to_their_root(spark):
    rows = [("kingdom", 5000), ("kingdum", 400), ("kingdumm", 30), ("kingdumms", 2), ("kingdam", 400), ("kinsdom", 5000)]
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["kingdumms"] == ("kingdumm", "kingdom", 1) and got["kingdom"] == (None, "kingdom", 3)
