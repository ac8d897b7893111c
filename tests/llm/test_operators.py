"""The text operators against brute force, on sf0.001 and on hand-made odd rows."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from starloom.llm import chat, decontaminate, html_extract, line_dedup, mixing, pii, quality, queries, secrets, simhash, token_counts
from starloom.llm.common import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, _text string, kept string, line string"
LONG = " ".join(f"word{i}" for i in range(60))
ODD = [
    (None, None, None, None), (1, None, "en", None), (2, "", "en", "a"), (3, " \t\n\x0b\f\r ", "xx", "a"), (4, "a", None, "b"),
    (5, f"{LONG}\nshort\n\n{LONG}", "en", "a"), (6, f"head\n{LONG}", "en", "c"), (6, f"head\n{LONG}", "en", "c"), (7, f"head\n{LONG}", "en", "a"),
    (8, "To " * 40 + "of " * 40, "en", "a"), (9, "x" * 30_000 + " mail me: a.b@c.example.org, +1 (425) 555-0100.", "en", "a"),
    (10, "ip 10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 card 4111 1111 1111 1111 4111111111111112 é😀 +49 30 1234567", "de", "b"),
    (None, f"null id {LONG}", "en", "b"), (12, "ÄÖÜ ß é ñ 😀 " * 30, "de", None), (13, "@ a@b a@b.c@d.e.f x@y.z. +1+2+3 + 1-2", "en", "a"),
    (14, "1 " * 500, "en", "a"), (15, "\n".join(f"line {i} {LONG}" for i in range(40)), "en", "a"),
    (16, "\n".join(f"line {i} {LONG}" for i in range(3, 40)), "en", "a"), (17, "one two three\n" * 60, "en", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, s, len(t) if t is not None else None, "x", "y", "z") for i, t, lang, s in ODD]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def both(docs, odd):
    return [docs, odd, odd.limit(0)]


def test_quality_counts(docs, odd):
    for frame in both(docs, odd):
        got = quality.assess(frame, carry=["doc_id", "text"]).collect()
        assert len(got) == frame.count()
        for r in got:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality_counts(r.text)
            assert r.kept is False or not r.base_failed


def test_quality_keeps_good_and_drops_junk(spark, docs):
    kept = {r.doc_id for r in quality.keep_good(docs).select("doc_id").collect()}
    base = {r.doc_id for r in docs.select("doc_id", "text").collect() if brute.quality_counts(r.text)[5]}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    good = [d for d, q in labels.items() if q == 1]
    junk = [d for d, q in labels.items() if q == 0]
    assert all((d in kept) != (d in base) for d in good)  # a good text may still be too short
    assert sum(d not in kept for d in junk) >= len(junk) / 2


def test_quality_limits_follow_the_documents(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    labels = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    judged = [r for r in quality.assess(docs, carry=["doc_id"]).select("doc_id", "n_words", "base_failed", "kept").collect() if not r.base_failed and r.doc_id in labels]
    junk, good = ([r for r in judged if labels[r.doc_id] == q] for q in (0, 1))
    assert sum(r.kept for r in junk) <= len(junk) / 4
    assert not any(r.kept for r in junk if r.n_words >= quality.MIN_HISTOGRAM_WORDS)
    assert sum(not r.kept for r in good) <= len(good) / 500
    assert quality.quantile({100: 90, 300: 10}) == 0.101 and quality.quantile({100: 89, 300: 11}) == 0.301


def test_quality_stage_keeps_columns(odd):
    out = quality.keep_good(odd)
    assert out.columns == odd.columns
    assert {r.doc_id for r in out.collect()} <= {i for i, *_ in ODD}


def test_jensen_shannon(spark):
    one = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0], [1.0, 0.0])], "a array<double>, b array<double>, c array<double>")
    r = one.select(quality.jensen_shannon(F.col("a"), F.col("b")).alias("far"), quality.jensen_shannon(F.col("a"), F.col("c")).alias("same")).first()
    assert (round(r.far, 9), r.same) == (1.0, 0.0)


def test_line_dedup(docs, odd):
    for frame in both(docs, odd):
        rows = frame.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k")).distinct().collect()
        rows.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.k))
        want = dict(zip([(r.doc_id, r.text) for r in rows], brute.cut_lines([r.text for r in rows])))
        got = line_dedup.remove_repeated_runs(frame.withColumn("was", F.col("text")), length="n_chars").collect()
        assert len(got) == frame.count()
        for r in got:
            assert r.text == want[(r.doc_id, r.was)]
            if r.text is not None and r.text != r.was:
                assert r.n_chars == len(r.text)


def test_line_dedup_of_random_sequences(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        texts.append("\n".join(" ".join([rng.choice("abc")] * rng.choice((0, 1, 5, 20))) for _ in range(rng.randint(0, 30))))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.remove_repeated_runs(frame).collect()}
    assert [got[i] for i in range(len(texts))] == brute.cut_lines(texts)


def test_simhash(docs, odd):
    for frame in both(docs, odd):
        rows = frame.select("doc_id", "text").collect()
        got = simhash.near_duplicates(frame).collect()
        assert len(got) == len(rows)
        prints = {(r.doc_id, r.text): brute.simhash(r.text) for r in rows}
        label = brute.components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
        names = {}
        for (i, _), p in prints.items():
            if i is not None:
                names[label[p]] = min(names.get(label[p], i), i)
        want = sorted(((r.doc_id, prints[r.doc_id, r.text], names.get(label[prints[r.doc_id, r.text]])) for r in rows), key=str)
        assert sorted(((r._id, r.fp & (2**64 - 1), r.component) for r in got), key=str) == want


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4, 5])
def test_links_connect_all_near_fingerprints(spark, max_bits):
    rng = random.Random(max_bits)
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = {c for c in centres}
    for c in centres:
        for _ in range(25):
            x = c
            for b in rng.sample(range(64), rng.randint(0, max_bits + 2)):
                x ^= 1 << b
            prints.add(x)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    from starloom.llm.components import components

    for block in (5, 2048):  # small blocks: hot signatures are split
        got = {r.node: r.root for r in components(simhash.links(nodes, max_bits, block)).collect()}
        want = brute.components(sorted(signed), lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits)
        assert {p: got.get(p, p) for p in signed} == want


def test_one_document_of_each_group_stays(odd):
    out = simhash.keep_one_per_group(odd.select("doc_id", "text"))
    found = {(r._id, r._key): r.component for r in simhash.near_duplicates(odd).collect()}
    left = [r.doc_id for r in out.collect()]
    assert sorted(left, key=str) == sorted(set(found.values()), key=str)


def test_components_of_a_long_chain(spark):
    from starloom.llm.components import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1050)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[i] == 1000 for i in range(1000, 1050))


def test_pii_base_spans(docs, odd):
    for frame in both(docs, odd):
        rows = frame.select("doc_id", "text").collect()
        got = pii.report(pii.find_personal_data(frame)).collect()
        want = []
        for r in rows:
            spans = brute.base_spans(r.text)
            want.append((r.doc_id, *[sum(k == kind for k, _, _ in spans) for kind in pii.BASE], brute.spans_digest(spans)))
        assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=str) == sorted(want, key=str)


def test_pii_random_strings(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("aZ@.+-0123456789 ()%_\n😀") for _ in range(rng.randint(0, 120))) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.report(pii.find_personal_data(frame)).collect()}
    for i, t in enumerate(texts):
        assert got[i].base_sha256 == brute.spans_digest(brute.base_spans(t)), t


def test_pii_adds_spans_by_votes(spark):
    base = [(i, f"please call +1 (425) 555-{i:04d} or write to user{i}@mail.example.com") for i in range(30)]
    added = [(100, "my phone: (425) 555-0173 today"), (101, "social security 123-45-6789 on file"), (102, "order 000-000-0000 version 000-00-0000")]
    got = {r.doc_id: r.spans for r in pii.report(pii.find_personal_data(spark.createDataFrame(base + added, "doc_id long, text string"))).collect()}
    assert got[100] == "phone:10:24" and got[101] == "ssn:16:27" and got[102] == ""
    assert all(got[i].count(":") == 4 for i in range(30))


def test_secrets(spark, docs):
    rng = random.Random(1)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    true = [(i, f'set password={hexes(20)} and token = "{hexes(40)}" now', "src1") for i in range(40)]
    false = [(100 + i, f"commit {hexes(40)} build 2024.10.{i}.1234567890 id {hexes(8)}-{hexes(4)}-{hexes(4)}-{hexes(4)}-{hexes(12)}", "src2") for i in range(40)]
    frame = spark.createDataFrame(true + false + [(None, None, None), (200, "", "s")], "doc_id long, text string, source string")
    got = secrets.findings(frame).collect()
    assert {r.doc_id for r in got} == set(range(40)) and len(got) == 80
    for r in got[:5]:
        text = dict((i, t) for i, t, _ in true)[r.doc_id]
        assert hashlib.sha256(text[r.begin:r.end].encode()).hexdigest() == r.digest
    assert secrets.findings(frame.limit(0)).count() == 0
    planted = {r.doc_id for r in docs.where(r"text rlike 'password=[0-9a-f]{18}|token = \"[0-9a-f]{40}\"'").select("doc_id").collect()}
    assert planted <= {r.doc_id for r in secrets.findings(docs).collect()}


def test_secrets_finds_short_assigned_values(spark):
    values = ["hunter2secret", "correcthorsebatterystaple", "Tr0ub4dor&3", "S3cr3tP4ss", "aB3dE5fG7hI9", "QwErTyUiOpAsDfGhJkLzXcVbNm"]
    texts = ["password: {}", "password={}", 'db_password = "{}"', "pwd=S3cr3tP4ss", "api_key: {}.", "secret: {}"]
    rows = [(i, "see " + t.format(v) + " and so on") for i, (t, v) in enumerate(zip(texts, values))]
    rows += [(10, "password: please ask the author: William"), (11, "no key = at all"), (12, "x" * 5000)]
    got = {(r.doc_id, dict(rows)[r.doc_id][r.begin:r.end]) for r in secrets.candidates(spark.createDataFrame(rows, "doc_id long, text string")).where("label = 1 or label is null").collect()}
    assert got == set(enumerate(values))


def test_secrets_trains_on_both_classes_and_honours_labels(spark, monkeypatch):
    rng = random.Random(6)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f"commit {hexes(40)} {'x' * (i % 30)}", "a") for i in range(300)] + [(1000 + i, f"password={hexes(20 + i)} end", "a") for i in range(3)]
    # Like the false ones but for a reviewed label, and a provider's format beside a word that speaks against it.
    rows += [(2000, f"build {'0f' * 20} x", "a"), (2001, f"version AKIA{'Q7' * 8} build", "a"), (2002, "password=abc123def456abc123 end", "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sha = lambda v: hashlib.sha256(v.encode()).hexdigest()
    labels = spark.createDataFrame([(sha("0f" * 20), 1), (sha("abc123def456abc123"), 0)], "digest string, label int")
    monkeypatch.setattr(secrets, "TRAIN_ROWS", 20)
    seen = secrets.scan(frame, labels=labels)
    assert "known" not in seen.columns and "sure" not in seen.columns
    got = {r.doc_id: (r.kept, r.score) for r in seen.collect()}
    assert all(not got[i][0] for i in range(300)) and all(got[1000 + i][0] for i in range(3))
    assert got[2000] == (True, 1.0) and got[2001] == (True, 1.0) and got[2002] == (False, 0.0)
    assert any(s not in (0.0, 0.5, 1.0) for _, s in got.values())  # the forest ran


def test_secrets_held_out(spark):
    """Forest trained without the labels of a part: that part is still told apart."""
    rng = random.Random(2)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    random_token = lambda: "".join(rng.choice(chars) for _ in range(32))
    wordy = lambda: "-".join(rng.choice(["user", "page", "test", "image", "data", "index", "name"]) for _ in range(5)) + "-1"
    rows = [(i, f"secret: {random_token()} end", "a") for i in range(60)] + [(100 + i, f"see {wordy()}.html version", "a") for i in range(60)]
    rows += [(200 + i, f"commit {'0123456789abcdef'[i % 16]}{random_token().lower()} x", "a") for i in range(30)]
    rows += [(300 + i, f"secret {random_token()}", "a") for i in range(20)] + [(400 + i, f"{wordy()} or", "a") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seen = secrets.scan(frame).collect()
    held = [(r.doc_id < 400, r.kept) for r in seen if r.doc_id >= 300]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_token_counts(docs, odd):
    from tokenizers import Tokenizer, models

    pieces = token_counts.vocabulary()
    root = token_counts.piece_trie(pieces)
    plain = lambda w: brute_count(token_counts.MARK + w, pieces)
    for frame in both(docs.limit(40), odd):
        rows = frame.select("doc_id", "text").collect()
        got = token_counts.count_tokens(frame, keep=("doc_id", "text")).collect()
        assert len(got) == len(rows)
        for r in got:
            words = [w if len(w) <= 200 else None for w in (r.text or "").split()]
            assert r.n_pretokens == len(words)
            if None not in words:
                assert r.n_tokens == sum(map(plain, words))
    # The library's own unigram search agrees on the best score's length for known characters.
    scored = Tokenizer(models.Unigram([("<unk>", -100.0)] + sorted(pieces.items()), 0, False))
    words = sorted({token_counts.MARK + w for r in docs.limit(20).collect() for w in r.text.split() if w.isascii()})
    counts = token_counts.trie_counts(words, root)
    same = [counts[w] == len(scored.encode(w).ids) for w in words]
    assert sum(same) >= 0.99 * len(same)


def brute_count(word, pieces):
    best = [(0.0, 0)] + [None] * len(word)
    for i in range(1, len(word) + 1):
        width = len(word[i - 1].encode())
        options = [(best[i - 1][0] + token_counts.BYTE_SCORE * width, -(best[i - 1][1] + width))]
        options += [(best[j][0] + pieces[word[j:i]], -(best[j][1] + 1)) for j in range(max(0, i - 20), i) if word[j:i] in pieces]
        score, size = max(options)
        best[i] = (score, -size)
    return best[-1][1]


ITEM = "Alice has 12 red apples and gives 5 of them to her friend before the train leaves at 9 in the morning for Boston."


def test_decontamination(spark):
    filler = " ".join(f"filler{i}" for i in range(80)) + ". "
    other = ITEM.replace("Alice", "Maria").replace("12", "40").replace(" 5 ", " 7 ").replace("Boston", "Denver")
    mixed = "Bob owns 3 cats and 3 dogs while Bob also feeds 3 birds every single day of the week near the old mill."
    broken = "Tom owns 4 cats and 5 dogs while Sam also feeds 6 birds every single day of the week near the old mill."
    same = "Tom owns 4 cats and 4 dogs while Tom also feeds 4 birds every single day of the week near the old mill."
    rows = [(1, filler + ITEM + " " + filler), (2, filler + other), (3, filler), (4, None), (5, ""), (6, filler + ITEM.lower() + filler),
            (7, " ".join(ITEM.split()[:8])), (8, filler + broken), (9, filler + same), (None, ITEM), (1, filler + ITEM + " " + filler), (10, "unrelated words " * 4000)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, item string, hash string")
    bench = spark.createDataFrame([(1, ITEM), (2, mixed), (3, None), (4, ""), (5, "7 8 9"), (6, "tiny item here"), (6, "tiny item here")], "item_id long, text string")
    found = {(r._id, r.item_id): r.exact for r in decontaminate.contaminated(docs, bench).collect()}
    assert {k[0] for k in found if k[1] == 1} == {None, 1, 2, 6}
    assert found[(1, 1)] and not found[(2, 1)]
    assert (9, 2) in found and (8, 2) not in found
    left = decontaminate.remove_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 7, 8, 10]
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_finds_copies_with_mostly_slots(spark):
    items = ["Add 12, 15, 27, 31 and 44 then divide the total by 3", "Convert 5 km 300 m to cm", "Which Country Won The World Cup In France",
             "Wie viele Äpfel hat Anna Schmidt am Montag", "1 2 3 5 8 13 21 34 55 89"]
    fill = " ".join(f"filler{i}" for i in range(30))
    rows = [(i, f"{fill} {t} {fill}") for i, t in enumerate(items)] + [(10 + i, f"{fill}. {t} {fill}") for i, t in enumerate(items)]
    rows += [(20, f"{fill}. Convert 6 km 300 m to cm {fill}"), (21, f"{fill}. Add 12, 15, 27, 31 and 45 then {fill}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r._id, r.item_id): (r.covered, r.item_words, r.exact) for r in decontaminate.contaminated(docs, bench).collect()}
    sizes = {i: len(t.split()) for i, t in enumerate(items)}
    assert got == {(d + i, i): (n, n, True) for i, n in sizes.items() for d in (0, 10)}


def test_decontamination_finds_items_with_more_or_fewer_words(spark):
    fill = " ".join(f"filler{i}" for i in range(30)) + ". "
    item = "Tom carries 12 baskets of pears over the bridge to Boston and sells every basket there for $5 before the market closes at noon."
    words = item.split()
    rows = [
        (0, item.replace("Boston", "New York")), (1, item.replace("Tom", "Mary Ann")), (2, item.replace("$5", "5 dollars")),
        (3, item.replace("Tom", "Mary Ann").replace("Boston", "New York").replace("$5", "7 dollars").replace("12", "30")),
        (4, " ".join(words[:10] + ["nearby"] + words[10:])), (5, " ".join(words[:12] + words[13:])),
        (10, " ".join(words[12:] + words[:12])), (11, " ".join(words[:12])),
    ]
    docs = spark.createDataFrame([(i, fill + t + " " + fill) for i, t in rows] + [(12, "ha " * 9)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "Tom walks from Boston to the lake for $5 today"), (3, "ha " * 20)], "item_id long, text string")
    got = {(r._id, r.item_id): r.exact for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(0, 1): False, (1, 1): False, (2, 1): True, (3, 1): False, (4, 1): True, (5, 1): True}
    short = spark.createDataFrame([(1, fill + "Mary Ann walks from New York to the lake for 9 dollars today")], "doc_id long, text string")
    assert [r.item_id for r in decontaminate.contaminated(short, bench).collect()] == [2]


def test_decontamination_finds_planted_items(spark, docs):
    bench = table(spark, SF, "benchmark")
    squeeze = lambda t: " ".join((t or "").split())
    items = {r.item_id: squeeze(r.text) for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in squeeze(r.text)}
    got = {(r._id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert want and want <= got


def test_mixing(docs, odd):
    for frame in both(docs, odd):
        got = mixing.mix(frame).collect()
        rows = frame.select("doc_id", "text", "source").collect()
        assert len(got) == len(rows)
        sizes = {}
        for r in rows:
            sizes[r.source] = sizes.get(r.source, 0) + len(brute.WORD.findall(r.text or ""))
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
        target, open_ = {}, set(order)
        total = sum(sizes.values())
        while open_:  # share, stop those above, share the rest again
            free = total - sum(target.values())
            level = free / sum(weight[s] for s in open_)
            over = {s for s in open_ if weight[s] * level >= 3 * sizes[s]}
            if not over:
                target.update({s: weight[s] * level for s in open_})
                break
            target.update({s: 3.0 * sizes[s] for s in over})
            open_ -= over
        taken = {s: 0 for s in order}
        for r in got:
            s = r.pattern[0]
            assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, total)
            assert 0 <= r.taken <= 3 * r.size
            taken[s] += r.taken
        if frame is docs:
            for s in order:
                assert abs(taken[s] - target[s]) <= 0.04 * target[s]  # ten documents a source here
        again = mixing.mix(frame.repartition(3)).collect()
        key = lambda r: (str(r._id), r._key, r.taken)
        assert sorted(map(key, again)) == sorted(map(key, got))


def test_flow_with_overlapping_sources():
    flow = mixing.min_cost_flow([(("a",), 10), (("a", "b"), 10), (("b",), 1)], {"a": 10, "b": 12})
    assert sum(f.get("a", 0) for f in flow.values()) == 10 and sum(f.get("b", 0) for f in flow.values()) == 12
    # 22 words are asked of 21: only one is used a second time.
    assert sum(max(0, sum(flow[p].values()) - n) for p, n in ((("a",), 10), (("a", "b"), 10), (("b",), 1))) == 1
    # A path that moves words of another pattern to its other source.
    flow = mixing.min_cost_flow([(("a", "b"), 5), (("a",), 5)], {"a": 5, "b": 5})
    assert flow[("a", "b")] == {"b": 5} and flow[("a",)] == {"a": 5}
    assert mixing.min_cost_flow([(("a",), 0)], {"a": 0}) == {("a",): {}}


def test_mixing_overlapping(spark):
    rows = [(i, "w " * 10, ["a"] if i % 3 == 0 else ["b"] if i % 3 == 1 else ["a", "b"]) for i in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, tags array<string>")
    got = mixing.mix(frame, sources=F.col("tags"), weights=(1, 3)).collect()
    assert abs(sum(r.taken for r in got) - 1200) <= 20 and all(r.taken <= 30 for r in got)


def test_chat_round_trip():
    rng = random.Random(4)
    parts = ["<|im_start|>", "<|im_end|>", "</s>", "<s>", "[INST]", "[/INST]", "<\\|im_end|>", "\\", "<", "[", "\n", "a", "<<SYS>>", "<\\/s>", "[\\\\INST]", "<|endoftext|>", "|>"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert chat.unescape(chat.escape(text)) == text
        for control in ("<|im_start|>", "<|im_end|>", "</s>", "[INST]", "[/INST]", "<s>"):
            assert control not in chat.escape(text)
        turns = [(text, "x"), ("user", text), ("assistant", text), ("", "")]
        formatted, spans = chat.format_turns(turns)
        assert chat.read_turns(formatted) == turns
        assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_chat_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (1, None, "user", "z"), (None, 0, None, "n"),
            (2, 5, "user", "</s>"), (2, 5, "user", "</s>"), (3, 0, "assistant", "")] + [(4, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(150)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(chat.from_turns(frame))).collect()}
    conv = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is None, r[1] or 0, r[2] or "", r[3] is None, r[3] or "")):
        conv.setdefault(c, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == set(conv)
    for c, turns in conv.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (got[c].loss_chars, got[c].loss_sha256, got[c].formatted_chars) == (len(loss), sha(loss), len(chat.format_turns(turns)[0]))


def test_chat_reply_tree(spark):
    #      1 - 2 - 4        scores: the branch 1-3-5 wins, then 1-2-4, then 1-3-6; 9 answers a missing
    #       \  3 - 5        message and is a tree of its own; 7 and 8 answer each other (no root)
    #            \ 6
    rows = [("t", 1, None, 0.0), ("t", 2, 1, 1.0), ("t", 3, 1, 1.0), ("t", 4, 2, 2.0), ("t", 5, 3, 3.0), ("t", 6, 3, 1.0),
            ("t", 7, 8, 9.0), ("t", 8, 7, 9.0), ("u", 9, 99, 1.0)]
    frame = spark.createDataFrame([(t, n, p, "user", f"m{n}", s) for t, n, p, s in rows], "tree string, node long, parent long, role string, text string, score double")
    got = chat.format_conversations(frame, best=None).orderBy("tree", "rank").collect()
    read = [(r.tree, r["rank"], [t for _, t in chat.read_turns(r.formatted)]) for r in got]
    assert read == [("t", 1, ["m1", "m3", "m5"]), ("t", 2, ["m1", "m2", "m4"]), ("t", 3, ["m1", "m3", "m6"]), ("u", 1, ["m9"])]
    assert chat.format_conversations(frame.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><HTML><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p><article>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></ul></nav><!-- <p>old</p> -->
<div class="ad-box">Buy</div><div class="cookie-notice">Cookies</div><main><article class="post post-{0}"><h1>Title {0}</h1>
<p>First&nbsp;paragraph <b>bold</b>&lt;x&gt; caf&eacute;<br>next   line
<p class=lead>Second <i>one &#x41;&#66;<p>Third</i> here<div>Loose <span>text</span> in box</div><ul><li>item a<li>item b</ul>
<aside>Aside</aside><form><input value="q"><button>Send</button></form>
<section id="comments"><h2>Comments</h2><p>Reader says hi and a lot of other things that are not the article at all.</p></section></article></main>
<div id="sidebar"><p>Recent posts and other long text that goes on and on and on and on and on.</p></div><footer>&copy; Foot</footer></body></html>"""
MAIN = "Title {0}\nFirst paragraph bold<x> café next line\nSecond one AB\nThird here\nLoose text in box\nitem a\nitem b"


def test_html(spark):
    rows = [(i, f"https://a.example/{i}", PAGE.format(i)) for i in range(8)]
    rows += [(20, "https://b.example/", None), (21, None, ""), (22, "x", "plain text, no tags"), (23, "https://a.example/z", "<p>only <b>one"),
             (24, "https://c.example", "<div " * 2000), (25, "https://c.example", "<article><p>a" + "<p>b" * 5000), (26, "https://d.example", "<script>var x = 1;"),
             (0, "https://a.example/0", PAGE.format(0))]
    frame = spark.createDataFrame([(i, u, h, 1) for i, u, h in rows], "page_id long, url string, html string, _host int")
    got = [(r.page_id, r.main_text) for r in html_extract.main_text(frame).collect()]
    assert len(got) == len(rows)
    text = dict(got)
    for i in range(8):
        assert text[i] == MAIN.format(i)
    assert text[20] == "" and text[21] == "" and text[22] == "plain text, no tags" and text[23] == "only one" and text[26] == ""
    assert text[25] == "a\n" + "\n".join("b" * 5000)
    assert html_extract.main_text(frame.limit(0)).count() == 0


def test_html_of_the_table(spark):
    import re

    pages = table(spark, SF, "pages").collect()
    got = {r.page_id: r.text for r in queries.op1_html_extraction(spark, SF).collect()}
    import html

    for r in pages:
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)
        if body:
            blocks = re.split(r"</?(?:p|h1)>", body[1])
            lines = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
            assert got[r.page_id] == "\n".join(x for x in lines if x)
