"""Verdicts of the quality rules against plain Python, and languages that nobody listed."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from starloom.llm import quality
from starloom.llm.common import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PT = "de a o que e do da em um para com não uma os no se na por mais as dos como mas ao".split()


def char_class(c: str) -> int:
    if c in " \t\n\v\f\r":
        return 3
    if c in ".,;:'\"()?-":
        return 4
    if c in "#*$%&|<>!=+~^_@/\\{}[]":
        return 5
    return 0 if c.isupper() and c.lower() != c else 1 if c.islower() and c.upper() != c or c == "ß" else 2 if c in "0123456789" else 6


def shares(counted: Counter, keys, total: int) -> list[float]:
    listed = [counted[k] / max(total, 1) for k in keys]
    return [*listed, (total - sum(counted[k] for k in keys)) / max(total, 1)]


def distance(p, q) -> float:
    total = 0.0
    for x, y in zip(p, q):
        m = (x + y) / 2
        total += (x * math.log2(x / m) if x else 0) / 2 + (y * math.log2(y / m) if y else 0) / 2
    return math.sqrt(max(total, 0.0))


def verdicts(rows) -> dict[int, bool]:
    """The rules of the docstring, document by document; margins of rounding are left to the caller."""
    rows = [(i, t or "", lang or "") for i, t, lang in rows]
    held = {i: WORD.findall(t) for i, t, _ in rows}
    weight: dict = {}
    for i, t, lang in rows:
        n = len(held[i])
        if n >= quality.MIN_HISTOGRAM_WORDS:
            c = weight.setdefault(lang, Counter())
            c[""] += quality.WEIGHT
            for w in held[i]:
                c[w.lower()] += quality.WEIGHT // n
    total = sum(c[""] for c in weight.values())
    common = {
        lang: sorted((w for w in c if re.search(r"[^\W\d_]", w)), key=lambda w: (-c[w], w))[: quality.COMMON]
        for lang, c in weight.items() if c[""] >= quality.MIN_SHARE * total
    }

    def histograms(i, t, lang):
        known = Counter()
        for w in held[i]:
            for form in common[lang]:
                known[form] += w in (form, form[:1].upper() + form[1:])
        return shares(Counter(map(char_class, t)), range(6), len(t)), shares(known, common[lang], len(held[i]))

    failed = {i: brute.quality_counts(t)[5] for i, t, _ in rows}
    long = lambda i, t: (len(t) >= quality.MIN_CHARS, len(held[i]) >= quality.MIN_HISTOGRAM_WORDS)
    median: dict = {}
    for lang in common:
        texts = {t: histograms(i, t, lang) for i, t, x in rows if x == lang and not failed[i] and all(long(i, t))}
        if texts:
            middle = []
            for which in (0, 1):
                bins = [sorted(math.floor(h[which][k] * quality.SHARE_BINS + 0.5) for h in texts.values()) for k in range(7 if which == 0 else len(common[lang]) + 1)]
                found = [b[(len(b) + 1) // 2 - 1] for b in bins]
                middle.append([x / sum(found) for x in found])
            median[lang] = middle
    own, pooled = {}, ([], [])
    for lang, middle in median.items():
        texts = {t: i for i, t, x in rows if x == lang and not failed[i]}
        for which in (0, 1):
            bins = [math.floor(distance(histograms(i, t, lang)[which], middle[which]) * quality.BINS) for t, i in texts.items() if long(i, t)[which]]
            own[lang, which] = bins
            pooled[which].extend(bins)
    limit = {}
    for (lang, which), bins in own.items():
        n = len(bins)
        limit[lang, which] = (n * quality.quantile(Counter(bins)) + quality.PRIOR * quality.quantile(Counter(pooled[which]))) / (n + quality.PRIOR)
    kept = {}
    for i, t, lang in rows:
        far = False
        if lang in median:
            for which, bins in ((0, 7), (1, quality.COMMON + 1)):
                if long(i, t)[which]:
                    chance = math.sqrt((bins - 1) / (8 * math.log(2) * max(len(held[i]), 1)))
                    far |= min(distance(histograms(i, t, x)[which], median[x][which]) - limit[x, which] for x in median) > chance
        kept[i] = not failed[i] and not far
    return kept


def made_up(rng, n):
    return "".join(rng.choice(("ba", "ço", "lhe", "mar", "tu", "ndo", "ri", "são", "pe", "que")) for _ in range(n))


def portuguese(rng) -> str:
    out = []
    while len(out) < 280:
        out.append(rng.choice(PT[: 1 + int(rng.random() ** 2 * len(PT))]) if rng.random() < 0.45 else made_up(rng, rng.randint(2, 4)))
    return ". ".join(" ".join(out[k:k + 12]).capitalize() for k in range(0, len(out), 12)) + "."


def test_verdicts_agree_with_plain_python(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    rng = random.Random(5)
    more = [(10**9 + k, portuguese(rng), "pt") for k in range(40)] + [(2 * 10**9 + k, portuguese(rng), None) for k in range(3)]
    more += [(3 * 10**9, None, None), (3 * 10**9 + 1, "", "pt"), (3 * 10**9 + 2, "日本語の文章です。" * 200, "ja"), (3 * 10**9 + 3, "# $ % " * 200, "en")]
    rows += more
    want = verdicts(rows)
    got = {r.doc_id: r.kept for r in quality.assess(spark.createDataFrame(rows, SCHEMA), carry=["doc_id"]).collect()}
    assert [i for i in want if want[i] != got[i]] == []
    assert all(got[i] for i, t, lang in more if lang == "pt" and t)


def test_an_unlisted_language_is_kept_whatever_its_size(spark):
    rng = random.Random(7)
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    for n in (20, 200):
        rows = [(k, portuguese(rng), "pt") for k in range(n)]
        alone = quality.assess(spark.createDataFrame(rows, SCHEMA), carry=["doc_id"])
        assert alone.where("kept").count() >= 0.99 * n and not alone.where("base_failed").count()
        among = quality.assess(docs.where("doc_id > 1000").unionByName(spark.createDataFrame(rows, SCHEMA)), carry=["doc_id"])
        assert among.where(f"kept and doc_id < {n}").count() >= 0.99 * n


def test_copies_do_not_move_the_limits(spark):
    """A third of all rows are one text; what is kept of the others stays the same."""
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    first = docs.where("lang = 'en' and n_chars > 1500" if "n_chars" in docs.columns else "lang = 'en' and length(text) > 1500").orderBy("doc_id").first()
    copies = spark.createDataFrame([(10**9 + k, first.text, "en") for k in range(docs.count() // 2)], SCHEMA)
    before = {r.doc_id for r in quality.assess(docs, carry=["doc_id"]).where("kept").collect()}
    after = {r.doc_id for r in quality.assess(docs.unionByName(copies), carry=["doc_id"]).where(f"kept and doc_id < {10**9}").collect()}
    assert len(before ^ after) <= len(before) / 50


def test_texts_are_split_once_and_distances_worked_out_once(spark, monkeypatch):
    """Spark repeats an expression that it moves below or into another; plans show how often."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    staged, write = {}, quality.stage

    def noted(df, name):
        staged[name] = plan(df)
        return write(df, name)

    monkeypatch.setattr(quality, "stage", noted)
    rng = random.Random(9)
    docs = spark.createDataFrame([(k, portuguese(rng), ("pt", "br")[k % 2]) for k in range(20)], SCHEMA)
    judged = quality.assess(docs, carry=["doc_id"])
    assert judged.count() == 20
    assert staged["word_shares"].count("split(") == 1 and "RLIKE" not in staged["word_shares"]
    # Two histograms of two languages, two logarithms each.
    assert plan(judged).count("LOG2(") == 8
    assert plan(quality.keep_good(docs)).count("LOG2(") == 8


def test_words_beyond_the_one_byte_codes_are_counted(spark):
    """Six languages or more can have more common words than there are codes of one byte."""
    rng = random.Random(11)
    alphabet = [f"w{i}ö" for i in range(200)]
    rows = [(k, " ".join(rng.choice((w, w.capitalize(), w + ".")) for w in rng.choices(alphabet, k=300)), "") for k in range(5)] + [(5, None, ""), (6, "W199ö w199ö\tw93ö w94ö", "")]
    got = {r.doc_id: list(r._common) for r in quality.count_features(spark.createDataFrame(rows, SCHEMA), "text", alphabet).collect()}
    for i, t, _ in rows:
        held = Counter((t or "").split())
        assert got[i] == [held[w] + held[w.capitalize()] for w in alphabet]
