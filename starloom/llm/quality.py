"""Quality rules by distribution divergence.

A document's histogram of character classes and its histogram of common words are compared
with references, one pair per language, by the Jensen-Shannon distance. Languages are the values of
the language column (null: the empty value) that hold at least ``MIN_SHARE`` of the documents of
``MIN_HISTOGRAM_WORDS`` words or more, so that there are 1 / ``MIN_SHARE`` at most. Nothing is known
of them beforehand: a language's common words are the ``COMMON`` words with a letter that have the
greatest mean share in its documents, its references are the medians of the shares in its documents
that pass the counting rules.

How far is too far comes from the same documents, without labels: the ``QUANTILE`` of the distances of
a language, drawn towards that of all languages by the weight of ``PRIOR`` documents, plus the distance
that a text of as many words has by chance (bins - 1 degrees of freedom). Each text counts once for
medians and limits, however many copies it has. A document beyond the limits of every language is
rejected. A text below the minimum length, and one whose language has no reference, is judged by the
counting rules alone, because its histograms say little.

Everything is DataFrame built-ins. Texts are read twice, once for the common words and once for the
counts of every document, which are written; medians, limits and the verdict read that table.

Nulls, empties and ties: a null text counts as empty; an empty text has zero words and fails the
base rule; words of equal share are ordered by code point; repeated rows are judged one by one. If no
document can serve as a reference, nothing is rejected by divergence. Columns of the input other than
those asked for are not touched.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.common import WORD, whole, words
from starloom.session import stage

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_CHARS = 400  # guard of the character histogram
MIN_HISTOGRAM_WORDS = 150  # guard of the word histogram
MIN_SHARE = 0.01  # of the long documents, for a language to have references
COMMON = 16  # words per language
QUANTILE = 0.9
PRIOR = 100  # documents that the limits of all languages weigh against a language's own
BINS = 1000  # of the distances, 0 to 1, for the quantile
SHARE_BINS = 10_000  # of the shares, for the medians
WEIGHT = 1_000_000  # of one document among the common words, a whole number so that sums agree

# What is not in one of these classes counts as a letter without case.
CHAR_CLASSES = {"upper": r"\p{Lu}", "lower": r"\p{Ll}", "digit": "0-9", "white": r"\x20\x09-\x0D", "stop": r".,;:'\"()?\-", "symbol": r"#*$%&|<>!=+~^_@/\\{}\[\]"}


def _count_class(text: Column, members: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{members}]+", "")).cast("long")


def repeated_words(hashes: Column) -> Column:
    """Words in 5-word windows that occur twice or more, from the array of window hashes.

    The usual text has no window twice, which a hash set finds out; only others are sorted to
    place the repeated windows and to add up the words they cover.
    """
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(array: Column) -> Column:
        twice = F.filter(
            array,
            lambda x, j: (F.get(array, j - 1)["h"] == x["h"]) | (F.get(array, j + 1)["h"] == x["h"]),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def reach(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    # An array of one element binds the value, so that it is worked out once per document.
    places = F.get(F.transform(F.array(placed), covered), 0)
    total = F.get(F.transform(F.array(places), reach), 0)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(total).cast("long")


def common_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, list[str]]:
    """The ``COMMON`` most frequent words, lower-cased, of each language that holds ``MIN_SHARE`` of the long documents.

    Every document has the same weight. The driver gets ``COMMON`` / ``MIN_SHARE`` rows at most.
    """
    split = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), words(whole(text)).alias("words"))
    # Neither a filter nor a plain explode, for which Spark adds one: it would split every text again. The empty word stands for the document itself.
    listed = F.when(F.size("words") >= MIN_HISTOGRAM_WORDS, F.concat("words", F.array(F.lit(""))))
    each = split.select("lang", F.size("words").alias("n"), listed.alias("listed")).select("lang", "n", F.explode_outer("listed").alias("word"))
    each = each.where(F.col("word").isNotNull())
    weight = F.when(F.col("word") == "", F.lit(WEIGHT)).otherwise(F.floor(F.lit(WEIGHT) / F.col("n"))).cast("long")
    counted = each.groupBy("lang", "word").agg(F.sum(weight).alias("weight"))
    counted = counted.groupBy("lang", F.lower("word").alias("word")).agg(F.sum("weight").alias("weight"))
    counted = stage(counted, "word_shares")
    held = counted.where("word = ''")
    total = held.agg(F.sum("weight")).first()[0] or 0
    names = sorted(r["lang"] for r in held.where(F.col("weight") >= MIN_SHARE * total).select("lang").collect())
    if not names:
        return {}
    best = Window.partitionBy("lang").orderBy(F.col("weight").desc(), "word")
    # Letters are looked for in the written table: before it, Spark would look in every word of every text.
    ranked = counted.where(F.col("lang").isin(names) & F.col("word").rlike(r"\p{L}")).withColumn("rank", F.row_number().over(best))
    rows = ranked.where(F.col("rank") <= COMMON).orderBy("lang", "rank").collect()
    return {name: [r["word"] for r in rows if r["lang"] == name] for name in names}


def count_features(docs: DataFrame, text: str = "text", alphabet: Sequence[str] = ()) -> DataFrame:
    """``docs`` plus the base counts, ``base_failed``, and the counts of character classes and of the words of ``alphabet``."""
    value = whole(text)
    code = {w: chr(0x21 + i + (0x5F if i >= 0x5E else 0)) for i, w in enumerate(alphabet)}  # one character per word, in UTF-8 one byte for the first 94
    # A map is searched from its start: frequent words first, then the forms with a capital.
    forms = code | {form: c for w, c in code.items() for form in [w[:1].upper() + w[1:]] if form not in code}
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(WORD))
    out = docs.withColumn("_text", value)
    out = out.withColumn("_words", words(F.col("_text"))).withColumn("_lines", lines)
    out = out.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    hashed = F.col("_hash")
    windows = F.transform(
        F.slice(hashed, 1, F.greatest(F.size(hashed) - (WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(hashed, i + k) for k in range(1, WINDOW)]),
    )
    codes, common = F.lit(""), F.array().cast("array<bigint>")
    if alphabet:
        named = F.create_map(*[F.lit(x) for pair in forms.items() for x in pair])
        codes = F.array_join(F.transform(F.filter("_words", lambda w: w.isin(list(forms))), lambda w: named[w]), "")
        # Bytes, which a string knows of itself; characters would be counted anew for each word.
        counted = lambda c: ((F.octet_length("_codes") - F.octet_length(F.replace(F.col("_codes"), c, F.lit("")))) / F.octet_length(c)).cast("long")
        common = F.transform(F.array(*map(F.lit, code.values())), counted)
    # Most of a text is white or lower case: the other classes are counted in what is left without both.
    out = out.withColumn("_inked", F.array_join("_words", ""))
    out = out.withColumn("_marks", F.regexp_replace("_inked", f"[{CHAR_CLASSES['lower']}]+", ""))
    out = out.withColumn("_windows", windows).withColumn("_codes", codes)
    counts = [
        F.size("_words").cast("long").alias("n_words"),
        F.length("_inked").cast("long").alias("word_chars"),
        _count_class(F.col("_marks"), "#*$%&|<>").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_windows")).alias("n_repeat_words"),
    ]
    gone = {"white": ("_text", "_inked"), "lower": ("_inked", "_marks")}
    classes = [
        (F.length(gone[name][0]) - F.length(gone[name][1])).cast("long") if name in gone else _count_class(F.col("_marks"), members)
        for name, members in CHAR_CLASSES.items()
    ]
    out = out.select(
        *docs.columns, *counts, F.length("_text").cast("long").alias("_chars"), F.xxhash64("_text").alias("_key"),
        F.array(*classes).alias("_classes"), common.alias("_common"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _shares(counts: Column, total: str) -> Column:
    """Shares of the counted classes, then the share of the rest."""
    n = F.greatest(F.col(total), F.lit(1)).cast("double")
    counted = F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)
    return F.concat(F.transform(counts, lambda x: x / n), F.array((F.col(total) - counted) / n))


def _histograms(places: Column) -> tuple[Column, Column]:
    """Character and word histogram of a document; ``places`` are a language's words in the alphabet."""
    return _shares(F.col("_classes"), "_chars"), _shares(F.transform(places, lambda i: F.get("_common", i)), "n_words")


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms: square root of the divergence to base 2, 0 to 1."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def _by_language(known: dict, value) -> Column:
    """``value`` of the document's own language, null if that has no reference."""
    chain = F
    for name, held in known.items():
        chain = chain.when(F.col("_lang") == name, value(held))
    return chain if known else F.lit(None)


def _literal(values) -> Column:
    return F.array(*map(F.lit, values))


def references(counted: DataFrame, places: dict[str, list[int]]) -> dict[str, tuple[list[int], list[float], list[float]]]:
    """Per language the places of its words and its median histograms, over all distinct texts that may serve.

    Medians come from exact counts per bin; the driver gets one row per language and bin of a histogram.
    """
    if not places:
        return {}
    usable = counted.where(~F.col("base_failed") & (F.col("_chars") >= MIN_CHARS) & (F.col("n_words") >= MIN_HISTOGRAM_WORDS))
    both = F.concat(*_histograms(_by_language(places, _literal)))
    binned = usable.where(F.col("_lang").isin(list(places))).select("_lang", "_key", F.transform(both, lambda x: F.round(x * SHARE_BINS).cast("int")).alias("bins"))
    held = binned.distinct().select("_lang", F.posexplode("bins").alias("at", "bin")).groupBy("_lang", "at", "bin").count()
    one = Window.partitionBy("_lang", "at")
    upto = F.sum("count").over(one.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    half = held.withColumn("upto", upto).withColumn("all", F.sum("count").over(one)).where(2 * F.col("upto") >= F.col("all"))
    found: dict = {}
    for r in half.groupBy("_lang", "at").agg(F.min("bin").alias("bin")).orderBy("_lang", "at").collect():
        found.setdefault(r["_lang"], []).append(r["bin"])
    classes = len(CHAR_CLASSES) + 1
    scaled = lambda bins: [x / (sum(bins) or 1) for x in bins]
    return {name: (places[name], scaled(bins[:classes]), scaled(bins[classes:])) for name, bins in found.items()}


def _distances(reference: tuple[list[int], list[float], list[float]]) -> list[Column]:
    at, *medians = reference
    return [jensen_shannon(h, _literal(m)) for h, m in zip(_histograms(_literal(at).cast("array<int>")), medians)]


def quantile(bins: dict[int, int]) -> float:
    """Upper edge of the bin that holds the ``QUANTILE`` of the counted distances (bin of 1 / ``BINS``: documents)."""
    total, seen = sum(bins.values()), 0
    for at in sorted(bins):
        seen += bins[at]
        if seen >= QUANTILE * total:
            return (at + 1) / BINS
    return 1.0


def _judged() -> tuple[Column, Column]:
    """Whether the character histogram, and the word histogram, of a document says enough."""
    return F.col("_chars") >= MIN_CHARS, F.col("n_words") >= MIN_HISTOGRAM_WORDS


def limits(counted: DataFrame, known: dict[str, tuple[list[int], list[float], list[float]]]) -> dict[str, list[float]]:
    """Quantile of the character and of the word distances by language; the driver gets ``BINS`` + 1 rows of each at most."""
    if not known:
        return {}
    # Each limit comes from the texts that it will judge: short ones are further off by chance.
    bins = [F.when(fit, F.floor(_by_language(known, lambda r, i=i: _distances(r)[i]) * BINS)).cast("int") for i, fit in enumerate(_judged())]
    own = counted.where(~F.col("base_failed") & F.col("_lang").isin(list(known))).select("_lang", "_key", F.array(*bins).alias("bins")).distinct()
    rows = own.select("_lang", F.posexplode("bins").alias("which", "bin")).where("bin is not null").groupBy("_lang", "which", "bin").count().collect()
    held, pooled = {(name, i): {} for name in known for i in (0, 1)}, ({}, {})
    for r in rows:
        held[r["_lang"], r["which"]][r["bin"]] = r["count"]
        pooled[r["which"]][r["bin"]] = pooled[r["which"]].get(r["bin"], 0) + r["count"]

    def drawn(name: str, which: int) -> float:
        n = sum(held[name, which].values())
        return (n * quantile(held[name, which]) + PRIOR * quantile(pooled[which])) / (n + PRIOR)

    return {name: [drawn(name, i) for i in (0, 1)] for name in known}


def by_chance(bins: int) -> Column:
    """Distance that a text of ``n_words`` independent draws from a histogram has to that histogram."""
    return F.sqrt(F.lit((bins - 1) / (8 * math.log(2))) / F.greatest(F.col("n_words"), F.lit(1)))


def assess(docs: DataFrame, text: str = "text", lang: str = "lang", carry: Sequence[str] | None = None) -> DataFrame:
    """The columns ``carry`` (default: all) plus base counts, distances, ``base_failed`` and ``kept``.

    Carried columns of the same names are replaced. ``char_distance`` and ``word_distance`` are the distances to the nearest language reference,
    null where there is none.
    """
    carry = list(docs.columns if carry is None else carry)
    inner = [F.col(c).alias(f"_in{i}") for i, c in enumerate(carry)]  # own names: the input's may clash
    language = F.col(lang).cast("string") if lang in docs.columns else F.lit(None).cast("string")
    rows = docs.select(*inner, F.col(text).alias("_body"), F.coalesce(language, F.lit("")).alias("_lang"))
    common = common_words(rows, "_body", "_lang")
    rank: dict[str, int] = {}
    for listed in common.values():
        for i, w in enumerate(listed):
            rank[w] = min(rank.get(w, i), i)
    alphabet = sorted(rank, key=lambda w: (rank[w], w))  # the most frequent first
    counted = stage(count_features(rows, "_body", alphabet).drop("_body"), "quality")
    known = references(counted, {name: [alphabet.index(w) for w in listed] for name, listed in common.items()})
    limit = limits(counted, known)

    # One column per distance: Spark would put an array of them in place of its name, and work out all of them at each use.
    judged = counted.select("*", *[d.alias(f"_far{which}_{k}") for k, r in enumerate(known.values()) for which, d in enumerate(_distances(r))])
    beyond = []
    for which, name in enumerate(("char_distance", "word_distance")):
        bins = (len(CHAR_CLASSES) if which == 0 else COMMON) + 1
        distances = [(F.col(f"_far{which}_{k}"), limit[x][which]) for k, x in enumerate(known)]
        judged = judged.withColumn(name, F.array_min(F.array(*[d for d, _ in distances]).cast("array<double>")))
        # How far the document is beyond the limit that it comes nearest to.
        beyond.append(F.array_min(F.array(*[d - most for d, most in distances]).cast("array<double>")) > by_chance(bins))
    far = (_judged()[0] & beyond[0]) | (_judged()[1] & beyond[1])
    kept = ~F.col("base_failed") & ~F.coalesce(far & F.col("_lang").isin(list(known)), F.lit(False))
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]
    named = [F.col(f"_in{i}").alias(c) for i, c in enumerate(carry) if c not in added]
    return judged.withColumn("kept", kept).select(*named, *added)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns unchanged."""
    # One struct carries the row, so that its column names cannot clash with the counts.
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_t"), (F.col(lang) if lang in docs.columns else F.lit(None)).cast("string").alias("_l"))
    return assess(row, "_t", "_l", ["_row"]).where("kept").select("_row.*")
