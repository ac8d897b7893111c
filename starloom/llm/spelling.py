"""Spelling variants, by a variable-length gram index.

Near words differ by exactly one inserted, deleted or replaced code point. A word is framed by two
marks and cut into one gram per place. Grams start at ``SHORTEST`` code points; a gram that is
frequent among the words grows until it is rare, ``LONGEST`` code points long or ends the word. The
dictionary holds the frequent grams with their counts. Whether a gram ends is told by its own code
points alone, so an edit changes just the grams that hold its place: at most ``bound`` of them, the
largest number of a word's grams over one place (worked out for each word).

Two near words thus share all but ``bound`` grams of either, at the same distance from the start or
from the end. Merging lists in a fixed order, rarest first, the first ``bound + 1`` lists of both
words already hold a common one; the longer lists are never opened. Those heads are the index: equal
keys are joined, the other grams are compared by 64-bit maps (a word misses at most ``bound`` of its
own bits in a near word), and what is left is verified by edit distance inside the join, so that
only near pairs leave it.

Bounds: a gram is frequent above ``total / MAX_GRAMS`` occurrences, so there can be no more than
``MAX_GRAMS`` frequent ones, whatever the table holds; only these are sent to the tasks. The index has
at most ``2 * (LONGEST + 1)`` rows a word.

Nulls, empties and ties: a null text has no words; a null id counts as empty text; words shorter than
``MIN_LENGTH`` or seen less than ``MIN_COUNT`` times are left out; of near words with the same
count the smallest in code-point order is the form. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import whole
from starloom.session import stage

LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10  # a form is at least so many times as frequent as its variant
SHORTEST, LONGEST = 3, 6
MAX_GRAMS = 200_000
FEWEST = 16  # grams up to this count are rare in any table
_START, _END = "\x02", "\x03"


def letter_runs(text: str | Column, shortest: int = MIN_LENGTH) -> Column:
    """Array of the maximal letter runs of at least ``shortest`` letters, A-Z lowered."""
    runs = F.regexp_extract_all(whole(text), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.transform(runs, lambda r: F.translate(r, upper, upper.lower()))


def word_counts(words: DataFrame, word: str, shortest: int = MIN_LENGTH, fewest: int = MIN_COUNT) -> DataFrame:
    """``word``, ``n``: how often each word of sufficient length and number occurs."""
    long_enough = words.where(F.length(word) >= shortest)
    return long_enough.groupBy(F.col(word).alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= fewest)


def _framed(word: str) -> str:
    return _START + word + _END


def _gram_counts(words: DataFrame, longest: int) -> DataFrame:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter[str] = Counter()
            for word in batch["word"]:
                s = _framed(word)
                for size in range(SHORTEST, longest + 1):
                    seen.update(s[i:i + size] for i in range(len(s) - size + 1))
            yield pd.DataFrame({"gram": list(seen.keys()), "n": list(seen.values())})

    return words.select("word").mapInPandas(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_dictionary(words: DataFrame, longest: int = LONGEST, most: int = MAX_GRAMS) -> dict[str, int]:
    """Frequent grams and their counts; never more than ``most``, by the choice of the limit."""
    size = F.length("word") + 2
    places = sum(F.greatest(size - q + 1, F.lit(0)) for q in range(SHORTEST, longest + 1))
    total = words.agg(F.sum(places)).first()[0] or 0
    frequent = _gram_counts(words, longest).where(F.col("n") > max(FEWEST, -(-total // most)))
    found = {r["gram"]: r["n"] for r in frequent.collect()}
    assert len(found) <= most
    return found


def grams(word: str, frequent: dict[str, int], longest: int = LONGEST) -> tuple[list[tuple[str, int]], int]:
    """(gram, place) at each place of the framed word, and the most grams that one edit can change."""
    s = _framed(word)
    cut, over = [], [0] * (len(s) + 1)
    for i in range(len(s) - SHORTEST + 1):
        end = i + SHORTEST
        while end < len(s) and end - i < longest and s[i:end] in frequent:
            end += 1
        cut.append((s[i:end], i))
        over[i] += 1
        over[end] -= 1
    most = running = 0
    for step in over:
        running += step
        most = max(most, running)
    return cut, most


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def index_rows(word: str, frequent: dict[str, int], longest: int = LONGEST) -> list[tuple[int, int, int]]:
    """(key, map, bound): the word's rarest grams by their place from the start (even keys) and from
    the end (odd keys), all grams as a map of 64 bits, and the bound."""
    cut, bound = grams(word, frequent, longest)
    marks = [xxhash.xxh64_intdigest(g) for g, _ in cut]
    bits = 0
    for mark in marks:
        bits |= 1 << (mark & 63)
    order = sorted(range(len(cut)), key=lambda j: (frequent.get(cut[j][0], 0), marks[j], cut[j][0], j))
    rows = []
    for j in order[:bound + 1]:
        gram, place = cut[j]
        back = len(word) + 2 - place - len(gram)
        for side, distance in ((0, place), (1, back)):
            key = xxhash.xxh64_intdigest(f"{distance}:{gram}") & ~1 | side
            rows.append((_signed(key), _signed(bits), bound))
    return rows


def gram_index(words: DataFrame, frequent: dict[str, int], longest: int = LONGEST) -> DataFrame:
    """``key``, ``word``, ``bits``, ``bound``: the lists that have to be merged."""
    sent = words.sparkSession.sparkContext.broadcast(frequent)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(k, w, b, n) for w in batch["word"] for k, b, n in index_rows(w, sent.value, longest)]
            yield pd.DataFrame(out, columns=["key", "word", "bits", "bound"])

    return words.select("word").mapInPandas(rows, "key long, word string, bits long, bound int")


def near_pairs(words: DataFrame, shortest: int = MIN_LENGTH) -> DataFrame:
    """``word``, ``other``: every pair of distinct words at distance one, both ways. No word of
    ``words`` is shorter than ``shortest``."""
    longest = min(LONGEST, shortest - 1)
    if longest < SHORTEST:
        raise ValueError("words must have at least four code points")  # else an edit may change all grams
    index = stage(gram_index(words, gram_dictionary(words, longest), longest), "gram_index")
    a = index.select("key", F.col("word").alias("word"), F.col("bits").alias("_bits"), F.col("bound").alias("_bound"))
    b = index.select("key", F.col("word").alias("other"), F.col("bits").alias("_other"), F.col("bound").alias("_most"))
    apart = F.length("word") - F.length("other")
    from_end = F.col("key").bitwiseAND(F.lit(1)) == 1  # from the end: only for words of unlike length

    def missing(one: str, two: str) -> Column:
        return F.bit_count(F.col(one).bitwiseAND(F.bitwise_not(F.col(two))))

    joined = a.join(b, "key").where(
        (F.col("word") < F.col("other")) & apart.between(-1, 1) & (~from_end | (apart != 0))
        & (missing("_bits", "_other") <= F.col("_bound")) & (missing("_other", "_bits") <= F.col("_most"))
        & (F.levenshtein("word", "other", 1) == 1)
    )
    pairs = stage(joined.select("word", "other").distinct(), "near_pairs")  # read twice
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the last form of each chain. Counts grow tenfold along a chain, so the
    chains are short, and every round doubles the step."""
    steps = stage(forms.select("word", F.col("form").alias("root")), "spelling_forms")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stage(
            steps.join(onward, "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
            ),
            "spelling_roots",
        )
        steps = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return steps


def variants(counted: DataFrame, shortest: int = MIN_LENGTH, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for each word of ``counted``
    (``word``, ``n``; each word once, none shorter than ``shortest``)."""
    words = stage(counted.select("word", "n"), "words")
    pairs = near_pairs(words, shortest)
    largest = F.min(F.struct((-F.col("n")).alias("less"), F.col("other").alias("form")))
    near = (
        pairs.join(words.withColumnRenamed("word", "other"), "other").groupBy("word")
        .agg(F.count("*").alias("n_near"), largest.alias("_best"))
    )
    joined = words.join(stage(near, "best_near"), "word", "left")
    enough = -F.col("_best.less") >= ratio * F.col("n")
    judged = stage(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("_best.form")).alias("form"), F.when(enough, -F.col("_best.less")).alias("form_n"),
        ),
        "spelling",
    )
    roots = _roots(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
