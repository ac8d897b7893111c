"""Removal of repeated line runs, by a suffix array over line ids built with prefix doubling.

Every line gets an id (its hash); a document is a sequence of line ids. Prefix doubling names the
next 1, 2, 4, ... lines of every position: ``name[k+1](i) = name[k](i) + name[k](i + 2**k)``.
Two names cover a prefix of any length, so all suffixes that share their first ``d`` lines
meet under one name: the interval of the suffix array with longest common prefix ``d`` or more.
The first position of an interval, in document order, is the original and the others are later
copies. A repeated run counts from ``min_words`` words on.

How the pieces are spread out: a name is a 64-bit hash pair instead of a rank, so it is worked out
inside the document and no round needs a global sort. Lines that occur once cut the sequences
before anything else, and so do stretches too short to reach ``min_words``. One interval depth
per position is enough: the shortest run from it that reaches ``min_words``, and the shortest
that ends there. Any longer repeated run is the union of such runs, each of them a later copy as
well, so every line of every maximal repeated run is found, and nothing else. Every such run has
``min_words`` lines at most, as lines without a word are left out of the sequence; that bounds the
number of doubling steps without a cap.

Document order is ``doc_id`` (nulls last), then the hash of the text, then the line.

Nulls, empties and ties: a null text stays null, an empty one stays empty; a document whose lines
all go is left with an empty text; lines without a word are never searched for, but go when they
lie inside a removed run; rows that repeat id and text are one document and are cut alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import text_key, whole, with_lookup, words
from starloom.session import stage

MIN_WORDS = 50


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once per row."""
    return F.get(F.transform(F.array(value), use), 0)


def line_table(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """One row per line with a word: document, line number, place among such lines, id, words."""
    lines = docs.select(
        F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), text_key(text).alias("key"),
        F.filter(
            F.transform(F.split(whole(text), "\n"), lambda x, i: F.struct(i.alias("at"), F.xxhash64(x, F.hash(x)).alias("line"), F.size(words(x)).alias("n"))),
            lambda x: x["n"] > 0,
        ).alias("lines"),
    )
    return lines.select("none", "id", "key", F.posexplode("lines").alias("place", "one")).select(
        "none", "id", "key", "place", "one.at", "one.line", "one.n"
    )


def doubled(values: Column, steps: int, join) -> Column:
    """Array of arrays: level k holds ``join`` over the 2**k values from each place, null past the end."""

    def further(k: int):
        def grow(levels: Column) -> Column:
            level = F.get(levels, k)

            def pair(x: Column, i: Column) -> Column:
                y = F.get(level, i + (1 << k))
                return F.when(y.isNotNull(), join(x, y))

            return F.concat(levels, F.array(F.transform(level, pair)))

        return grow

    levels = F.array(values)
    for k in range(steps):
        levels = _bind(levels, further(k))
    return levels


def _shortest(sums: Column, steps: int, start: Column, min_words: int, ahead: bool) -> Column:
    """Lines from ``start`` on (or back from it) whose words stay below ``min_words``, plus one."""

    def step(done: Column, k: Column) -> Column:
        size = F.element_at(F.array(*[F.lit(1 << j) for j in range(steps)]), k + 1)
        place = start + done["m"] if ahead else start - done["m"] - size + 1
        more = done["n"] + F.get(F.get(sums, k), place)
        fits = more.isNotNull() & (more < min_words)
        return F.struct(F.when(fits, done["m"] + size).otherwise(done["m"]).alias("m"), F.when(fits, more).otherwise(done["n"]).alias("n"))

    none = F.struct(F.lit(0).alias("m"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array(*[F.lit(k) for k in reversed(range(steps))]), none, step, lambda d: d["m"] + 1)


def repeated_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """All minimal runs of repeated lines that reach ``min_words``: position, length, two names."""
    often = stage(lines.groupBy("line").count().where("count > 1").select("line"), "lines")
    kept = lines.join(often, "line", "left_semi")
    doc = kept.groupBy("none", "id", "key").agg(F.sort_array(F.collect_set(F.struct("place", "at", "line", "n"))).alias("a"))
    doc = doc.where(F.aggregate("a", F.lit(0).cast("long"), lambda s, x: s + x["n"]) >= min_words)
    # A stretch is a run of neighbouring repeated lines.
    starts = F.filter(F.sequence(F.lit(0), F.size("a") - 1), lambda i: (i == 0) | (F.get("a", i)["place"] != F.get("a", i - 1)["place"] + 1))
    doc = doc.withColumn("starts", starts)
    stretch = F.transform("starts", lambda s, j: F.slice("a", s + 1, F.coalesce(F.get("starts", j + 1), F.size("a")) - s))
    doc = doc.select("none", "id", "key", F.explode(stretch).alias("s"))
    doc = doc.where(F.aggregate("s", F.lit(0).cast("long"), lambda t, x: t + x["n"]) >= min_words)
    steps = max(1, min_words.bit_length())
    doc = doc.withColumn("names", doubled(F.transform("s", lambda x: x["line"]), steps, F.xxhash64))
    doc = doc.withColumn("sums", doubled(F.transform("s", lambda x: x["n"].cast("long")), steps, lambda x, y: x + y))
    ahead = F.transform("s", lambda x, i: F.struct(i.alias("from"), _shortest(F.col("sums"), steps, i, min_words, True).alias("m")))
    behind = F.transform("s", lambda x, i: _bind(
        _shortest(F.col("sums"), steps, i, min_words, False), lambda m: F.struct((i + 1 - m).alias("from"), m.alias("m"))
    ))
    runs = F.filter(F.array_union(ahead, behind), lambda r: (r["from"] >= 0) & (r["from"] + r["m"] <= F.size("s")))
    level = F.length(F.bin(F.col("r.m"))) - 1  # whole part of the binary logarithm
    names = F.get("names", level)
    return doc.select("none", "id", "key", "s", "names", F.explode(runs).alias("r")).select(
        "none", "id", "key", F.get("s", F.col("r.from"))["at"].alias("first"),
        F.get("s", F.col("r.from") + F.col("r.m") - 1)["at"].alias("last"), F.col("r.m").alias("m"),
        F.get(names, F.col("r.from")).alias("head"),
        F.get(names, F.col("r.from") + F.col("r.m") - F.pow(F.lit(2), level).cast("int")).alias("tail"),
    )


def later_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """Per document with later copies: ``_id``, ``_key`` and ``_ranges``, the line numbers to remove."""
    lines = stage(line_table(docs, text, doc_id), "line_ids")
    runs = stage(repeated_runs(lines, min_words), "line_runs")
    at = F.struct("none", "id", "key", "first")
    intervals = runs.groupBy("m", "head", "tail").agg(F.min(at).alias("origin"), F.max(at).alias("end"))
    intervals = stage(intervals.where("origin <> end").drop("end"), "line_intervals")
    copies = runs.join(intervals, ["m", "head", "tail"]).where(at > F.col("origin"))
    ranges = copies.groupBy("none", "id", "key").agg(F.collect_set(F.struct("first", "last")).alias("_ranges"))
    return ranges.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "_ranges")


def remove_repeated_runs(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS, length: str | None = None
) -> DataFrame:
    """``docs`` with the lines of later copies gone from ``text``; ``length`` names a column that
    holds the text's length and is kept true."""
    found = stage(later_copies(docs, text, doc_id, min_words), "line_ranges")
    # One struct carries the row, so that its column names cannot clash with those used here.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_was"), F.col(doc_id).alias("_doc"))
    same = rows["_doc"].eqNullSafe(found["_id"]) & (text_key(rows["_was"]) == found["_key"])
    joined = with_lookup(rows, found, same, "left").withColumn("_lines", F.split("_was", "\n"))
    gone = F.flatten(F.transform("_ranges", lambda r: F.sequence(r["first"], r["last"])))
    joined = joined.withColumn("_left", F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), gone))
    rest = F.array_join(F.transform("_left", lambda i: F.get("_lines", i)), "\n")
    cut = joined.withColumn("_text", F.when(F.col("_ranges").isNull(), F.col("_was")).otherwise(rest))
    changed = {text: F.col("_text")}
    if length:
        changed[length] = F.when(F.col("_ranges").isNull(), F.col("_row")[length]).otherwise(F.length("_text").cast("long"))
    return cut.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
