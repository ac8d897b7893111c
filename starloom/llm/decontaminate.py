"""Benchmark decontamination by template canonicalisation.

Numbers, units and names of a text are replaced by typed placeholders, so that a question with
other figures or other people in it has the same template; neighbouring words of a name, and a
number and its unit, are one placeholder. Windows of the template are hashed; documents and
benchmark items meet in a hash join on them. Matches on one diagonal (document place minus item
place, in words) are joined, and a passage is a chain of them in the order of both texts, each at
most ``BAND`` diagonals from the one before: words put in, left out or replaced by more or fewer
do not end it. A passage counts if it covers ``MIN_COVERED`` words of the item (an item that is
shorter: all of it) and its slots are consistent: one value of the item always stands for one
value in the document, on each of its diagonals and in the chain. Windows with a slot are also hashed with their slot values, so
a verbatim copy is found however many of its words are slots, and wherever its first word stands.

Documents are read in one pass that sends on only windows which a bitmap of ``FILTER_BITS`` bits
over the benchmark's hashes lets through, so what is shuffled follows the matches and not the
corpus. The bitmap has one size whatever the benchmark's; the join behind it is exact.

Nulls, empties and ties: a null or empty text has no window and is never contaminated; an item
shorter than a window and without a literal word (bare figures) matches nothing; items or documents that
repeat are reported each; an item shorter than a window is one window of its own length.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from starloom.llm.common import drop_documents, text_key, whole
from starloom.session import stage

WINDOW = 8
MIN_COVERED = 13
BAND = 8
FILTER_BITS = 1 << 22

# Units of measure and money, and given names that may open a sentence.
UNITS = frozenset(
    "mm cm m km inch inches ft feet foot yard yards mile miles mg g kg lb lbs pound pounds ounce ounces ton tons "
    "ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years cent cents dollar dollars euro euros usd eur percent degree degrees mph kmh".split()
)
NAMES = frozenset(
    "alice bob carol david emma frank grace henry irene jack james jane john julia karen kevin laura linda maria "
    "mark mary mike natalia nora oliver paul peter rachel robert sam sarah sophie susan thomas tim tom william".split()
)
_SAME_UNIT = {
    "$": "dollar", "usd": "dollar", "€": "euro", "eur": "euro", "£": "pound", "lb": "pound", "lbs": "pound", "%": "percent", "°": "degree",
    "inches": "inch", "feet": "foot", "ft": "foot", "litres": "liter", "litre": "liter",
}
_NUMBER = re.compile(r"[$€£]?([+-]?\d[\d.,:/]*)([%°]|[A-Za-z]{1,3})?")
_SEPARATOR = "\x1e"  # white space to split(), so in no word
_STRIP = string.punctuation + "“”„«»‘’…–—¿¡"
# A word's code is the hash of its lower case, and in the low bits: may be a name, ends a sentence, its
# kind, a mark after it.
_CAP, _END, _KIND, _MARKED, _LOW = 1, 2, 4, 32, 63
_NUM, _UNIT, _NAME, _BREAK = (xxhash.xxh64_intdigest(x) & 0x7FFFFFFFFFFFFFC0 for x in ("<num>", "<unit>", "<name>", "<break>"))
_KINDS = np.array([0, _NUM, _UNIT, _NAME, _BREAK], dtype=np.int64)  # 0: a literal word
_FACTORS = np.array([xxhash.xxh64_intdigest(f"factor {i}") | 1 for i in range(WINDOW)], dtype=np.uint64)


class _Codes(dict):
    """Code of a raw word. Forgets at a fixed size."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        bare = word.strip(_STRIP)
        low = bare.lower()
        if word == "\x01":
            code = 4 * _KIND
        elif not bare:
            code = 0
        else:
            code = (xxhash.xxh64_intdigest(low) & 0x7FFFFFFFFFFFFFC0) or _LOW + 1
            if _NUMBER.fullmatch(bare):
                code |= _KIND
            elif low in UNITS:
                code |= 2 * _KIND
            elif low in NAMES:
                code |= 3 * _KIND
            elif bare[0].isupper() and len(bare) > 1 and bare[1:].islower():
                code |= _CAP
        if word[-1] in ".!?:":
            code |= _END
        if word[-1] in _STRIP:
            code |= _MARKED
        self[word] = code
        return code


def template(text: str, codes: _Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Codes by template and by value of the words of a text, without pure punctuation, the places
    at which a placeholder or literal word begins, and the words."""
    raw = text.replace("\n", " \x01 ").split()
    found = np.fromiter(map(codes.__getitem__, raw), dtype=np.int64, count=len(raw))
    kinds = found // _KIND & 7
    ends = (found & _END > 0) | (kinds == 4)
    opens = np.concatenate(([True], ends[:-1])) if len(raw) else ends
    kinds = np.where((found & _CAP > 0) & ~opens, 3, kinds)
    values = found & ~_LOW
    real = np.flatnonzero(values)
    kinds, values = kinds[real], values[real]
    beside = (np.diff(real) == 1) & (found[real[:-1]] & _MARKED == 0)
    one = beside & (((kinds[1:] == 3) & (kinds[:-1] == 3)) | ((kinds[1:] == 2) & (kinds[:-1] == 1)))
    starts = np.flatnonzero(np.concatenate(([True], ~one))) if len(real) else real
    return np.where(kinds > 0, _KINDS[kinds], values), values, starts, [raw[i] for i in real.tolist()]


def _hashes(codes: np.ndarray, size: int) -> np.ndarray:
    n = len(codes) - size + 1
    values = codes.view(np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        total += values[i:n + i] * _FACTORS[i]
    return (total ^ (total >> np.uint64(31))).view(np.int64)


def windows(codes: np.ndarray, values: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Places, ends, hashes and marks of the windows: by template where literal words are at least half,
    and, marked, by the words themselves where there is a slot (without one both are the same)."""
    none = np.array([], dtype=np.int64)
    slots = np.isin(codes, _KINDS[1:])
    light = slotted = begin = none
    hashes, end, n = [none, none], none, len(starts) - size + 1
    if n > 0:
        held = np.concatenate(([0], np.cumsum(slots[starts])))
        light = np.flatnonzero(2 * (held[size:] - held[:n]) <= size)
        begin, end = starts[light], np.append(starts, len(codes))[light + size]
        hashes[0] = _hashes(codes[starts], size)[light]
    n = len(codes) - size + 1
    if n > 0:
        held = np.concatenate(([0], np.cumsum(slots)))
        slotted = np.flatnonzero(held[size:] - held[:n])
        hashes[1] = _hashes(values, size)[slotted]
    same = np.arange(len(light) + len(slotted)) >= len(light)
    return np.concatenate((begin, slotted)), np.concatenate((end, slotted + size)), np.concatenate(hashes), same


def _slots(codes: np.ndarray, heads: set[int], raw: list[str], place: int, end: int) -> str:
    """Values of the slots from ``place`` to ``end``: two of a number (the second its unit, or empty),
    one of a unit on its own or a name."""
    out, last = [], 0
    for i in range(place, end):
        code, bare = int(codes[i]), raw[i].strip(_STRIP).lower()
        inside = i > place and i not in heads
        if code == _NUM:
            number = _NUMBER.fullmatch(bare)
            sign = next((c for c in raw[i] if c in "$€£%°"), number[2] or "")
            out += [f"number:{number[1]}", f"unit:{_SAME_UNIT.get(sign, sign)}"]
        elif code == _UNIT:
            name = _SAME_UNIT.get(bare, bare[:-1] if len(bare) > 3 and bare[-1] == "s" else bare)
            if inside and last == _NUM:
                out[-1] = f"unit:{name}"
            else:
                out.append(f"unit:{name}")
        elif code == _NAME:
            if inside and last == _NAME:
                out[-1] += f" {bare}"
            else:
                out.append(f"name:{bare}")
        last = code
    return _SEPARATOR.join(out)


_ROWS = "place int, end int, size int, hash long, same boolean, merged int, slots string, n int"


def _window_rows(rows: DataFrame, sizes: list[int], bitmap: np.ndarray | None) -> DataFrame:
    """One row per window of the texts in ``_text``; with a bitmap only those that it lets through."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _Codes()
        for batch in batches:
            out = []
            for one, key, text in zip(batch["_id"], batch["_key"], batch["_text"]):
                codes, values, starts, raw = template(text, memo)
                if bitmap is None and len(codes) < WINDOW and np.isin(codes, _KINDS).all():
                    continue
                heads = None
                for size in sizes if bitmap is not None else sorted({min(WINDOW, len(starts)), min(WINDOW, len(codes))}):
                    places, ends, hashes, same = windows(codes, values, starts, size)
                    if bitmap is not None:
                        at = hashes & (FILTER_BITS - 1)
                        through = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                        places, ends, hashes, same = places[through], ends[through], hashes[through], same[through]
                    if len(places) and heads is None:
                        heads = set(starts.tolist())
                    out += [
                        (one, key, p, q, size, h, e, q - p - size, _slots(codes, heads, raw, p, q), len(codes))
                        for p, q, h, e in zip(places.tolist(), ends.tolist(), hashes.tolist(), same.tolist())
                    ]
            yield pd.DataFrame(out, columns=["_id", "_key", "place", "end", "size", "hash", "same", "merged", "slots", "n"])

    return rows.select("_id", "_key", "_text").mapInPandas(cut, f"_id long, _key long, {_ROWS}")


def _bitmap(items: DataFrame) -> np.ndarray:
    """Bitmap of the hashes' low bits; the driver gets FILTER_BITS / 8 bytes at most."""
    at = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1  # the functions below count from 1
    found = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    parts = items.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    for row in parts.collect():
        begin = (row["bucket"] - 1) * 4096
        found[begin:begin + 4096] |= np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return found


class _Run:
    """Joined matches on one diagonal: places and ends in item and document, words that placeholders
    swallowed, the document's value of each slot value of the item, whether one is another."""

    def __init__(self, m, values: dict, other: bool):
        self.begin, self.end, self.item_begin, self.item_end, self.merged = m["place"], m["end"], m["item_place"], m["item_end"], m["merged"]
        self.values, self.other = values, other

    def follows(self, run: "_Run") -> bool:
        return self.item_begin > run.item_begin and self.item_end > run.item_end and self.begin > run.begin and self.end > run.end

    def adds(self, run: "_Run") -> int:
        """Words of the item that are not in ``run``, which comes before; no more than the document has."""
        return min(self.item_end - max(self.item_begin, run.item_end), self.end - max(self.begin, run.end) + self.merged)


def _values(m) -> tuple[dict, bool] | None:
    was, now = m["item_slots"].split(_SEPARATOR), m["slots"].split(_SEPARATOR)
    if len(was) != len(now):
        return None
    found: dict = {}
    for a, b in zip(was, now):
        if a != "unit:" and b != "unit:" and found.setdefault(a, b) != b:
            return None
    return found, was != now


def _agree(a: dict, b: dict) -> bool:
    return all(a.get(k, v) == v for k, v in b.items())


def passage(matches: list, needed: int) -> tuple[int, bool] | None:
    """Words of the item that the longest consistent chain covers, if they are enough, and whether
    it (of equally long ones, any) has no other slot value."""
    diagonals: dict[int, list] = {}
    for m in matches:
        diagonals.setdefault(m["place"] - m["item_place"], []).append(m)
    runs: list[tuple[int, _Run]] = []
    for shift, line in diagonals.items():
        parts: list[_Run] = []
        known: dict = {}
        for m in sorted(line, key=lambda m: (m["item_place"], m["item_end"])):
            read = _values(m)
            if read is None or not _agree(known, read[0]):
                parts = []
                break  # inconsistent: the whole diagonal goes
            known |= read[0]
            new = _Run(m, *read)
            if parts and new.item_begin <= parts[-1].item_end:
                run = parts[-1]
                run.item_end, run.end = max(run.item_end, new.item_end), max(run.end, new.end)
                run.merged, run.values, run.other = run.merged + new.merged, run.values | new.values, run.other or new.other
            else:
                parts.append(new)
        runs += [(shift, run) for run in parts]
    done: dict[int, list] = {}  # by diagonal: runs, each with its best chain and itself alone
    best = (0, False)
    for shift, run in sorted(runs, key=lambda x: (x[1].item_begin, x[1].begin)):
        alone = (run.item_end - run.item_begin, run.values, run.other)
        chain = alone
        for near in range(shift - BAND, shift + BAND + 1):
            for before, *states in done.get(near, ()):
                if not run.follows(before):
                    continue
                for covered, values, other in states:
                    total = covered + run.adds(before)
                    if total > chain[0] and _agree(values, run.values):
                        chain = (total, values | run.values, other or run.other)
        done.setdefault(shift, []).append((run, chain, alone))
        for covered, _, other in (chain, alone):
            if covered >= needed:
                best = max(best, (covered, not other))
    return best if best[0] else None


def contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", min_covered: int = MIN_COVERED,
) -> DataFrame:
    """One row per document and benchmark item found in it: ``_id``, ``_key``, ``item_id``,
    ``covered`` and ``item_words`` (words), ``exact`` (no slot of the longest passage has another value)."""
    items = benchmark.select(F.col(item_id).cast("long").alias("_id"), text_key(item_text).alias("_key"), whole(item_text).alias("_text"))
    items = stage(_window_rows(items, [WINDOW], None), "benchmark_windows")
    sizes = [r["size"] for r in items.select("size").distinct().orderBy("size").collect()]  # 1 to WINDOW
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), text_key(text).alias("_key"), whole(text).alias("_text"))
    found = _window_rows(rows, sizes, _bitmap(items))
    other = items.select(
        F.col("_id").alias("item"), F.col("_key").alias("item_key"), F.col("place").alias("item_place"), F.col("end").alias("item_end"),
        "size", "hash", F.col("same").alias("item_same"), "merged", F.col("slots").alias("item_slots"), F.col("n").alias("item_words"),
    ).distinct()
    # Equal words are equal slots, even if a word is a name on one side only (it opens a sentence on the other).
    pairs = found.drop("n", "merged").join(other, ["hash", "size"])
    pairs = pairs.withColumn("slots", F.when(F.col("same") | F.col("item_same"), F.col("item_slots")).otherwise(F.col("slots")))
    match = F.struct("place", "end", "item_place", "item_end", "merged", "item_slots", "slots")
    pairs = stage(pairs.select("_id", "_key", "item", "item_key", "item_words", match.alias("m")), "benchmark_matches")
    met = pairs.groupBy("_id", "_key", "item", "item_key", "item_words").agg(F.collect_set("m").alias("matches"))

    def chains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for one, key, item, n, matches in zip(batch["_id"], batch["_key"], batch["item"], batch["item_words"], batch["matches"]):
                if hit := passage(matches, min(min_covered, n)):
                    out.append((one, key, item, hit[0], n, hit[1]))
            yield pd.DataFrame(out, columns=["_id", "_key", "item_id", "covered", "item_words", "exact"])

    rows = met.select("_id", "_key", "item", "item_words", "matches")
    checked = rows.mapInPandas(chains, "_id long, _key long, item_id long, covered long, item_words long, exact boolean")
    return checked.groupBy("_id", "_key", "item_id").agg(
        F.max("covered").alias("covered"), F.max("item_words").alias("item_words"), F.max("exact").alias("exact")
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that hold a passage of the benchmark."""
    gone = stage(contaminated(docs, benchmark, text, doc_id).select("_id", "_key").distinct(), "contaminated")
    return drop_documents(docs, gone, doc_id, text)
