"""Periodic runs of words, by a dictionary of basic factors.

A basic factor is a stretch of 2^k words. Equal factors get equal names: a word's name is its place
in the document's list of distinct words, and a factor of twice the length is named by the pair of
its halves. Per length the next occurrence of each factor within twice that length is looked up.
Occurrences whose successors are equally far away form an arithmetic progression; its distance is
proposed as a period. Neighbouring factors of one distance are put together, the stretch is extended
word by word where the factor was too short to carry it to the run's ends, and a run that several
lengths propose is told once.

That finds every run: in a run of smallest period q with at least four periods, a factor of length
L with q <= L < 2q occurs again after q words and not before (its first q words are primitive), so
that q is proposed at that length. What a stretch of four times its distance proposes is also its
smallest period: a smaller one would divide it, and the factor would occur again before.

A factor that occurs once cannot be part of a longer one that occurs twice, so each length looks at
the repeated factors of the length before only, and stops when nothing repeats. Work is in the order
of words times lengths, memory in the order of the words of one document.

Nulls, empties and ties: a null text counts as empty; a text without words has no run and an empty
collapsed text; runs of one start are told by their period; every row stands for itself, also where
ids or whole rows repeat. An empty table gives no rows, further columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starloom.llm.common import whole

MIN_WORDS = 6
MIN_PERIODS = 4
_FOUND = "runs array<struct<start:long,length:long,period:long>>, collapsed string, n_words long"


def _successors(names: np.ndarray, at: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose factor occurs again within ``reach`` words, in order, and the distances."""
    order = np.argsort(names, kind="stable")  # by name, within a name by place
    here, after = order[:-1], order[1:]
    distance = at[after] - at[here]
    near = (names[here] == names[after]) & (distance <= reach)
    by_place = np.argsort(at[here[near]], kind="stable")
    return at[here[near]][by_place], distance[near][by_place]


def _progressions(place: np.ndarray, distance: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Stretches of neighbouring places with one distance: first place, last place, distance."""
    if not place.size:
        return
    cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(distance) != 0)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [place.size])) - 1
    yield from zip(place[first].tolist(), place[last].tolist(), distance[first].tolist())


def _extended(words: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The longest stretch around [start, end) that keeps the period."""
    step = 64
    while start > 0:  # growing blocks to the left, then the first word that differs
        low = max(0, start - step)
        same = words[low:start] == words[low + period:start + period]
        if same.all():
            start, step = low, 2 * step
            continue
        start = low + int(np.flatnonzero(~same)[-1]) + 1
        break
    step = 64
    while end < words.size:
        high = min(words.size, end + step)
        same = words[end:high] == words[end - period:high - period]
        if same.all():
            end, step = high, 2 * step
            continue
        end += int(np.flatnonzero(~same)[0])
        break
    return start, end


def _repeated(names: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(names, minlength=size)[names] > 1


def runs_of(
    words: list[bytes] | list[str], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``min_words`` and ``min_periods`` periods
    (four or more), by start, then period."""
    n = len(words)
    if n < min_words or min_periods < 4:
        if min_periods < 4:
            raise ValueError("the method needs runs of four periods or more")
        return []
    ids: dict = {}
    text = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    dense, length, size = text, 1, len(ids)
    at = np.flatnonzero(_repeated(text, size))
    found: set[tuple[int, int, int]] = set()
    while at.size and length < n:
        place, distance = _successors(dense[at], at, 2 * length)
        covered: dict[int, int] = {}
        for first, last, period in _progressions(place, distance):
            if first < covered.get(period, 0):
                continue  # part of the stretch that was just extended
            start, end = _extended(text, first, last + period + length, period)
            covered[period] = end - period
            if end - start >= max(min_words, min_periods * period):
                found.add((start, end - start, period))
        at = at[at + 2 * length <= n]
        halves = dense[at] * size + dense[at + length]
        halves, at = halves[dense[at + length] >= 0], at[dense[at + length] >= 0]
        names, distinct = pd.factorize(halves)
        size, length = len(distinct), 2 * length
        dense = np.full(n, -1, dtype=np.int64)
        keep = _repeated(names, size) if at.size else np.zeros(0, dtype=bool)
        at = at[keep]
        dense[at] = names[keep]
    return sorted((s, l, p) for s, l, p in found)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def find_runs(docs: DataFrame, text: str = "text", found: str = "periodic") -> DataFrame:
    """``docs`` with a struct column ``found``: ``runs`` (start, length, period in words, by start,
    then period), ``collapsed`` (the text with one period of each run, words joined by a space) and
    ``n_words``."""

    @F.pandas_udf(_FOUND)
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            words = t.encode("utf-8", "surrogatepass").split()  # bytes: the six ASCII blanks only
            runs = runs_of(words)
            kept = b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass")
            rows.append(([dict(zip(("start", "length", "period"), r)) for r in runs], kept, len(words)))
        return pd.DataFrame(rows, columns=["runs", "collapsed", "n_words"])

    return docs.withColumn(found, of(whole(docs[text])))
