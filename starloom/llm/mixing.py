"""Mixing sources to target weights, as a min-cost flow over membership patterns.

Documents may belong to several sources. They are aggregated by membership pattern (the set of
their sources); tokens flow from patterns to the quotas of their sources. The first use of a
token costs least, the second and third more (convex), so nothing is repeated while fresh text is
left and no document is used more than ``MAX_REPEATS`` times. The flow says how many words each
pattern gives; documents are then picked by seeded hash order: whole rounds first, then documents
up to the rest.

What reaches the driver is one row per distinct pattern. The pick never gathers a pattern: a
histogram over ``BUCKETS`` hash ranges, and another inside one of them, find the range in which the
rest runs out; only that range is ordered. The gap that is left, less than one document, is closed in ``CLOSING`` passes
with the largest document that fits and a last one that may come nearer by going past it, so no
prefix of a text is ever taken.

Nulls, empties and ties: a null text has no words and takes none; a null source is a source of
its own, the last one; equal hashes are ordered by id and text, and rows that repeat both are
numbered apart by the range's own order; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.common import n_words, text_key, with_lookup
from starloom.session import stage

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 20240229
BUCKETS = 1 << 10  # hash ranges per pattern and level, two levels
CLOSING = 4


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """``source``, ``n`` to ``target``: the whole of all ``n`` shared by weight, none above
    ``repeats`` times its own; the excess goes to the others by weight until none is above.

    Weights repeat over the sources by code point, null last. One row per source; each round
    brings three sums to the driver.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    rank = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights)).cast("int") + 1)
    table = stage(sizes.select("source", "n", weight.alias("weight"), (F.col("n") * repeats).cast("double").alias("most")), "source_weights")
    level = 0.0
    while True:
        full = F.col("most") <= F.col("weight") * level
        row = table.agg(
            F.sum("n"), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not row[2]:
            break
        further = ((row[0] or 0) - (row[1] or 0.0)) / row[2]
        if further <= level:
            break
        level = further
    return table.select("source", F.col("n").alias("source_size"), F.least("most", F.col("weight") * level).alias("target"))


def min_cost_flow(patterns: list[tuple[tuple, int]], quotas: dict, repeats: int = MAX_REPEATS) -> dict[tuple, dict]:
    """Words from each pattern (members, words) to each of its sources.

    Successive cheapest augmenting paths from patterns to open quotas; use ``r`` of a pattern's
    words costs ``r``. A path may move words of another pattern to a different source.
    """
    left = {(p, r): n for p, n in patterns for r in range(1, repeats + 1) if n > 0}
    need = {s: q for s, q in quotas.items() if q > 0}
    used: dict[tuple, dict] = {p: {} for p, _ in patterns}
    giving: dict = {}  # source -> patterns that give to it
    members: dict = {}
    for p, _ in patterns:
        for s in p:
            members.setdefault(s, []).append(p)

    def room(p):
        return next((r for r in range(1, repeats + 1) if left.get((p, r), 0) > 0), None)

    heap = []
    for p, n in patterns:
        if n > 0:
            heapq.heappush(heap, (1, len(p), str(p), p))
    # Patterns are tried by the cost of their next words; a path leads on from a source whose
    # quota is met to the other sources of the patterns that give to it.
    while heap and need:
        cost, _, _, p = heapq.heappop(heap)
        now = room(p)
        if now is None:
            continue
        if now != cost:
            heapq.heappush(heap, (now, len(p), str(p), p))
            continue
        came: dict = {s: None for s in p}
        queue, goal = list(p), None
        while queue and goal is None:
            s = queue.pop(0)
            if s in need:
                goal = s
                break
            for q in sorted(giving.get(s, ()), key=str):
                for t in q:
                    if t not in came:
                        came[t] = (s, q)
                        queue.append(t)
        if goal is None:
            continue  # nothing that this pattern can reach is open
        path, at = [], goal
        while came[at] is not None:
            path.append((came[at][0], came[at][1], at))
            at = came[at][0]
        amount = min([left[(p, now)], need[goal], *(used[q][s] for s, q, _ in path)])
        left[(p, now)] -= amount
        need[goal] -= amount
        if not need[goal]:
            del need[goal]
        for s, q, t in path:
            used[q][s] -= amount
            if not used[q][s]:
                del used[q][s]
                giving[s].discard(q)
            used[q][t] = used[q].get(t, 0) + amount
            giving.setdefault(t, set()).add(q)
        used[p][at] = used[p].get(at, 0) + amount
        giving.setdefault(at, set()).add(p)
        if room(p) is not None:
            heapq.heappush(heap, (room(p), len(p), str(p), p))
    return used


def pick(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Words that each row of ``rows`` (``pattern``, ``size``, ``key``, ``give``, ``whole``) gives.

    ``whole`` is the size of the pattern, ``give`` what the flow asks of it. Returns ``rows`` with
    ``taken``: whole rounds, plus one more use of the picked documents.
    """
    rounds = F.when(F.col("whole") > 0, F.floor(F.col("give") / F.col("whole"))).otherwise(F.lit(0)).cast("long")
    order = F.xxhash64(F.lit(seed), "key")
    rows = rows.withColumn("rounds", rounds).withColumn("rest", F.col("give") - F.col("rounds") * F.col("whole"))
    ranges = [F.pmod("hash", F.lit(BUCKETS)), F.pmod(F.shiftright("hash", 32), F.lit(BUCKETS))]
    rows = rows.withColumn("hash", order).withColumn("range0", ranges[0]).withColumn("range1", ranges[1])
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "mix_rows")
    inside, clear = rows.where("rest > 0 and size > 0").withColumn("below", F.lit(0).cast("long")), []
    for level in ("range0", "range1"):
        before = Window.partitionBy("pattern").orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        bins = inside.groupBy("pattern", level, "rest", "below").agg(F.sum("size").alias("n"))
        bins = bins.withColumn("sum", F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        edge = bins.where("sum <= rest and sum + n > rest")
        edge = stage(edge.select(F.col("pattern").alias("_p"), F.col(level).alias("edge"), F.col("sum").alias("_sum")), "mix_edges")
        met = inside.join(edge, inside["pattern"] == edge["_p"])
        clear.append(met.where(F.col(level) < F.col("edge")).select("row"))
        inside = met.where(F.col(level) == F.col("edge")).withColumn("below", F.col("_sum")).drop("_p", "edge", "_sum")
    along = Window.partitionBy("pattern").orderBy("hash", "row").rowsBetween(Window.unboundedPreceding, 0)
    first = inside.withColumn("sum", F.col("below") + F.sum("size").over(along)).where("sum <= rest").select("row")
    picked = stage(clear[0].unionByName(clear[1]).unionByName(first), "mix_picked")
    for last in [False] * CLOSING + [True]:
        # Any document with a use left may close the gap, one per pattern and pass.
        uses = rows.join(picked.groupBy("row").agg(F.count("*").alias("times")), "row", "left").fillna(0, ["times"])
        done = stage(uses.groupBy("pattern").agg(F.sum(F.col("size") * F.col("times")).alias("done")), "mix_done")
        free = uses.where(F.col("rounds") + F.col("times") < MAX_REPEATS).where("rest > 0 and size > 0").join(done, "pattern")
        free = free.withColumn("gap", F.col("rest") - F.col("done"))
        # The last pass may go past the target, if that comes nearer than stopping short.
        free = free.where("size < 2 * gap") if last else free.where("size <= gap")
        best = free.groupBy("pattern").agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")), "times", "hash", "row")).alias("best"))
        more = stage(best.select(F.col("best.row").alias("row")), "mix_more")
        if not more.isEmpty():
            picked = stage(picked.unionByName(more), "mix_picked")
    extra = picked.groupBy("row").agg(F.count("*").alias("times"))
    taken = F.col("size") * (F.col("rounds") + F.coalesce("times", F.lit(0)))
    return rows.join(extra, "row", "left").withColumn("taken", taken.cast("long")).drop("times", "range0", "range1", "row")


def mix(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sources: Column | None = None,
    weights: Sequence[float] = WEIGHTS, seed: int = SEED,
) -> DataFrame:
    """One row per document: ``_id``, ``_key``, ``pattern``, ``size``, ``source_size``, ``target``, ``taken``.

    ``sources`` is the array of the document's sources (default: the column ``source`` alone). With
    several sources ``source_size`` and ``target`` are those of the first by code point.
    """
    member = F.array(F.col("source")) if sources is None else F.array_distinct(sources)
    member = F.array_sort(member)  # nulls last
    rows = docs.select(F.col(doc_id).alias("_id"), text_key(text).alias("_key"), member.alias("pattern"), n_words(text).alias("size"))
    rows = stage(rows, "mix_sizes")
    by_pattern = stage(rows.groupBy("pattern").agg(F.sum("size").alias("whole")), "mix_patterns")
    sizes = by_pattern.select(F.explode("pattern").alias("source"), "whole").groupBy("source").agg(F.sum("whole").alias("n"))
    shares = stage(targets(sizes, weights), "mix_targets")
    quotas = {r["source"]: int(round(r["target"])) for r in shares.select("source", "target").collect()}
    patterns = [(tuple(r["pattern"]), r["whole"]) for r in by_pattern.orderBy("pattern").collect()]
    flow = min_cost_flow(patterns, quotas)
    give = [(list(p), int(sum(to.values()))) for p, to in flow.items()]
    spark = docs.sparkSession
    plan = spark.createDataFrame(give, f"_pattern {rows.schema['pattern'].dataType.simpleString()}, give long")
    first = F.get("pattern", F.lit(0))
    patterned = by_pattern.join(plan, by_pattern["pattern"].eqNullSafe(plan["_pattern"])).drop("_pattern")
    patterned = patterned.join(shares, first.eqNullSafe(shares["source"])).drop("source")
    patterned = stage(patterned.withColumnRenamed("pattern", "_pattern"), "mix_flow")
    wide = rows.join(patterned, rows["pattern"].eqNullSafe(patterned["_pattern"])).drop("_pattern")
    wide = wide.withColumn("key", F.struct("_id", "_key"))
    return pick(wide, seed).select("_id", "_key", "pattern", "size", "source_size", "target", "taken")


def select_mixture(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that the mix takes, with ``size``, ``taken`` and ``copies`` (whole uses), which
    replace columns of these names."""
    mixed = mix(docs, text, doc_id).where("taken > 0").select("_id", "_key", "size", "taken")
    mixed = mixed.groupBy("_id", "_key").agg(F.first("size").alias("_size"), F.sum("taken").alias("_taken"), F.count("*").alias("_rows"))
    mixed = stage(mixed, "mixture")
    same = docs[doc_id].eqNullSafe(mixed["_id"]) & (text_key(docs[text]) == mixed["_key"])
    joined = with_lookup(docs, mixed, same, "inner")
    copies = F.ceil(F.col("_taken") / F.col("_size") / F.col("_rows")).cast("long")
    return joined.select(*[docs[c] for c in docs.columns if c not in ("size", "taken", "copies")], F.col("_size").alias("size"), (F.col("_size") * copies).alias("taken"), copies.alias("copies"))
