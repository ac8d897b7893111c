"""Near-duplicate groups by SimHash, with deletion-variant signatures.

A fingerprint holds 64 bits. To find all pairs that differ in at most ``max_bits`` of them, it is
cut into ``max_bits // 2 + 1`` segments, so that one segment differs in at most one bit. Each
segment is indexed once per bit with that bit deleted: fingerprints that differ in one bit of the
segment are equal without it. An equality match on (deleted bit, rest of the segment) is thus
complete, and each candidate is verified over all 64 bits.

Distinct fingerprints only are indexed, 64 rows each, whatever the number of copies. Within one
signature the verified links are reduced to a spanning forest before they leave the task, so the
links grow with the members and not with their pairs, and no link between two groups is lost.
A signature with more than ``BLOCK`` fingerprints is dealt out as pairs of blocks of that size to
as many tasks; every pair of members still meets in one of them.

Nulls, empties and ties: a null text counts as empty; a text without words has fingerprint zero
and is linked like any other; rows that repeat an id are fingerprinted each. A row without an id
belongs to its group, but never names it; a group without any id has a null name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import drop_documents, text_key, whole
from starloom.llm.components import components
from starloom.session import stage

SHINGLE = 4
MAX_BITS = 4
BLOCK = 2048  # fingerprints of one signature that are compared in one task
SEED = 42


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash: a bit is set if more than half of the shingles' hashes have it."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    stops = ends[min(shingle, len(words)) - 1:]
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins[:last].tolist(), stops.tolist())], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(whole(docs[text]))


def segments(max_bits: int) -> list[int]:
    """For each bit of a fingerprint the mask of its segment without that bit, as a signed long."""
    count = max_bits // 2 + 1
    cuts = [64 * i // count for i in range(count + 1)]
    masks = []
    for low, high in zip(cuts, cuts[1:]):
        whole_segment = (1 << high) - (1 << low)
        masks += [whole_segment & ~(1 << bit) for bit in range(low, high)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def signatures(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``bit``, ``rest``, ``fp``: one row per fingerprint and deleted bit."""
    masks = F.array(*[F.lit(m) for m in segments(max_bits)])
    rows = nodes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
    return rows.select("bit", F.get(masks, F.col("bit")).bitwiseAND(F.col("fp")).alias("rest"), "fp")


def _forest(members: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever is linked among the members, one fewer than members at most."""
    links, rest = [], np.unique(members)
    while rest.size > 1:
        front, rest = [rest[0]], rest[1:]
        while front and rest.size:
            one = front.pop()
            near = np.bitwise_count((rest ^ one).view(np.uint64)) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                links.append((np.full(found.size, one), found))
                front.extend(found)
    return links


def _links_of(fp: np.ndarray, starts: np.ndarray, max_bits: int) -> pd.DataFrame:
    """Verified links of all groups in a run of rows; ``starts`` are the groups' first rows."""
    sizes = np.diff(np.append(starts, fp.size))
    links: list[tuple[np.ndarray, np.ndarray]] = []
    for at in np.flatnonzero(sizes > 16):
        links += _forest(fp[starts[at]:starts[at] + sizes[at]], max_bits)
    small = sizes <= 16
    left = np.repeat(np.where(small, sizes, 0), sizes) - (np.arange(fp.size) - np.repeat(starts, sizes))
    rows = np.flatnonzero(left > 1)
    for step in range(1, 16):
        rows = rows[left[rows] > step]
        if not rows.size:
            break
        a, b = fp[rows], fp[rows + step]
        near = (np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits) & (a != b)
        links.append((a[near], b[near]))
    a, b = (np.concatenate([x[i] for x in links]) if links else np.array([], dtype=np.int64) for i in (0, 1))
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``a``, ``b``: verified links between distinct fingerprints that connect all groups."""
    index = signatures(nodes, max_bits)
    hot = index.groupBy("bit", "rest").count().where(F.col("count") > block)
    hot = stage(hot.select("bit", "rest", F.ceil(F.col("count") / block).cast("int").alias("parts")), "hot_signatures")
    dealt = index.join(hot, ["bit", "rest"], "left")
    part = F.coalesce(F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"), F.lit(0))
    dealt = dealt.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)))
    key = ["bit", "rest", "low", "high"]
    dealt = dealt.select("bit", "rest", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "fp")

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            keys = rows[key].to_numpy()
            starts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)) if len(rows) else np.array([0])
            held = rows.iloc[starts[-1]:]  # the last group may go on in the next batch
            yield _links_of(rows["fp"].to_numpy()[:starts[-1]], starts[:-1], max_bits)
        if held is not None and len(held):
            yield _links_of(held["fp"].to_numpy(), np.array([0]), max_bits)

    return dealt.repartition(*key).sortWithinPartitions(*key).mapInPandas(match, "a long, b long")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``_id``, ``_key`` (hash of the text), ``fp`` (long) and ``component`` per row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("_id"), text_key(text).alias("_key"), fingerprints(docs, text, shingle).alias("fp"))
    rows = stage(rows, "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("_id").alias("first")), "fingerprint_nodes")
    roots = components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    rooted = stage(rooted, "fingerprint_roots")
    names = stage(rooted.groupBy("root").agg(F.min("first").alias("component")), "components")
    named = stage(rooted.join(names, "root").select("fp", "component"), "fingerprint_components")
    return rows.join(named, "fp")


def keep_one_per_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the document of the smallest id of each group; rows without an id stay only
    in a group that has no id at all, and of rows that repeat this document one stays."""
    found = stage(near_duplicates(docs, text, doc_id), "near_duplicates")
    stays = found["_id"].eqNullSafe(found["component"])
    order = found.where(stays).groupBy("component").agg(F.count("*").alias("n"), F.min("_key").alias("_first"))
    again = stage(order.where("n > 1"), "repeated_ids")
    extra = found.where(stays).join(again, found["component"].eqNullSafe(again["component"]))
    extra = extra.where("_key <> _first").select("_id", "_key")
    gone = found.where(~stays).select("_id", "_key").unionByName(extra).distinct()
    left = drop_documents(docs, stage(gone, "dropped"), doc_id, text)
    if again.isEmpty():
        return left
    # Some ids repeat: whole rows that repeat are the only ones of a group left to tell apart.
    rows = left.select(F.struct(*left.columns).alias("_row"), F.col(doc_id).alias("_doc"), text_key(text).alias("_same"))
    return with_repeats(rows, again.select("component", "_first")).select("_row.*")


def with_repeats(rows: DataFrame, again: DataFrame) -> DataFrame:
    """One row for each document in ``again`` (``component``, ``_first``), every other row as it is."""
    same = rows["_doc"].eqNullSafe(again["component"]) & (rows["_same"] == again["_first"])
    single = rows.join(again, same, "left_anti")
    many = rows.join(again, same, "left_semi")
    return single.unionByName(many.dropDuplicates(["_doc", "_same"]))
