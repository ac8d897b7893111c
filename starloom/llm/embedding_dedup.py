"""Near-duplicate embeddings, by p-stable hashing for the Euclidean distance.

Two vectors with cosine c are, scaled to length one, sqrt(2 - 2c) apart. A projection on a normal
random direction keeps distances up to a normal factor; shifted at random and cut into cells of
``WIDTH`` times the largest distance of a link, it puts the ends of such a link into one cell with
a known probability p, and vectors at right angles with a smaller one, q. A table joins k
projections to one bucket number. k follows from the number of vectors, so that a bucket expects
``BUCKET`` unrelated vectors; the number of tables follows from p^k, so that a link of the least
cosine is met in some table with probability ``RECALL``. Links above the least cosine are met more
often. Directions come from a fixed seed: reruns agree.

Copies are one vector with a multiplicity. All vectors of a bucket are compared, in double
precision; a bucket above ``BLOCK`` vectors is dealt out as pairs of blocks to as many tasks. A link
that several tables meet is counted in the first of them (each row carries its bucket numbers), so
that numbers of links are added up without listing pairs; only a spanning forest of each comparison
leaves its task as links.

Cost: every table ships each distinct vector once. Comparing a dense group of m distinct vectors
takes m * m / 2 products in blocks, as counting its links must.

Nulls, empties and ties: vectors that are null, empty, zero or hold null, NaN or infinite
components link with nothing, not even with their copies; vectors link with those of their own
number of components only; every row is a vector of its own, also where ids repeat; a row without an
id belongs to its group, but never names it. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.components import components
from starloom.session import stage

CUT = 0.9
WIDTH = 4.0
BUCKET = 1024
RECALL = 0.97
BLOCK = 2048
SEED = 42


def meeting(width: float) -> float:
    """Probability that a projection puts two vectors into one cell of ``width`` times their distance."""
    tail = 0.5 * math.erfc(width / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * width) * (1 - math.exp(-width * width / 2))


def plan(n: int, cut: float = CUT, recall: float = RECALL, bucket: int = BUCKET) -> tuple[int, int]:
    """Projections of a table and number of tables for ``n`` distinct vectors."""
    far = math.sqrt(2) / math.sqrt(2 - 2 * cut)  # of vectors at right angles, in largest link distances
    projections = max(1, math.ceil(math.log(max(1, n) / bucket) / -math.log(meeting(WIDTH / far)))) if n > bucket else 1
    met = meeting(WIDTH) ** projections
    return projections, max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _rows(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) per number of components."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    out = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out.append((rows, values[(ends[rows] - size)[:, None] + np.arange(size)]))
    return out


def bucket_numbers(vectors: np.ndarray, projections: int, tables: int, cut: float = CUT) -> np.ndarray:
    """One bucket number per vector and table."""
    size = vectors.shape[1]
    chance = np.random.default_rng([SEED, size, projections, tables])
    width = WIDTH * math.sqrt(2 - 2 * cut)
    directions = chance.standard_normal((size, tables * projections))
    shifts = chance.uniform(0, width, tables * projections)
    mixers = chance.integers(1, 2**62, tables * projections) * 2 + 1
    cells = np.floor((_unit(vectors) @ directions + shifts) / width).astype(np.int64)
    with np.errstate(over="ignore"):
        return (cells * mixers).reshape(len(vectors), tables, projections).sum(axis=2) + size


def _usable(embedding: Column) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf))

    return F.coalesce(F.forall(embedding, finite) & F.exists(embedding, lambda x: x != 0), F.lit(False))


def with_buckets(nodes: DataFrame, projections: int, tables: int, cut: float = CUT) -> DataFrame:
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = np.zeros((batch.num_rows, tables), dtype=np.int64)
            for rows, vectors in _rows(batch.column("vector")):
                numbers[rows] = bucket_numbers(vectors, projections, tables, cut)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables)
            listed = pa.ListArray.from_arrays(offsets, pa.array(numbers.ravel()))
            columns = [batch.column(c) for c in ("node", "n", "vector")]
            yield pa.RecordBatch.from_arrays([*columns, listed], names=["node", "n", "vector", "buckets"])

    kind = nodes.schema["vector"].dataType.simpleString()
    return nodes.select("node", "n", "vector").mapInArrow(number, f"node long, n long, vector {kind}, buckets array<long>")


def _cosine_at(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of row pairs from the vectors as given (scaled by their largest component)."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def _compare(
    node: np.ndarray, n: np.ndarray, vectors: np.ndarray, buckets: np.ndarray, part: np.ndarray,
    table: int, low: int, high: int, cut: float,
) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links that this table meets first, as numbers per vector, and a spanning forest of them."""
    unit = _unit(vectors)
    ours = np.flatnonzero(part == low)
    theirs = ours if low == high else np.flatnonzero(part == high)
    links = np.zeros(len(node), dtype=np.int64)
    label = np.arange(len(node))
    tree: list[tuple[int, int]] = []
    for at in range(0, len(ours), 256):
        some = ours[at:at + 256]
        cosine = unit[some] @ unit[theirs].T
        i, j = np.nonzero(cosine >= cut - 1e-9)
        close = cosine[i, j] < cut + 1e-9
        i, j = some[i], theirs[j]
        if close.any():  # too close to the limit for the sum's order not to matter
            keep = ~close
            keep[close] = _cosine_at(vectors[i[close]], vectors[j[close]]) >= cut
            i, j = i[keep], j[keep]
        if low == high:
            i, j = i[i < j], j[i < j]
        if table and i.size:
            new = np.ones(i.size, dtype=bool)
            for t in range(table):
                new &= buckets[i, t] != buckets[j, t]
            i, j = i[new], j[new]
        if i.size:
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            cuts = np.flatnonzero(np.diff(i)) + 1
            for one, others in zip(i[np.concatenate(([0], cuts))].tolist(), np.split(j, cuts)):
                _connect(one, others, label, tree)
    return links, tree


def _connect(one: int, others: np.ndarray, label: np.ndarray, tree: list[tuple[int, int]]) -> None:
    """Add those links from ``one`` that connect groups not yet connected. ``label``: each
    vector's group, always the same number for all of a group."""
    apart = others[label[others] != label[one]]
    for group in np.unique(label[apart]).tolist():
        tree.append((one, int(apart[label[apart] == group][0])))
        label[label == group] = label[one]


def compared(keyed: DataFrame, cut: float = CUT, block: int = BLOCK) -> DataFrame:
    """``a``, ``b``, ``links``: the links that connect all groups (``links`` null), and the numbers of
    links of the vectors (``b`` null), to be added up."""
    index = keyed.select("node", "n", "vector", "buckets", F.posexplode("buckets").alias("table", "bucket"))
    sizes = keyed.select(F.posexplode("buckets").alias("table", "bucket")).groupBy("table", "bucket").count()
    hot = stage(
        sizes.where(F.col("count") > block)
        .select("table", "bucket", F.ceil(F.col("count") / block).cast("int").alias("parts")),
        "hot_buckets",
    )
    dealt = index.join(hot, ["table", "bucket"], "left")
    parts = F.coalesce("parts", F.lit(1))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.select(
        "table", "bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        "part", "node", "n", "vector", "buckets",
    )
    key = ["table", "bucket", "low", "high"]
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def group(rows: pa.Table) -> pa.RecordBatch:
        table, low, high = (rows.column(c)[0].as_py() for c in ("table", "low", "high"))
        node, n, part = (rows.column(c).to_numpy() for c in ("node", "n", "part"))
        listed = rows.column("buckets").combine_chunks()
        buckets = listed.flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1)
        a, b, links = [], [], []
        for at, vectors in _rows(rows.column("vector").combine_chunks()):
            if len(at) < 2:
                continue
            counted, tree = _compare(node[at], n[at], vectors, buckets[at], part[at], table, low, high, cut)
            some, own = np.flatnonzero(counted), node[at]
            a += [own[some], own[[x for x, _ in tree]]]
            b += [np.full(some.size, -1), own[[y for _, y in tree]]]
            links += [counted[some], np.full(len(tree), -1)]
        a, b, links = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (a, b, links))
        arrays = [pa.array(a, pa.int64()), pa.array(b, pa.int64(), mask=b < 0), pa.array(links, pa.int64(), mask=links < 0)]
        return pa.RecordBatch.from_arrays(arrays, schema=out)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in key], axis=1)
            starts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)) if len(keys) else []
            for i, start in enumerate(starts):
                end = starts[i + 1] if i + 1 < len(starts) else len(keys)
                if held and [held[0].column(c)[0].as_py() for c in key] != keys[start].tolist():
                    whole_group = pa.Table.from_batches(held)
                    if whole_group.num_rows > 1:
                        yield group(whole_group)
                    held = []
                held.append(batch.slice(start, end - start))
        if held and sum(x.num_rows for x in held) > 1:
            yield group(pa.Table.from_batches(held))

    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(match, "a long, b long, links long")


def near_duplicates(
    vectors: DataFrame, embedding: str = "embedding", vec_id: str = "vec_id", cut: float = CUT, recall: float = RECALL,
    bucket: int = BUCKET, block: int = BLOCK,
) -> DataFrame:
    """``_id``, ``n_links``, ``component`` and ``kept`` per row of ``vectors``.

    Equal vectors are found by two 64-bit hashes of their components, 128 bits in all.
    """
    given = F.col(embedding)
    rows = stage(
        vectors.select(
            F.col(vec_id).alias("_id"), given.alias("vector"), _usable(given).alias("_usable"),
            F.xxhash64(given).alias("_h1"), F.xxhash64(F.lit(SEED), given).alias("_h2"),
        ),
        "vectors",
    )
    same = rows.where("_usable").groupBy("_h1", "_h2").agg(
        F.min("_id").alias("first"), F.count("*").alias("n"), F.any_value("vector").alias("vector")
    )
    nodes = stage(same.withColumn("node", F.monotonically_increasing_id()), "vector_nodes")
    projections, tables = plan(nodes.count(), cut, recall, bucket)
    keyed = stage(with_buckets(nodes, projections, tables, cut), "vector_buckets")
    found = stage(compared(keyed, cut, block), "vector_links")
    counts = stage(found.where("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links")), "link_counts")
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    rooted = nodes.select("node", "_h1", "_h2", "first", "n").join(stage(roots, "vector_roots"), "node", "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "node")), "rooted_vectors")
    names = stage(rooted.groupBy("root").agg(F.min("first").alias("component")), "vector_names")
    told = rooted.join(names, "root").join(counts, "node", "left").select(
        "_h1", "_h2", F.lit(True).alias("_usable"), "component", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    joined = rows.select("_id", "_h1", "_h2", "_usable").join(stage(told, "vector_classes"), ["_h1", "_h2", "_usable"], "left")
    component = F.when(F.col("_usable"), F.col("component")).otherwise(F.col("_id"))
    return joined.select(
        "_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )
