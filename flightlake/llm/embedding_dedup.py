"""Embedding near-duplicates with a pivot-permutation index.

Reference points (pivots) are vectors of the table itself.  A vector is described by its
PREFIX nearest pivots in order and stands in the inverted list of each.  Two vectors of one
label are candidates when they share at least SHARED pivots; a candidate is counted in the
list of the smallest pivot id they share, so once, and verified by its cosine in double
precision.

The pivots are the only bounded sample: 2 sqrt(vectors) of them, at least LEAST_PIVOTS and at
most MOST_PIVOTS, those with the smallest hashes.  Every vector is indexed.  Equal vectors of
a label are one node with a multiplicity.  A list longer than BLOCK vectors is compared block
against block; what leaves a block is a count per vector and a forest of its links, never
its pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.graph import components, local_roots
from flightlake.session import staged

COSINE = 0.98
PREFIX = 12
SHARED = 2
LEAST_PIVOTS = 64
MOST_PIVOTS = 4096
BLOCK = 2048
#: entries of lists read in one step
READ = 1 << 18


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """A double array per row; None for null, empty, zero or not fully finite vectors."""
    out: list[np.ndarray | None] = []
    for row in column:
        values = row.values
        if values is None or values.null_count or not len(values):
            out.append(None)
            continue
        v = values.to_numpy(zero_copy_only=False).astype(np.float64)
        out.append(v if np.isfinite(v).all() and v.any() else None)
    return out


def _nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, node) of every row; the vector itself with the first of its node in a task."""
    seen: set[int] = set()
    for batch in batches:
        labels = batch.column("label").to_pylist()
        nodes, first = [], []
        for label, v in zip(labels, _vectors(batch.column("embedding"))):
            if v is None or label is None:
                nodes.append(None)
                first.append(None)
                continue
            raw = v.tobytes()
            node = int.from_bytes(hashlib.blake2b(raw, digest_size=8, salt=str(label).encode()[:16]).digest(), "little", signed=True)
            nodes.append(node)
            first.append(None if node in seen else raw)
            seen.add(node)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(nodes, pa.int64()), pa.array(first, pa.binary())],
            names=["vec_id", "label", "node", "vector"])


def _unit(rows: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # squares of very large or small numbers would not hold
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _nearest(pivots, prefix: int):
    """Each vector once for each of its nearest pivots of the same length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "size", "pivot", "node", "copies", "vector", "nearest"]
        for batch in batches:
            size = np.array([len(v) for v in batch.column("vector").to_pylist()], np.int64)
            for s in np.unique(size):
                part = batch.filter(pa.array(size == s))
                ids, points = pivots.value.get(int(s), (np.zeros(1, np.int32), None))
                n, k = part.num_rows, min(prefix, len(ids))
                if points is None:
                    order = np.zeros((n, 1), np.int32)
                else:
                    near = _unit(part.column("vector").to_pylist()) @ points.T
                    order = ids[np.argsort(-near, axis=1, kind="stable")[:, :k]]
                row = pa.array(np.repeat(np.arange(n), k))
                packed = pa.array([o.tobytes() for o in order.astype(np.int32)], pa.binary())
                columns = {
                    "size": pa.array(np.full(n * k, s)), "pivot": pa.array(order.ravel().astype(np.int32)), "nearest": packed.take(row)
                }
                yield pa.RecordBatch.from_arrays(
                    [columns[c] if c in columns else part.column(c).take(row) for c in names], names=names
                )

    return run


def pivot_lists(nearest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pivots of all rows in order, and the row of each."""
    flat = nearest.ravel()
    order = np.argsort(flat, kind="stable")
    return flat[order], order // nearest.shape[1]


def sharing(asking: np.ndarray, lists: tuple[np.ndarray, np.ndarray], n: int, shared: int, pivot: int) -> np.ndarray:
    """Which of n listed rows share enough pivots with each asking row, the smallest of them being `pivot`.

    The lists of an asking row's pivots are read and their rows counted.
    """
    pivots, rows = lists
    flat = asking.ravel()
    begin, end = np.searchsorted(pivots, flat, "left"), np.searchsorted(pivots, flat, "right")
    size = end - begin
    read = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
    pair = np.repeat(np.arange(len(flat)) // asking.shape[1] * n, size) + rows[read]
    enough = np.bincount(pair, minlength=len(asking) * n) >= min(shared, asking.shape[1])
    enough[pair[np.repeat(flat, size) < pivot]] = False
    return enough.reshape(len(asking), n)


def link_block(left: dict, right: dict | None, pivot: int, cosine: float, shared: int):
    """Links of one block: copies linked to each vector, and the linked pairs, in chunks.

    Shared pivots are counted first; cosines are only taken with rows that share enough.
    """
    x, y = left, right or left
    counts = [np.zeros(len(x["node"]), np.int64), np.zeros(len(y["node"]), np.int64)]
    nodes, roots = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lists, n = pivot_lists(y["nearest"]), len(y["node"])
    step = max(1, min(64, READ // y["nearest"].size))
    for low in range(0, len(x["node"]), step):
        part = slice(low, low + step)
        able = sharing(x["nearest"][part], lists, n, shared, pivot)
        if right is None:
            able &= np.arange(low, low + len(able))[:, None] < np.arange(n)
        some = np.flatnonzero(able.any(0))
        others = y["unit"] if len(some) == n else y["unit"][some]
        i, j = np.nonzero(able[:, some] & (x["unit"][part] @ others.T >= cosine - 1e-9))
        i, j = i + low, some[j]
        for at in range(0, len(i), 1 << 16):
            p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            ok = (x["unit"][p] * y["unit"][q]).sum(1) >= cosine
            p, q = p[ok], q[ok]
            np.add.at(counts[0], p, y["copies"][q])
            np.add.at(counts[1], q, x["copies"][p])
            nodes, roots = local_roots(np.concatenate([nodes, x["node"][p]]), np.concatenate([roots, y["node"][q]]))
    return counts, nodes, roots


def _blocks(cosine: float, shared: int):
    """Rows sorted by block; out come (a, copies) counts and (a, b) links."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(rows: list[tuple]) -> dict:
            return {
                "node": np.array([r[0] for r in rows], np.int64), "copies": np.array([r[1] for r in rows], np.int64),
                "unit": _unit([r[2] for r in rows]),
                "nearest": np.frombuffer(b"".join(r[3] for r in rows), np.int32).reshape(len(rows), -1),
            }

        def flush() -> Iterator[pa.RecordBatch]:
            (_, _, pivot, i, j), left, right = key, *held
            if not left or (i != j and not right) or (i == j and len(left) < 2):
                return
            x, y = side(left), side(right) if i != j else None
            counts, nodes, roots = link_block(x, y, pivot, cosine, shared)
            node = np.concatenate([x["node"], (y or x)["node"]])
            count = np.concatenate(counts)
            some, part = count > 0, nodes != roots
            a = np.concatenate([node[some], nodes[part]])
            b = pa.array(np.concatenate([np.zeros(int(some.sum()), np.int64), roots[part]]), mask=np.arange(len(a)) < some.sum())
            links = np.concatenate([count[some], np.zeros(int(part.sum()), np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(links)], names=["a", "b", "links"])

        key, held = None, ([], [])
        names = ("label", "size", "pivot", "i", "j", "salt", "node", "copies", "vector", "nearest")
        for batch in batches:
            for label, size, pivot, i, j, salt, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if (label, size, pivot, i, j) != key:
                    if key is not None:
                        yield from flush()
                    key, held = (label, size, pivot, i, j), ([], [])
                held[int(i != j and salt == j)].append(tuple(row))
        if key is not None:
            yield from flush()

    return run


def _choose_pivots(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Pivot ids and unit vectors by vector length in bytes; at most MOST_PIVOTS rows reach the driver."""
    n = vectors.count()
    many = min(MOST_PIVOTS, max(LEAST_PIVOTS, math.ceil(2 * math.sqrt(n))))
    rows = vectors.select("node", "vector").orderBy(F.xxhash64("node"), "node").limit(many).collect()
    out = {}
    for size in sorted({len(r.vector) for r in rows}):
        mine = [bytes(r.vector) for r in rows if len(r.vector) == size]
        out[size] = (np.arange(1, len(mine) + 1, dtype=np.int32), _unit(mine))
    return out


def embedding_links(embeddings: DataFrame, cosine: float = COSINE, prefix: int = PREFIX, shared: int = SHARED) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `embeddings` (vec_id, embedding, label).

    Vectors that are null, empty, zero or hold null or non-finite components, and those
    without a label, link with nothing; so do vectors of different length.  Repeated rows
    are copies that link with each other.  A null vec_id names no component.  Other columns
    are ignored; an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = embeddings.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label").cast("long")
    )
    seen = staged(rows.mapInArrow(_nodes, "vec_id long, label long, node long, vector binary"), "pivot_nodes")
    ids = seen.select("vec_id", "node")
    copies = seen.filter("node IS NOT NULL").groupBy("node", "label").agg(
        F.count("node").alias("copies"), F.min("vec_id").alias("first"), F.max("vector").alias("vector")
    )
    vectors = staged(copies, "pivot_vectors")
    pivots = spark.sparkContext.broadcast(_choose_pivots(vectors))
    listed = vectors.select("label", "node", "copies", "vector").mapInArrow(
        _nearest(pivots, prefix),
        "label long, size long, pivot int, node long, copies long, vector binary, nearest binary",
    )
    listed = staged(listed, "pivot_lists")
    load = listed.groupBy("label", "size", "pivot").agg(F.ceil(F.count("node") / BLOCK).cast("int").alias("salts"))
    shipped = (
        listed.join(load, ["label", "size", "pivot"])
        .withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .withColumns({"i": F.least("salt", "other"), "j": F.greatest("salt", "other")})
        .drop("salts", "other")
    )
    keys = ["label", "size", "pivot", "i", "j"]
    found = staged(
        shipped.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(_blocks(cosine, shared), "a long, b long, links long"),
        "pivot_links",
    )
    linked = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b"), "pivot_components")
    named = vectors.select("node", "first", "copies").join(roots, "node", "left")
    named = named.select("node", "first", "copies", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    per = named.join(smallest, "root").join(linked, "node", "left")
    per = per.select("node", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    component = F.coalesce("component", "vec_id")
    return ids.join(per, "node", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
