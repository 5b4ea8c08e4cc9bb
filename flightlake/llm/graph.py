"""Connected components and fixed-size membership sieves over DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.session import staged

SIEVE_BITS = 1 << 24


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes of the edges (a, b) and the smallest node reachable from each."""
    nodes, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ids[: len(a)], ids[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y):
            np.minimum.at(new, label[side], low)
            np.minimum.at(new, side, low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    return nodes, nodes[label]


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one partition as a forest, folded batch by batch: memory follows the nodes."""
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        x, y = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        nodes, roots = local_roots(np.concatenate([a, x]), np.concatenate([b, y]))
        a, b = nodes[nodes != roots], roots[nodes != roots]
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b), both long; root is the smallest id.

    Each partition folds its edges to a forest, then labels spread along the
    forest and are shortened by pointer jumping until none changes.  All tables
    are written to the shared folder, so a lost executor costs one task.
    """
    forest = edges.select("a", "b").mapInArrow(_contract, "a long, b long").distinct()
    forest = staged(forest.repartition("a").mapInArrow(_contract, "a long, b long"), f"{name}_forest")
    pairs = forest.unionByName(forest.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = staged(
        pairs.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("root")
        ),
        f"{name}_labels",
    )
    while True:
        near = (
            pairs.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("root").alias("near"))
        )
        low = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("low")
        )
        target = labels.select(F.col("node").alias("t"), F.col("root").alias("far"))
        jumped = low.join(target, F.col("low") == F.col("t"), "left").select(
            "node", "old", F.least("low", F.coalesce("far", "low")).alias("root")
        )
        saved = staged(jumped, f"{name}_labels")
        labels = saved.select("node", "root")
        if saved.filter("old != root").isEmpty():
            return labels


def sieve(keys: DataFrame, column: str, bits: int = SIEVE_BITS) -> np.ndarray:
    """Bit set of fixed size with a bit for each whole-number key, to exclude rows before a shuffle.

    It never excludes a key that is in the table; what passes is joined exactly
    afterwards.  The driver gets at most bits / 64 rows, whatever the table's size.
    """
    slot = F.pmod(F.col(column), F.lit(bits))
    words = keys.groupBy(F.shiftright(slot, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, int(pmod(`{column}`, 64)))")).alias("m")
    )
    out = np.zeros(bits // 64, np.int64)
    rows = words.toArrow()
    out[rows.column("w").to_numpy()] = rows.column("m").to_numpy()
    return out.view(np.uint64)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which whole-number keys may be in the table of the sieve."""
    slot = np.mod(keys.astype(np.int64), len(bits) * 64)
    return (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
