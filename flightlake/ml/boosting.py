"""Histogram gradient boosting with trees kept as a table of nodes.

Trees are grown best-first: at most `leaves` leaves, `depth` levels and `min_leaf` rows a leaf;
the split of the largest gain comes first.  Features are binned (at six decimals), and flights
with equal bins become one cell (bins, flights, sum of the target) in a single shuffle, so the
passes that follow depend on the size of the flight network, not on the number of flights.

A pass adds up gradients per (node, feature, bin) in its tasks and then over tasks; only those
histograms reach the driver, at most nodes of a level * features * bins numbers from each of FEW
tasks.  Six hundred passes make a model, so the cells are kept as blocks of arrays with their
margins and a pass is one small job over them.  Gradients are fixed point and summed as integers:
a fit does not depend on how rows are dealt, and equal splits tie exactly (the first feature, then
the lowest bin wins).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightlake.functions.metrics import rounded
from flightlake.session import staged

DIGITS = 6
#: fixed-point units of a gradient: minutes are large, probabilities small
UNITS = {"squared": 1 << 16, "log": 1 << 30}
LEAST_HESSIAN = 1e-3
#: trees after which the cells are written again with their margins
WRITE_EVERY = 25
#: tasks whose histograms the driver adds up by itself; those of more are added up in tasks first
FEW = 16
#: nodes up to which an ensemble is one column expression; a larger one is walked in Python tasks
EXPRESSION_NODES = 200
#: rows walked at once, so that their bits stay in the processor's cache
WALKED_ROWS = 1024
#: sums of whole numbers up to this size are exact in double precision
EXACT = 1 << 53
_CELLS = "bins binary, n long, y long, margin double"
NODES = "tree int, node int, feature string, threshold double, left int, right int, value double, gain double, n long"


@dataclass(frozen=True)
class BoostSettings:
    """Fixed values of both models: iterations, depth, leaves, rate, rows of a leaf, bins."""

    iterations: int = 100
    depth: int = 6
    leaves: int = 31
    rate: float = 0.08
    min_leaf: int = 30
    bins: int = 255

    def __post_init__(self) -> None:
        if not 2 <= self.bins <= 256:
            raise ValueError("A bin number takes one byte: bins must lie in 2..256.")


@dataclass
class Node:
    """A node by heap number (children of k: 2k and 2k + 1); `feature` -1 is a leaf."""

    number: int
    n: int
    value: float
    feature: int = -1
    bin: int = -1
    gain: float = 0.0


@dataclass
class Tree:
    nodes: dict[int, Node] = field(default_factory=dict)

    def arrays(self) -> tuple[np.ndarray, ...]:
        """(feature, bin, left, right, value, number) by position."""
        order = sorted(self.nodes)
        place = {k: i for i, k in enumerate(order)}
        held = [self.nodes[k] for k in order]
        inner = [h.feature >= 0 for h in held]
        return (
            np.array([h.feature for h in held]),
            np.array([h.bin for h in held]),
            np.array([place[2 * h.number] if x else i for i, (h, x) in enumerate(zip(held, inner))]),
            np.array([place[2 * h.number + 1] if x else i for i, (h, x) in enumerate(zip(held, inner))]),
            np.array([h.value for h in held]),
            np.array(order),
        )


def _walk(arrays: tuple[np.ndarray, ...], bins: np.ndarray, depth: int) -> np.ndarray:
    """Position of the leaf of every row."""
    feature, cut, left, right = arrays[:4]
    child = np.stack([left, right], 1).ravel()
    at, flat, first = np.zeros(len(bins), np.int64), bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    for _ in range(depth):  # a leaf leads to itself either way; its feature -1 reads some other bin
        at = child.take(2 * at + (flat.take(first + feature.take(at)) > cut.take(at)))
    return at


# ---------------------------------------------------------------- bins and cells


def bin_edges(train: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Rising thresholds of every feature: a value at or below threshold b is in bin b or lower.

    Up to `bins` distinct values get a bin each; more are cut where their rows reach the next
    `bins`-th part.  Thresholds lie halfway between neighbours.  Values are counted before they
    are ranked, so the window sees distinct values; what reaches the driver is a row a bin.
    """
    pairs = train.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("feature"), rounded(F.col(c).cast("double"), DIGITS).alias("x")) for i, c in enumerate(features)
    ])).alias("p"))
    counts = pairs.groupBy("p.feature", "p.x").agg(F.count(F.lit(1)).alias("n")).filter("x IS NOT NULL")
    line, whole = Window.partitionBy("feature").orderBy("x"), Window.partitionBy("feature")
    before = F.sum("n").over(line) - F.col("n")
    share = F.floor(before * F.lit(bins) / F.sum("n").over(whole))
    dense = F.dense_rank().over(line) - 1
    many = F.count(F.lit(1)).over(whole) > bins
    placed = counts.select("feature", "x", F.when(many, share).otherwise(dense).alias("bin"))
    ends = placed.groupBy("feature", "bin").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    edges: list[list[float]] = [[] for _ in features]
    last: dict[int, float] = {}
    for row in ends.orderBy("feature", "bin").toArrow().to_pylist():
        i = row["feature"]
        if i in last:
            edges[i].append((last[i] + row["low"]) / 2)
        last[i] = row["high"]
    return edges


def _cells(train: DataFrame, features: list[str], targets: dict[str, str], edges: list[list[float]]) -> DataFrame:
    """(bins, n, y_<loss>...): flights with equal bins as one row, y the sum of a loss's target in fixed point."""
    sums = [f"y_{loss}" for loss in targets]

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [
                np.searchsorted(edge, batch.column(i).to_numpy(zero_copy_only=False), "left") for i, edge in enumerate(edges)
            ]
            codes = np.stack(columns, 1).astype(np.uint8)
            packed = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(len(edges)), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes).tobytes())]
            )
            yield pa.RecordBatch.from_arrays([packed.cast(pa.binary()), *batch.columns[len(edges) :]], names=["bins", *sums])

    scaled = [
        F.round(F.col(label).cast("double") * F.lit(float(UNITS[loss]))).cast("long").alias(y)
        for y, (loss, label) in zip(sums, targets.items())
    ]
    columns = [rounded(F.col(c).cast("double"), DIGITS).alias(c) for c in features]
    rows = train.select(*columns, *scaled).mapInArrow(binned, ", ".join(["bins binary", *[f"{y} long" for y in sums]]))
    return rows.groupBy("bins").agg(F.count(F.lit(1)).alias("n"), *[F.sum(y).alias(y) for y in sums])


@dataclass(frozen=True)
class Cells:
    """Training flights as models see them: the features' thresholds, and the written cells (bins, n, y_<loss>...)."""

    features: list[str]
    edges: list[list[float]]
    table: DataFrame


def training_cells(train: DataFrame, features: list[str], targets: dict[str, str], bins: int) -> Cells:
    """Cells for a model per loss, `targets` names its column; rows without one of the targets are left out."""
    known = train.filter(reduce(lambda a, b: a & b, [F.col(label).isNotNull() for label in targets.values()]))
    edges = bin_edges(known, features, bins)
    return Cells(features, edges, staged(_cells(known, features, targets, edges), "boost_cells"))


def _rows_of(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, width)
    return bins, *(batch.column(i).to_numpy() for i in (1, 2, 3))


def _margins(trees: list[Tree], bins: np.ndarray, margin: np.ndarray, depth: int) -> np.ndarray:
    for tree in trees:
        arrays = tree.arrays()
        margin = margin + arrays[4][_walk(arrays, bins, depth)]
    return margin


def _gradients(loss: str, n: np.ndarray, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the cells' gradients and hessians in fixed point."""
    unit = UNITS[loss]
    if loss == "squared":
        return n * np.rint(margin * unit).astype(np.int64) - y, n * unit
    p = 1.0 / (1.0 + np.exp(-margin))
    return n * np.rint(p * unit).astype(np.int64) - y, n * np.rint(p * (1.0 - p) * unit).astype(np.int64)


# ---------------------------------------------------------------- growing


def _blocks(cells: DataFrame, width: int) -> RDD:
    """The cells as (bins, n, y, margin) arrays, one block an Arrow batch."""

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in _rows_of(batch, width)], names=[*"bnym"])

    def unpacked(row) -> tuple[np.ndarray, ...]:
        kinds = (np.uint8, np.int64, np.int64, np.float64)
        bins, *rest = (np.frombuffer(x, kind) for x, kind in zip(row, kinds))
        return bins.reshape(-1, width), *rest

    return cells.mapInArrow(packed, "b binary, n binary, y binary, m binary").rdd.map(unpacked)


def _binned_sums(cell: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sum of whole numbers by cell, exactly."""
    if int(np.abs(values).sum()) < EXACT:
        return np.bincount(cell, values, size).astype(np.int64)
    sums = np.zeros(size, np.int64)
    np.add.at(sums, cell, values)
    return sums


@dataclass(frozen=True)
class Columns:
    """How the features are counted: `counted` in the tasks, each with its number of bins, the others from those.

    `followed[b]` is (a, bin of b by bin of a) where equal bins of a always come with equal bins of b:
    the sums of b are then sums of a's, so an hour brings its sine and its peak flag along.
    """

    width: int
    counted: list[tuple[int, int]]
    followed: dict[int, tuple[int, np.ndarray]]

    def spread(self, sums: np.ndarray, bins: int) -> np.ndarray:
        """(part, node, feature, bin) sums of all features from the tasks' (part, node, counted bin)."""
        out = np.zeros((*sums.shape[:2], self.width, bins), np.int64)
        start = 0
        for feature, size in self.counted:
            out[:, :, feature, :size] = sums[:, :, start : start + size]
            start += size
        for feature, (source, to) in self.followed.items():
            for b in range(int(to.max()) + 1):
                out[:, :, feature, b] = out[:, :, source, : len(to)][:, :, to == b].sum(axis=2)
        return out


def _columns(blocks: RDD, sizes: list[int]) -> Columns:
    """Which features follow from another one, from the pairs of bins that occur: one job, bits to the driver."""
    pairs = list(combinations(range(len(sizes)), 2))

    def seen(parts: Iterable[tuple[np.ndarray, ...]]) -> Iterator[np.ndarray]:
        found = [np.zeros(sizes[a] * sizes[b], bool) for a, b in pairs]
        for bins, *_ in parts:
            wide = bins.astype(np.int64)
            for (a, b), there in zip(pairs, found):
                there[wide[:, a] * sizes[b] + wide[:, b]] = True
        yield np.packbits(np.concatenate(found)) if found else np.zeros(0, np.uint8)

    bits = np.unpackbits(_added(blocks.mapPartitions(seen), np.bitwise_or)).astype(bool)
    there, start = {}, 0
    for a, b in pairs:
        table = bits[start : start + sizes[a] * sizes[b]].reshape(sizes[a], sizes[b])
        there[a, b], there[b, a] = table, table.T
        start += table.size
    counted, followed = [], {}
    for b in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        source = next((a for a in counted if (there[a, b].sum(axis=1) <= 1).all()), None)
        if source is None:
            counted.append(b)
        else:
            followed[b] = (source, there[source, b].argmax(axis=1))
    return Columns(len(sizes), [(b, sizes[b]) for b in sorted(counted)], followed)


def _added(parts: RDD, add) -> np.ndarray:
    return parts.treeReduce(add, 1 if parts.getNumPartitions() <= FEW else 2)


def _histograms(blocks: RDD, growing: Tree, wanted: list[int], loss: str, columns: Columns, settings: BoostSettings) -> np.ndarray:
    """(node, part, feature, bin): flights, gradients and hessians of the wanted nodes, which share a level; one job."""
    arrays = growing.arrays()
    slots = np.full(len(arrays[5]), -1)
    slots[np.searchsorted(arrays[5], wanted)] = np.arange(len(wanted))
    depth = wanted[-1].bit_length() - 1
    row = sum(size for _, size in columns.counted)
    kinds = 2 if loss == "squared" else 3  # squared: a flight's hessian is one unit

    def added(parts: Iterable[tuple[np.ndarray, ...]]) -> Iterator[np.ndarray]:
        sums = np.zeros((kinds, len(wanted), row), np.int64)
        for bins, n, y, margin in parts:
            slot = slots.take(_walk(arrays, bins, depth))
            here = np.flatnonzero(slot >= 0)
            slot, bins, n = slot[here], bins[here], n[here]
            values = (n, *_gradients(loss, n, y[here], margin[here]))[:kinds]
            start = 0
            for feature, size in columns.counted:
                cell = slot * size + bins[:, feature]
                for part, value in zip(sums, values):
                    part[:, start : start + size] += _binned_sums(cell, value, len(wanted) * size).reshape(-1, size)
                start += size
        yield sums

    sums = columns.spread(_added(blocks.mapPartitions(added), np.add), settings.bins)
    if kinds == 2:
        sums = np.concatenate([sums, sums[:1] * UNITS[loss]])
    return sums.transpose(1, 0, 2, 3)


def best_split(sums: np.ndarray, unit: int, settings: BoostSettings) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best split of a node's (flights, gradients, hessians) by (feature, bin)."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums[:, :1].sum(axis=2, keepdims=True)
    right = whole - left
    (nl, gl, hl), (nr, gr, hr), (_, g, h) = left, right, whole
    gl, gr, g = gl / unit, gr / unit, g / unit
    hl, hr, h = hl / unit, hr / unit, h / unit
    with np.errstate(all="ignore"):
        gain = gl * gl / hl + gr * gr / hr - g * g / h
    few = (nl < settings.min_leaf) | (nr < settings.min_leaf) | (hl < LEAST_HESSIAN) | (hr < LEAST_HESSIAN)
    gain = np.where(few, -np.inf, gain)
    at = int(np.argmax(gain))  # the first of equals
    feature, cut = divmod(at, gain.shape[1])
    return float(gain[feature, cut]), feature, cut


def _best_first(nodes: dict[int, Node], leaves: int) -> Tree:
    """The part of a fully grown tree that best-first growth reaches with so many leaves."""
    kept, open_ = Tree(), [(-nodes[1].gain, 1)]
    while open_:
        _, number = heapq.heappop(open_)
        node = nodes[number]
        if node.feature >= 0 and leaves > 1:
            leaves -= 1
            kept.nodes[number] = node
            for child in (2 * number, 2 * number + 1):
                heapq.heappush(open_, (-nodes[child].gain, child))
        else:
            kept.nodes[number] = Node(number, node.n, node.value)
    return kept


def grow_tree(blocks: RDD, loss: str, columns: Columns, settings: BoostSettings) -> Tree:
    """One more tree for the cells with their margins; a job for each level.

    Of two siblings the one with fewer flights is counted, the other is what their parent has more.
    """
    unit = UNITS[loss]
    growing = Tree({1: Node(1, 0, 0.0)})
    level, wanted = [1], [1]
    held: dict[int, np.ndarray] = {}
    for _ in range(settings.depth):
        sums = dict(zip(wanted, _histograms(blocks, growing, wanted, loss, columns, settings)))
        for number in level:
            if number not in sums:
                sums[number] = held[number >> 1] - sums[number ^ 1]
        held, below, wanted = sums, [], []
        for number in level:
            node, part = growing.nodes[number], sums[number]
            if number == 1:
                n, g, h = (int(x) for x in part[:, 0].sum(axis=1))
                node.n, node.value = n, -(g / unit) / (h / unit) * settings.rate if h else 0.0
            gain, feature, cut = best_split(part, unit, settings)
            if not gain > 0:
                continue
            node.gain, node.feature, node.bin = gain, feature, cut
            low = part[:, feature, : cut + 1].sum(axis=1)
            pair = ((2 * number, low), (2 * number + 1, part[:, feature].sum(axis=1) - low))
            for child, (n, g, h) in pair:
                growing.nodes[child] = Node(child, int(n), float(-(g / unit) / (h / unit) * settings.rate))
            open_ = [child for child, (n, *_) in pair if n >= 2 * settings.min_leaf]
            below += open_
            if open_:
                wanted.append(min(pair, key=lambda x: x[1][0])[0])
        level = below
        if not level:
            break
    return _best_first(growing.nodes, settings.leaves)


def fit(train: DataFrame, features: list[str], label: str, loss: str, settings: BoostSettings = BoostSettings()) -> Ensemble:
    """Boosted trees for minutes (loss squared) or for a 0/1 flag (loss log).

    Rows without a target are left out; a table without rows gives the base 0 and no trees.
    """
    return fit_cells(training_cells(train, features, {loss: label}, settings.bins), loss, settings)


def fit_cells(prepared: Cells, loss: str, settings: BoostSettings = BoostSettings()) -> Ensemble:
    """`fit` on cells that several models may share."""
    unit, features, edges = UNITS[loss], prepared.features, prepared.edges
    counted = prepared.table.select("bins", "n", F.col(f"y_{loss}").alias("y"))
    totals = counted.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    mean = (totals["y"] / unit) / totals["n"] if totals["n"] else 0.0
    base = mean if loss == "squared" else log(mean / (1 - mean)) if 0 < mean < 1 else (40.0 if mean else -40.0)
    cells = counted.withColumn("margin", F.lit(base))
    trees: list[Tree] = []
    written, width, before = 0, len(features), None
    blocks = _blocks(cells, width).persist(StorageLevel.MEMORY_AND_DISK)
    columns = _columns(blocks, [len(edge) + 1 for edge in edges]) if totals["n"] else None
    for _ in range(settings.iterations if totals["n"] else 0):
        trees.append(grow_tree(blocks, loss, columns, settings))
        if before is not None:
            before.unpersist()
        before = blocks
        if len(trees) - written == WRITE_EVERY and len(trees) < settings.iterations:
            cells = staged(_moved(cells, trees[written:], width, settings.depth), "boost_cells")
            written = len(trees)
            blocks = _blocks(cells, width).persist(StorageLevel.MEMORY_AND_DISK)
        elif len(trees) < settings.iterations:
            blocks = _after(blocks, trees[-1], settings.depth).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.unpersist()
    rows = [(-1, 1, None, None, None, None, base, None, int(totals["n"] or 0))]
    for t, tree in enumerate(trees):
        for number, node in sorted(tree.nodes.items()):
            inner = node.feature >= 0
            rows.append((
                t, number, features[node.feature] if inner else None, edges[node.feature][node.bin] if inner else None,
                2 * number if inner else None, 2 * number + 1 if inner else None, node.value, node.gain if inner else None, node.n,
            ))
    return Ensemble(loss, rows)


def _after(blocks: RDD, tree: Tree, depth: int) -> RDD:
    """The blocks with one more tree in their margins."""

    def moved(block: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        bins, n, y, margin = block
        return bins, n, y, _margins([tree], bins, margin, depth)

    return blocks.map(moved)


def _moved(cells: DataFrame, trees: list[Tree], width: int, depth: int) -> DataFrame:
    def moved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, _, _, margin = _rows_of(batch, width)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(_margins(trees, bins, margin, depth))], names=["bins", "n", "y", "margin"]
            )

    return cells.mapInArrow(moved, _CELLS)


# ---------------------------------------------------------------- trees as a relation


def _balanced(terms: list):
    """Sum of neighbours, then of their sums: shallow as an expression, and one order for columns and arrays."""
    while len(terms) > 1:
        terms = [reduce(lambda a, b: a + b, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]


@dataclass(frozen=True)
class Ensemble:
    """Trees as rows (tree, node, feature, threshold, left, right, value, gain, n).

    Tree -1 has one leaf, the base.  An inner node sends values at or below its threshold left,
    all others (null and NaN too) right; a leaf has no feature.  Its size is fixed by the settings.
    """

    loss: str
    rows: list[tuple]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, NODES).withColumn("loss", F.lit(self.loss))

    @staticmethod
    def of_table(table: DataFrame) -> Ensemble | None:
        """The ensemble of a node table, None when the table has no rows."""
        rows = table.orderBy("tree", "node").toArrow().to_pylist()
        names = [part.split()[0] for part in NODES.split(", ")]
        return Ensemble(rows[0]["loss"], [tuple(row[c] for c in names) for row in rows]) if rows else None

    def margin(self, features: dict[str, Column] | None = None) -> Column:
        """Sum of the trees as one column; `features` replaces columns of the same name.

        Thousands of nested conditions outgrow what the JVM compiles, so a large ensemble is
        walked over Arrow batches; it adds its trees in the same order as the expression.
        """
        found = dict(features or {})
        if len(self.rows) > EXPRESSION_NODES:
            return self._walked(found)
        by_tree: dict[int, dict[int, tuple]] = {}
        for row in self.rows:
            by_tree.setdefault(row[0], {})[row[1]] = row

        def value(nodes: dict[int, tuple], number: int) -> Column:
            _, _, feature, threshold, left, right, leaf, *_ = nodes[number]
            if feature is None:
                return F.lit(float(leaf))
            at = found.setdefault(feature, F.col(feature))
            return F.when(at <= F.lit(float(threshold)), value(nodes, left)).otherwise(value(nodes, right))

        terms = [value(nodes, 1) for _, nodes in sorted(by_tree.items())]
        return _balanced(terms)

    def _walked(self, found: dict[str, Column]) -> Column:
        """The trees over Arrow batches: leaves by bits, as QuickScorer finds them.

        A value knows, for every tree, the leaves that its feature's conditions leave open; what all
        features leave open begins with the row's leaf.
        """
        names = sorted({row[2] for row in self.rows if row[2] is not None})
        trees: dict[int, dict[int, tuple]] = {}
        for row in self.rows:
            trees.setdefault(row[0], {})[row[1]] = row
        cuts = {c: np.array(sorted({row[3] for row in self.rows if row[2] == c})) for c in names}
        most = max(sum(row[2] is None for row in nodes.values()) for nodes in trees.values())
        words = -(-most // 32)
        whole = np.uint32(0xFFFFFFFF)
        open_ = {c: np.full((len(cuts[c]) + 1, len(trees), words), whole) for c in names}
        leaves = np.zeros((len(trees), 32 * words))

        def place(tree: int, nodes: dict[int, tuple], number: int, first: int) -> int:
            """Leaves below a node get numbers from `first`; returns the next one."""
            _, _, feature, threshold, left, right, value, *_ = nodes[number]
            if feature is None:
                leaves[tree, first] = value
                return first + 1
            after = place(tree, nodes, left, first)
            beyond = np.searchsorted(cuts[feature], threshold) + 1  # values above the threshold
            for leaf in range(first, after):
                open_[feature][beyond:, tree, leaf // 32] &= ~np.uint32(1 << leaf % 32)
            return place(tree, nodes, right, after)

        for t, (_, nodes) in enumerate(sorted(trees.items())):
            place(t, nodes, 1, 0)
        first_leaf = np.arange(len(trees)) * 32 * words

        def added(columns: list[np.ndarray]) -> np.ndarray:
            left = np.full((len(columns[0]), len(trees), words), whole)
            for c, x in zip(names, columns):  # NaN lies beyond all thresholds
                left &= open_[c].take(np.searchsorted(cuts[c], x, "left"), 0)
            at = np.zeros(left.shape[:2], np.int64)
            for word in reversed(range(words)):
                bits = left[:, :, word]
                at = np.where(bits > 0, 32 * word + np.bitwise_count((bits & (~bits + np.uint32(1))) - np.uint32(1)), at)
            return _balanced(list(leaves.ravel().take(at + first_leaf).T))

        @F.pandas_udf("double")
        def margin(*columns: pd.Series) -> pd.Series:
            values = [c.to_numpy(float, na_value=np.nan) for c in columns]
            parts = [added([x[i : i + WALKED_ROWS] for x in values]) for i in range(0, len(values[0]), WALKED_ROWS)]
            return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

        return margin(*[found.get(c, F.col(c)).cast("double") for c in names])

    def output(self, features: dict[str, Column] | None = None) -> Column:
        """Minutes, never below zero, or a probability."""
        margin = self.margin(features)
        return F.greatest(margin, F.lit(0.0)) if self.loss == "squared" else 1.0 / (1.0 + F.exp(-margin))


def rounded_features(rows: DataFrame, features: list[str]) -> DataFrame:
    """Features as the trees see them: doubles of six decimals, under the same names."""
    kinds = dict(rows.dtypes)
    fractions = [c for c in features if kinds[c] in ("double", "float")]
    return rows.withColumns({c: rounded(F.col(c), DIGITS) for c in fractions})
