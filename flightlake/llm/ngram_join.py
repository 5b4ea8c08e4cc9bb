"""N-gram Jaccard self-join of documents with prefix trees.

A document's set holds its distinct five-word shingles, in the global order of their
hashes; two documents link when their sets' Jaccard similarity reaches the threshold.

1. Candidates.  Sets that link differ in at most k shingles, k following from their
   sizes.  The hash space is cut into k + 1 segments, so at least one segment holds
   the same shingles in both.  Documents meet by the hash of a whole segment, some four
   shingles from all over the text, so a common line or passage brings nobody
   together.  Size classes grow by 1 / threshold, and a set is cut for its own class
   and the one below: every pair that can link is cut alike once.
2. Documents that met in a segment travel as one group, equal groups once, to their
   sketches.  Every pair of a group is held against a bound: the parities of two sets'
   hashes differ in no more cells than the sets do.  Only a forest of the pairs that pass leaves
   the task, so rows grow with the documents of a group and not with its pairs.  Where
   more than GROUP documents meet in one segment they are joined unseen, in a chain.  A large
   group meets in the segments of every task, so chains leave a task packed by node and are
   added up before they become rows: about one for each document, however many tasks saw it.
   Segments that many documents share join most of a large corpus in one chain, so chains are
   sifted: what one joins is held against the bound too, block against block within neighbouring
   size classes, and only the pairs that pass are candidates.
3. Only the sets of candidates are shipped, each to its component's blocks.  A
   block stores them in a prefix tree and walks it with all queries at once: the
   overlap counted down to a node serves every set below it, and a subtree is
   left when the shingles that remain on either side cannot reach the threshold.

Equal sets are one node from the start.  A block holds at most about BLOCK_SETS
sets or BLOCK_TOKENS shingles a side; larger components are compared block against block, so
no pair is missed and no task holds a component whole.

Nodes and shingles are 64-bit hashes.  Segments that are empty on both sides say
nothing, so small sets are cut by several seeds (SEEDS): the chance that a pair just at the
threshold meets in none of them stays below 1e-8, and far below that above it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.graph import components, local_roots, passes, sieve
from flightlake.llm.words import bucket_of, mix, shingle_sets, tokenise
from flightlake.session import staged

SHINGLE = 5
BLOCK_SETS = 1024
BLOCK_TOKENS = 1 << 19
#: seeds by the largest set size of the class
SEEDS = ((64, 8), (256, 2), (1 << 62, 1))
#: documents of one segment that are compared with each other
GROUP = 32
#: sketches a side of a block of chained documents, and their bytes
SIFT_SETS = 4096
SIFT_BYTES = 1 << 22
_FLUSH = 1 << 20
_SHORT = (1 << 40) - 1
_MARK = 1 << 25


def _nodes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit identity per set, the same for equal sets."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values ^ np.uint64(0xD6E8FEB86659FD93)), out=total[1:])
    size = np.diff(bounds).astype(np.uint64)
    return mix(total[bounds[1:]] - total[bounds[:-1]] + size * np.uint64(0xA0761D6478BD642F)).view(np.int64)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, shingles, bounds, nodes) for the texts of a batch, A to Z folded."""
    for first, words, bounds in tokenise(batch.column("text"), fold=True):
        values, rows = shingle_sets(words, bounds, size)
        yield first, values, rows, _nodes(values, rows)


def _scan(size: int):
    """(doc_id, text_key, node, set size) of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, bounds, node in _sets(batch, size):
                nodes.append(node)
                sizes.append(np.diff(bounds))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(np.concatenate(nodes)),
                 pa.array(np.concatenate(sizes))], names=["doc_id", "text_key", "node", "n_shingles"])

    return run


def size_classes(largest: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first size, segments, seeds) of every class up to the largest size.

    The partner of a set is at most 100 / percent times as large, so it is in the
    same class or the next.
    """
    first, segments, seeds = [1], [], []
    while first[-1] <= largest or len(first) < 3:
        top = max(first[-1], (first[-1] - 1) * 100 // percent)
        partner = top * 100 // percent
        first.append(top + 1)
        segments.append((top + partner) * (100 - percent) // (100 + percent) + 1)
        seeds.append(next(n for most, n in SEEDS if top <= most))
    return np.array(first[:-1]), np.array(segments), np.array(seeds)


def segment_keys(values: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all segments that hold shingles, and the row of each."""
    n = np.diff(bounds)
    first, segments, seeds = size_classes(int(n.max(initial=1)), percent)
    own = np.searchsorted(first, n, "right") - 1
    row = np.repeat(np.arange(len(n)), n)
    keys, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    weight = mix(values ^ np.uint64(0xC2B2AE3D27D4EB4F))
    for below in (0, 1):
        level = own - below
        for seed in range(SEEDS[0][1]):
            chosen = (n > 0) & (level >= 0)
            chosen[chosen] = seeds[level[chosen]] > seed
            if not chosen.any():
                continue
            width = np.where(chosen, segments[np.maximum(level, 0)], 0)
            place = np.cumsum(width) - width
            take = chosen[row]
            of = row[take]
            spread = values[take] if not seed else mix(values[take] + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
            cell = place[of] + ((spread >> np.uint64(32)) * width[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            total = np.zeros(int(width.sum()), np.uint64)
            np.add.at(total, cell, weight[take])
            full = np.flatnonzero(np.bincount(cell, minlength=len(total)))
            who = np.repeat(np.arange(len(n)), width)[full]
            salt = (level[who] * 8 + seed).astype(np.uint64) << np.uint64(40)
            keys.append(mix(total[full] ^ mix(salt + (full - place[who]).astype(np.uint64))))
            rows.append(who)
    return np.concatenate(keys), np.concatenate(rows)


def _packed(x: np.ndarray) -> bytes:
    """Low five bytes of each number."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpacked(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(x, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view(np.int64)


def _segments(size: int, percent: int, buckets: int):
    """Segment keys of every set by bucket; equal sets go once, and of a key in one flush
    at most GROUP + 1 rows.

    Rows with null `keys` carry the chain of what a crowded key leaves out, as (nodes, roots).
    """

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        keys, nodes = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(keys)
        keys, nodes = keys[order], nodes[order]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        place = np.arange(len(keys)) - np.repeat(start, np.diff(np.append(start, len(keys))))
        crowded = place > GROUP
        x, y = local_roots(nodes[crowded], nodes[np.flatnonzero(crowded) - 1])
        rows = [(int(bucket_of(keys[:1], buckets)[0]), None, _packed(x), _packed(y))] if len(x) else []
        keys, nodes = keys[~crowded], nodes[~crowded]
        bucket = bucket_of(keys, buckets)
        order = np.argsort(bucket, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            rows.append((int(bucket[part[0]]), _packed(keys[part]), _packed(nodes[part]), None))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
            names=["bucket", "keys", "nodes", "roots"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, count = [], 0
        for batch in batches:
            for _, values, bounds, nodes in _sets(batch, size):
                n = np.diff(bounds)
                new = np.zeros(len(nodes), bool)
                for i, node in enumerate(nodes.tolist()):
                    if n[i] and node not in seen:
                        seen.add(node)
                        new[i] = True
                if not new.any():
                    continue
                values = values[np.repeat(new, n)]
                keys, row = segment_keys(values, np.concatenate([[0], np.cumsum(n[new])]), percent)
                held.append((keys, nodes[new][row] & _SHORT))
                count += len(keys)
                if count > _FLUSH:
                    yield from flush(held)
                    held, count = [], 0
        if held:
            yield from flush(held)

    return run


def _meet(ranges: int):
    """(members, part, nodes, roots): groups that share a segment in the buckets of a task, and the chains
    of its crowded ones, packed for each of the `ranges` that their nodes are dealt to.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, x, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], []
        for batch in batches:
            for bucket, key, node, root in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if key is None:
                    x.append(_unpacked(node))
                    y.append(_unpacked(root))
                else:
                    keys.append(_unpacked(key))
                    nodes.append(_unpacked(node))
        key, node = np.concatenate(keys), np.concatenate(nodes)
        del keys, nodes
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.ones(len(key), bool)  # a set that several tasks have sent
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node = key[new], node[new]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(first)
        width = np.diff(np.append(start, len(key)))
        crowded = np.repeat(width > GROUP, width)
        crowded[start] = False
        x.append(node[crowded])
        y.append(node[np.flatnonzero(crowded) - 1])
        x, y = local_roots(np.concatenate(x), np.concatenate(y))
        apart = x != y
        rows: list[tuple] = []
        for size in range(2, GROUP + 1):
            at = start[width == size]
            if len(at):
                groups = np.unique(node[at[:, None] + np.arange(size)], axis=0)
                place = np.minimum(np.searchsorted(x, groups), max(len(x) - 1, 0))
                chain = np.where(x[place] == groups, y[place], groups) if len(x) else groups
                groups = groups[(chain != chain[:, :1]).any(axis=1)]  # what a chain joins is no group
                rows += [(_packed(group), None, None, None) for group in groups]
        a, b = x[apart], y[apart]
        part = (mix(a.view(np.uint64)) % np.uint64(ranges)).astype(np.int64)
        rows += [(None, int(p), _packed(a[part == p]), _packed(b[part == p])) for p in np.unique(part)]
        kinds = (pa.binary(), pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], names=["members", "part", "nodes", "roots"]
        )

    return run


def _chains(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): the packed chains of a task as one forest, folded batch by batch."""
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        nodes, roots = ([_unpacked(x) for x in batch.column(c).to_pylist()] for c in ("nodes", "roots"))
        nodes, roots = local_roots(np.concatenate([a, *nodes]), np.concatenate([b, *roots]))
        a, b = nodes[nodes != roots], roots[nodes != roots]
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(met, short): one row for each member of a group."""
    for batch in batches:
        parts = [_unpacked(m) for m in batch.column("members").to_pylist()]
        ids = np.repeat(batch.column("met").to_numpy(), [len(p) for p in parts])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate([ids[:0], *parts]))], names=["met", "short"])


def sketch(values: np.ndarray) -> bytes:
    """Parities of the number of a set's shingles by hash, two to four cells for each; cells are a power of two."""
    cells = 1 << max(6, (2 * len(values)).bit_length())
    counts = np.bincount((mix(values) >> np.uint64(32)).astype(np.int64) % cells, minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A number of shingles by which two sets differ at least: the cells of unlike parity, with like cells on both sides."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    for cells in range(abs(len(a).bit_length() - len(b).bit_length())):
        half = 4 * max(len(a), len(b)) >> cells
        if len(a) > len(b):
            x = (x >> half) ^ (x & ((1 << half) - 1))
        else:
            y = (y >> half) ^ (y & ((1 << half) - 1))
    return (x ^ y).bit_count()


def _sketches(size: int, percent: int, bits):
    """(short, node, n, level, cells) of the nodes that pass the sieve, once a task; the level is the size class."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            out: list[tuple[int, int, int, int, bytes]] = []
            for _, values, bounds, nodes in _sets(batch, size):
                short, n = nodes & _SHORT, np.diff(bounds)
                level = np.searchsorted(size_classes(int(n.max(initial=1)), percent)[0], n, "right") - 1
                for i in np.flatnonzero(passes(bits.value, short) & (n > 0)):
                    if (node := int(nodes[i])) not in seen:
                        seen.add(node)
                        out.append((int(short[i]), node, int(n[i]), int(level[i]), sketch(values[bounds[i] : bounds[i + 1]])))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["short", "node", "n", "level", "cells"]
            )

    return run


def sift(n: np.ndarray, cells: list[bytes], side: np.ndarray, upper: np.ndarray, percent: int) -> np.ndarray:
    """A label for every set of a block; pairs whose sizes and sketches allow a link have equal ones.

    Sets of side 0 are held against those of side 1 where there are any, else against each other;
    two `upper` sets are not, they meet as the lower ones of the next size class.  A pair that is
    joined already is not looked at, so a block of near copies costs little more than its rows.
    """
    few = min(len(c) for c in cells)
    rows = np.zeros((len(cells), few // 8), np.uint64)
    for i, c in enumerate(cells):
        words = np.frombuffer(c, np.uint64)
        rows[i] = np.bitwise_xor.reduce(words.reshape(-1, few // 8), axis=0)
    label, places, two = np.arange(len(cells)), np.arange(len(cells)), bool(side.any())
    for i in range(len(cells)):
        there = side != side[i] if two else places > i
        if two and side[i]:
            continue
        there = there & (label != label[i]) & (np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * percent)
        if upper[i]:
            there &= ~upper
        at = np.flatnonzero(there)
        apart = np.bitwise_count(rows[at] ^ rows[i]).sum(axis=1, dtype=np.int64)
        hit = at[apart * (100 + percent) <= (n[at] + n[i]) * (100 - percent)]
        if len(hit):
            label[np.isin(label, label[hit])] = label[i]
    return label


def _sift(percent: int):
    """Forests of the chained sets that may link; rows are sorted by block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            short, n, side, upper = (np.array(x) for x in list(zip(*held))[:4])
            root = short[sift(n, [row[4] for row in held], side, upper, percent)]
            part = short != root
            return pa.RecordBatch.from_arrays([pa.array(short[part]), pa.array(root[part])], names=["a", "b"])

        held: list[tuple[int, int, int, bool, bytes]] = []
        last = None
        for batch in batches:
            names = ("root", "level", "i", "j", "salt", "upper", "short", "n", "cells")
            for root, level, i, j, salt, upper, short, n, cells in zip(*(batch.column(c).to_pylist() for c in names)):
                if (root, level, i, j) != last:
                    if len(held) > 1:
                        yield flush()
                    held, last = [], (root, level, i, j)
                held.append((short, n, int(i != j and salt == j), upper, cells))
        if len(held) > 1:
            yield flush()

    return run


def _sifted(chains: DataFrame, sketches: DataFrame, percent: int, parts: int) -> DataFrame:
    """(a, b): a forest of the pairs of chained documents that may link.

    A set meets those of its own size class and, as an upper one, those of the class below.
    """
    placed = components(chains, "ngram_chained").withColumnRenamed("node", "short").join(sketches, "short")
    both = placed.withColumn("upper", F.explode(F.array(F.lit(False), F.lit(True))))
    both = both.withColumn("level", F.col("level") - F.col("upper").cast("int")).filter("level >= 0")
    load = both.groupBy("root", "level").agg(
        F.ceil(F.greatest(F.count("n") / SIFT_SETS, F.sum(F.length("cells")) / SIFT_BYTES)).cast("int").alias("salts"),
        F.count(F.when(~F.col("upper"), 1)).alias("lower"),
        F.count("n").alias("sets"),
    ).filter("lower > 0 AND sets > 1")
    blocks = (
        both.join(load, ["root", "level"])
        .withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .select("root", "level", F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"),
                "salt", "upper", "short", "n", "cells")
    )
    key = ["root", "level", "i", "j"]
    return blocks.repartition(parts, *key).sortWithinPartitions(*key).mapInArrow(_sift(percent), "a long, b long")


def _possible(percent: int):
    """A forest of the pairs whose sizes and sketches allow a link; rows are sorted by group.

    Two sets may share a short id; a pair passes when any sets behind its ids allow it.
    """

    def allowed(group: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int]]:
        for i, (a, n, cells) in enumerate(group):
            for b, m, others in group[:i]:
                if a == b or min(n, m) * 100 < max(n, m) * percent:
                    continue
                if least_difference(cells, others) * (100 + percent) <= (n + m) * (100 - percent):
                    yield a, b

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            nodes, roots = local_roots(*np.array(pairs, np.int64).reshape(-1, 2).T)
            part = nodes != roots
            pairs.clear()
            return pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(roots[part])], names=["a", "b"])

        pairs: list[tuple[int, int]] = []
        last, group = None, []
        for batch in batches:
            for met, short, n, cells in zip(*(batch.column(c).to_pylist() for c in ("met", "short", "n", "cells"))):
                if met != last:
                    pairs += allowed(group)
                    last, group = met, []
                    if len(pairs) > _FLUSH:
                        yield flush()
                group.append((short, n, cells))
        pairs += allowed(group)
        yield flush()

    return run


def _candidates(size: int, bits):
    """Sets of the nodes that pass the sieve, once a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            out: list[tuple[int, bytes]] = []
            for _, values, bounds, nodes in _sets(batch, size):
                for i in np.flatnonzero(passes(bits.value, nodes & _SHORT) & (np.diff(bounds) > 0)):
                    if (node := int(nodes[i])) not in seen:
                        seen.add(node)
                        out.append((node, values[bounds[i] : bounds[i + 1]].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())],
                names=["node", "tokens"])

    return run


class PrefixForest:
    """Prefix trees of many groups of ordered sets, level by level in flat arrays."""

    def __init__(self, group: np.ndarray, stored: np.ndarray, full: np.ndarray, codes: np.ndarray, bounds: np.ndarray):
        length = np.diff(bounds)
        at = np.unique(group)
        parent = np.searchsorted(at, group)  # level 0: one root for each group
        self.roots, self.levels = at, []
        live = np.flatnonzero(stored & (length > 0))
        width, depth = len(at), 0
        top = int(codes.max()) + 1 if len(codes) else 1
        while len(live):
            key = parent[live] * top + codes[bounds[live] + depth]
            keys, inverse = np.unique(key, return_inverse=True)
            n = len(keys)
            level = {"code": keys % top, "first": np.searchsorted(keys // top, np.arange(width + 1))}
            level["most"] = np.zeros(n, np.int64)
            level["least"] = np.full(n, np.iinfo(np.int64).max)
            level["last"] = np.full(n, -1)
            np.maximum.at(level["most"], inverse, length[live])
            np.minimum.at(level["least"], inverse, full[live])
            np.maximum.at(level["last"], inverse, live)
            ends = length[live] == depth + 1
            order = np.argsort(inverse[ends], kind="stable")  # sets that differ in unshared tokens end alike
            level["sets"] = live[ends][order]
            level["sets_first"] = np.searchsorted(inverse[ends][order], np.arange(n + 1))
            self.levels.append(level)
            parent[live] = inverse
            live = live[~ends]
            width, depth = n, depth + 1

    def links(self, queries, start, full, length, mark, place, percent: int, ordered: bool):
        """Pairs (query, stored set) at or above the threshold.

        `place` is where a query's marks begin; `ordered` looks for each pair of
        one side once.
        """
        query, node = queries, start
        shared = np.zeros(len(queries), np.int64)
        found_q, found_s = [], []
        for depth, level in enumerate(self.levels):
            first, last = level["first"][node], level["first"][node + 1]
            fan = last - first
            query, shared = np.repeat(query, fan), np.repeat(shared, fan)
            node = np.arange(len(query)) - np.repeat(np.cumsum(fan) - fan, fan) + np.repeat(first, fan)
            if ordered:
                keep = level["last"][node] > query
                query, shared, node = query[keep], shared[keep], node[keep]
            shared = shared + mark[place[query] + level["code"][node]]
            low = level["sets_first"][node]
            many = level["sets_first"][node + 1] - low
            who = np.repeat(np.arange(len(node)), many)
            ends = level["sets"][np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many) + low[who]]
            hit = (ends > query[who]) if ordered else (ends != query[who])
            hit &= (100 + percent) * shared[who] >= percent * (full[query[who]] + full[ends])
            found_q.append(query[who][hit])
            found_s.append(ends[hit])
            size = full[query]
            smallest = np.maximum(level["least"][node], -(-size * percent // 100))
            reach = shared + np.minimum(level["most"][node] - depth - 1, length[query] - shared)
            keep = (100 + percent) * reach >= percent * (size + smallest)
            query, shared, node = query[keep], shared[keep], node[keep]
            if not len(query):
                break
        return np.concatenate(found_q or [queries[:0]]), np.concatenate(found_s or [queries[:0]])


def link_groups(groups: list[list[tuple[int, int, np.ndarray]]], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of nodes in each group of (node, side, ordered tokens).

    Side 0 is compared with itself, or with side 1 where the group has one.
    Tokens of one set alone cannot be shared and are left out of the trees; the
    sets keep their full size.
    """
    node, side, group, full, parts, width = [], [], [], [], [], []
    for g, members in enumerate(groups):
        tokens = np.concatenate([t for _, _, t in members])
        values, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        common = counts > 1
        code = np.cumsum(common) - 1
        at = 0
        for n, s, t in members:
            mine = inverse[at : at + len(t)]
            at += len(t)
            parts.append(code[mine[common[mine]]])
            node.append(n)
            side.append(s)
            group.append(g)
            full.append(len(t))
        width.append(int(common.sum()))
    node, side, group = np.array(node, np.int64), np.array(side), np.array(group)
    full, width = np.array(full, np.int64), np.array(width, np.int64)
    length = np.array([len(p) for p in parts], np.int64)
    codes = np.concatenate(parts)
    bounds = np.concatenate([[0], np.cumsum(length)])
    two = np.zeros(len(groups), bool)
    two[group[side == 1]] = True
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for ordered in (True, False):
        mine = two[group] != ordered
        stored = mine & ((side == 1) | ordered)
        asks = np.flatnonzero(mine & ((side == 0) | ordered) & (length > 0))
        if not stored.any() or not len(asks):
            continue
        forest = PrefixForest(group, stored, full, codes, bounds)
        room = np.cumsum(width[group[asks]]) // _MARK
        for part in np.split(asks, np.flatnonzero(np.diff(room)) + 1):
            need = width[group[part]]
            place = np.zeros(len(node), np.int64)
            place[part] = np.cumsum(need) - need
            mark = np.zeros(int(need.sum()), bool)
            for q in part:
                mark[place[q] + codes[bounds[q] : bounds[q + 1]]] = True
            start = np.searchsorted(forest.roots, group[part])
            q, s = forest.links(part, start, full, length, mark, place, percent, ordered)
            a.append(node[q])
            b.append(node[s])
    return np.concatenate(a), np.concatenate(b)


def _blocks(percent: int):
    """Rows sorted by block; several small blocks are joined in one go."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            x, y = link_groups(groups, percent)
            if len(x):
                nodes, roots = local_roots(x, y)
                part = nodes != roots
                yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(roots[part])], names=["a", "b"])

        groups: list[list] = []
        last, held = None, 0
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j", "salt", "node", "tokens")))
            for root, i, j, salt, node, tokens in rows:
                if (root, i, j) != last:
                    if held > BLOCK_TOKENS:
                        yield from flush()
                        groups, held = [], 0
                    groups.append([])
                    seen: set[int] = set()
                    last = (root, i, j)
                if node not in seen:  # a set that several tasks have sent
                    seen.add(node)
                    groups[-1].append((node, int(i != j and salt == j), np.frombuffer(tokens, np.uint64)))
                    held += len(tokens) // 8
        if groups:
            yield from flush()

    return run


def ngram_components(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`, which has doc_id and text.

    A document without words or text is empty and linked with nothing: its
    component is its own id.  Repeated rows come out as often as they went in.
    A null doc_id stays null and never names a component unless all its
    documents have none.  Other columns are ignored; an empty table gives an
    empty result.
    """
    return _grouped(docs, percent, shingle).drop("text_key")


def _grouped(docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id); the key is a hash of the text."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    ids = staged(keyed.mapInArrow(_scan(shingle), "doc_id long, text_key long, node long, n_shingles long"), "ngram_ids")
    keys = texts.mapInArrow(
        _segments(shingle, percent, 8 * parts), "bucket int, keys binary, nodes binary, roots binary"
    )
    ranges = 1 + isqrt(parts)  # with so many, neither the packed rows nor what one range gathers outgrow the tasks
    met = keys.repartition(parts, "bucket").mapInArrow(_meet(ranges), "members binary, part int, nodes binary, roots binary")
    met = staged(met.distinct().withColumn("met", F.xxhash64("members")), "ngram_met")
    entries = met.filter("members IS NOT NULL").select("met", "members").mapInArrow(_entries, "met long, short long")
    chains = met.filter("members IS NULL").select("part", "nodes", "roots").repartition(parts, "part")
    chains = staged(chains.mapInArrow(_chains, "a long, b long"), "ngram_chains")
    wanted = entries.select("short").unionAll(chains.select("a")).unionAll(chains.select("b"))
    bits = spark.sparkContext.broadcast(sieve(wanted, "short"))
    sketches = texts.mapInArrow(_sketches(shingle, percent, bits), "short long, node long, n long, level int, cells binary")
    sketches = staged(sketches.dropDuplicates(["node"]), "ngram_sketches")  # read for the groups and for the chains
    both = entries.join(sketches, "short").select("met", "short", "n", "cells")
    near = both.repartition(parts, "met").sortWithinPartitions("met").mapInArrow(_possible(percent), "a long, b long")
    if not chains.isEmpty():
        near = near.unionByName(_sifted(chains, sketches, percent, parts))
    candidate = components(near, "ngram_near").withColumnRenamed("node", "short")
    bits = spark.sparkContext.broadcast(sieve(candidate, "short"))
    size = ids.groupBy("node").agg(F.max("n_shingles").alias("n"))
    size = size.withColumn("short", F.col("node").bitwiseAND(F.lit(_SHORT)))
    member = candidate.join(size, "short")
    load = member.groupBy("root").agg(
        F.ceil(F.greatest(F.count("n") / BLOCK_SETS, F.sum("n") / BLOCK_TOKENS)).cast("int").alias("salts")
    )
    salted = member.join(load, "root").select(
        "node", "root", "salts", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt")
    )
    sets = texts.mapInArrow(_candidates(shingle, bits), "node long, tokens binary")
    shipped = (
        sets.join(salted, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .select(
            "root", F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"),
            "salt", "node", "tokens",
        )
    )
    edges = (
        shipped.repartition(parts, "root", "i", "j")
        .sortWithinPartitions("root", "i", "j")
        .mapInArrow(_blocks(percent), "a long, b long")
    )
    linked = components(edges, "ngram_links")
    first = (
        ids.filter("n_shingles > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first"))
        .join(linked, "node", "left")
        .select("node", "first", F.coalesce("root", "node").alias("root"))
    )
    smallest = first.groupBy("root").agg(F.min("first").alias("component_id"))
    named = first.join(smallest, "root").select("node", "component_id")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return ids.join(named, "node", "left").select("doc_id", "text_key", "n_shingles", own.alias("component_id"))


def group_leaders(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE) -> DataFrame:
    """The rows of `docs` that stay when one document of each component is kept.

    The document of the smallest id stays, once where its row is repeated; documents
    without words are in no group and stay, once for each id.  All columns are kept.
    """
    found = _grouped(docs, percent, shingle)
    leads = (F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = staged(
        found.filter(leads).groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.count("text_key").alias("__rows")),
        "ngram_leaders",
    )
    key = F.xxhash64(docs["text"].cast("string"))
    joined = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (key == F.col("__key")))
    once = joined.filter("__rows = 1").select(*[docs[c] for c in docs.columns])
    again = joined.filter("__rows > 1").select(*[docs[c] for c in docs.columns])
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]))
