"""Prefix trie of conversations, built from burst tries over ranges of their turn sequences.

1. A turn is 128 hash bits of (role, text) and its length; a conversation is the array of its
   turns.  Equal arrays are one sequence from here on, with its smallest conversation, the number
   of conversations and the digest of their ids.  Ids are streamed in order, never collected.
2. Sequences are dealt by ranges of the array, so a prefix that a third of all conversations share
   is spread over many shards.  A shard puts them into a burst trie: heads hold containers of
   suffixes, a container of more than CONTAINER suffixes bursts into a head by the next turn id.
   What remains is sorted and swept into nodes.
3. Only the nodes on the paths of a shard's least and greatest sequence can stand in another shard
   too.  They are merged by the digest of their prefix; every other node is final in its shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.session import staged

CONTAINER = 64
HEAD_TURNS = 6
_TURN = "array<struct<x:bigint,y:bigint,n:int>>"
_PIECE_BYTES = 1 << 20
_EMPTY = hashlib.sha256(b"").hexdigest()


def _turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of every conversation in order, nulls as empty strings."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.xxhash64(role, text).alias("x"),
            F.xxhash64(F.lit("turn"), text, role).alias("y"),
            F.length(text).alias("n"),
        ).alias("t"),
    )
    ordered = F.sort_array(F.collect_list("t"))  # structs with a null turn come first, equal turns go by their hashes
    return rows.groupBy("conv_id").agg(ordered.alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["x"].alias("x"), t["y"].alias("y"), t["n"].alias("n"))).alias("turns")
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): first h turns of conversation c - c % 100, then c's own after its first h.

    h = crc32(decimal c) % 6.  The heads are one conversation in a hundred, five turns each.
    """
    own = _turns_of(conversations)
    c, h = F.col("conv_id"), (F.crc32(F.col("conv_id").cast("string")) % HEAD_TURNS).cast("int")
    heads = own.filter(c % 100 == 0).select(c.alias("base"), F.slice("turns", 1, HEAD_TURNS - 1).alias("head"))
    both = own.withColumn("h", h).join(heads, c - c % 100 == F.col("base"), "left")
    first = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(_TURN))
    return both.select("conv_id", F.concat(first, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one key in (key, conv_id) order as pieces of comma-joined ids."""
    x = y = None
    ids: list[int] = []
    size = 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x]), pa.array([y]), pa.array([ids[0]], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([",".join(map(str, ids))])],
            names=["x", "y", "conv_id", "n", "ids"],
        )

    for batch in batches:
        for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (a != x or b != y or size > _PIECE_BYTES):
                yield piece()
                ids, size = [], 0
            x, y = a, b
            ids.append(conv)
            size += len(str(conv)) + 1
    if ids:
        yield piece()


def _ended(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest id, number and digest of the ids of every key, from its pieces in order."""
    key, sha, first, n, out = None, None, None, 0, []

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(out, pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())]))
        out.clear()
        return batch

    for batch in batches:
        for x, y, conv, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (x, y):
                if key is not None:
                    out.append({"conv_id": first, "n": n, "ends": sha.hexdigest()})
                key, sha, first, n = (x, y), hashlib.sha256(ids.encode()), conv, count
            else:
                sha.update(b"," + ids.encode())
                n += count
        if len(out) >= 4096:
            yield flush()
    if key is not None:
        out.append({"conv_id": first, "n": n, "ends": sha.hexdigest()})
    if out:
        yield flush()


def sequences(conversations: DataFrame) -> DataFrame:
    """(turns, conv_id, n, ends): distinct rebuilt sequences, smallest id, conversations, digest of their ids."""
    whole = staged(rebuilt(conversations), "trie_turns")
    keyed = whole.select(F.xxhash64("turns").alias("x"), F.xxhash64(F.lit("ends"), "turns").alias("y"), "conv_id")
    parts = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = keyed.repartitionByRange(parts, "x", "y", "conv_id").sortWithinPartitions("x", "y", "conv_id")
    pieces = line.mapInArrow(_pieces, "x long, y long, conv_id long, n long, ids string")
    ended = (
        pieces.repartition("x", "y")
        .sortWithinPartitions("x", "y", "conv_id")
        .mapInArrow(_ended, "conv_id long, n long, ends string")
    )
    return ended.join(whole, "conv_id").select("turns", "conv_id", "n", "ends")


class _Node:
    """A trie node; from `n` on its fields cover the whole subtree once it is closed.

    Bit i of `on` says that the node lies on path i of the trie.
    """

    __slots__ = ("depth", "size", "on", "parent", "ends", "conv", "n", "children", "leaves", "lengths", "weight")

    def __init__(self, depth: int, size: int, on: int, parent: _Node | None):
        self.depth, self.size, self.on, self.parent = depth, size, on, parent
        self.conv = self.ends = None
        self.n = self.children = self.leaves = self.lengths = self.weight = 0

    def member(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.n += n

    def close(self) -> None:
        """Adds what the children have summed up to the parent's sums; called once, children first.

        lengths sums the last texts of the subtree's nodes, weight those times their members.
        """
        self.leaves += not self.children
        self.lengths += self.size
        self.weight += self.size * self.n
        if (up := self.parent) is not None:
            up.member(self.conv, self.n)
            up.children += 1
            up.leaves += self.leaves
            up.lengths += self.lengths
            up.weight += self.weight


class BurstTrie:
    """Heads by turn id over containers of suffixes; sequences are tuples of turn numbers."""

    def __init__(self, sizes: list[int], paths: tuple[tuple[int, ...], ...] = (), limit: int = CONTAINER):
        self.sizes, self.paths, self.limit = sizes, paths, limit
        self.root: dict = {}

    def _child(self, parent: _Node, turn: int) -> _Node:
        at, on = parent.depth, 0
        for i, path in enumerate(self.paths):
            if parent.on >> i & 1 and at < len(path) and path[at] == turn:
                on |= 1 << i
        return _Node(at + 1, self.sizes[turn], on, parent)

    def insert(self, row: tuple[tuple[int, ...], int, int, str]) -> None:
        """A head maps a turn id to a head or a container; -1 to the row that ends there."""
        turns, head, depth = row[0], self.root, 0
        while True:
            if depth == len(turns):
                head[-1] = row
                return
            below = head.get(turns[depth])
            if isinstance(below, dict):
                head, depth = below, depth + 1
                continue
            if below is None:
                head[turns[depth]] = [row]
                return
            below.append(row)
            if len(below) > self.limit:
                self._burst(head, turns[depth], depth + 1)
            return

    def _burst(self, head: dict, turn: int, depth: int) -> None:
        while True:
            held, below = head[turn], {}
            head[turn] = below
            for row in held:
                if len(row[0]) == depth:
                    below[-1] = row
                else:
                    below.setdefault(row[0][depth], []).append(row)
            full = [t for t, part in below.items() if t >= 0 and len(part) > self.limit]
            if not full:  # at most one part is too full: the others share what it lacks
                return
            head, turn, depth = below, full[0], depth + 1

    def nodes(self) -> Iterator[_Node]:
        """All nodes, children before their parents."""
        root = _Node(0, 0, (1 << len(self.paths)) - 1, None)
        stack = [(root, iter(self._ordered(self.root, root)))]
        while stack:
            node, parts = stack[-1]
            for turn, part in parts:
                if isinstance(part, dict):
                    child = self._child(node, turn)
                    stack.append((child, iter(self._ordered(part, child))))
                    break
                yield from self._swept(node, part)
            else:
                node.close()
                yield node
                stack.pop()

    @staticmethod
    def _ordered(head: dict, node: _Node) -> list:
        if (row := head.pop(-1, None)) is not None:
            node.member(row[1], row[2])
            node.ends = row[3]
        return sorted(head.items(), key=lambda item: item[0])

    def _swept(self, top: _Node, held: list) -> Iterator[_Node]:
        """Nodes of a sorted container: the open path is cut back to what two neighbours share."""
        path: list[_Node] = []
        before: tuple[int, ...] = ()
        start = top.depth
        for turns, conv, n, ends in sorted(held, key=lambda row: row[0]):
            shared, most = start, min(len(before), len(turns))
            while shared < most and before[shared] == turns[shared]:
                shared += 1
            while len(path) > shared - start:
                node = path.pop()
                node.close()
                yield node
            for depth in range(start + len(path), len(turns)):
                path.append(self._child(path[-1] if path else top, turns[depth]))
            path[-1].member(conv, n)
            path[-1].ends = ends
            before = turns
        while path:
            node = path.pop()
            node.close()
            yield node


_FIELDS = (
    "shard int, edge boolean, key string, parent_key string, depth long, size long, conv_id long, parent_conv_id long,"
    "n long, children long, leaves long, lengths long, weight long, ends string"
)
_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("edge", pa.bool_()), ("key", pa.string()), ("parent_key", pa.string())]
    + [(c, pa.int64()) for c in ("depth", "size", "conv_id", "parent_conv_id", "n", "children", "leaves", "lengths", "weight")]
    + [("ends", pa.string())]
)


def _read(batches: Iterable[pa.RecordBatch]) -> tuple[list[tuple], list[int], np.ndarray]:
    """(sequences as turn numbers), lengths and hashes of the turns; numbers keep the order of turns."""
    hashes, ends, convs, counts, digests = [], [], [], [], []
    for batch in batches:
        lists = batch.column(0)
        flat = lists.flatten()
        hashes.append(np.stack([flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], 1))
        ends.append(np.diff(lists.offsets.to_numpy()))
        for held, column in zip((convs, counts, digests), batch.columns[1:]):
            held.extend(column.to_pylist())
    if not convs:
        return [], [], np.zeros((0, 3), np.int64)
    distinct, ids = np.unique(np.concatenate(hashes), axis=0, return_inverse=True)
    cuts = np.concatenate([[0], np.cumsum(np.concatenate(ends))]).tolist()
    flat = ids.ravel().tolist()
    rows = [(tuple(flat[a:b]), c, n, d) for a, b, c, n, d in zip(cuts, cuts[1:], convs, counts, digests)]
    return rows, distinct[:, 2].tolist(), distinct


def _chain(turns: tuple[int, ...], distinct: np.ndarray) -> list[str]:
    """Digest of every prefix of a sequence, the empty one first."""
    sha, keys = hashlib.sha256(), []
    keys.append(sha.hexdigest()[:32])
    for turn in turns:
        sha.update(distinct[turn].tobytes())
        keys.append(sha.copy().hexdigest()[:32])
    return keys


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one range of sequences; those on the paths of its ends carry their prefix's digest."""
    from pyspark import TaskContext

    rows, sizes, distinct = _read(batches)
    if not rows:
        return
    shard = TaskContext.get().partitionId()
    paths = min(row[0] for row in rows), max(row[0] for row in rows)
    keys = [_chain(path, distinct) for path in paths]
    trie = BurstTrie(sizes, paths)
    for row in rows:
        trie.insert(row)

    def key_of(node: _Node | None) -> str | None:
        return keys[0 if node.on & 1 else 1][node.depth] if node is not None and node.on else None

    def row_of(node: _Node) -> tuple:
        up = node.parent
        return (
            shard, node.on > 0, key_of(node), key_of(up), node.depth, node.size, node.conv, None if up is None else up.conv,
            node.n, node.children, node.leaves, node.lengths, node.weight, node.ends or _EMPTY,
        )

    out: list[tuple] = []
    waiting: dict[int, list[_Node]] = {}  # until their parent is closed and knows its smallest conversation
    for node in trie.nodes():
        out += [row_of(child) for child in waiting.pop(id(node), ())]
        if node.parent is None:
            out.append(row_of(node))
        else:
            waiting.setdefault(id(node.parent), []).append(node)
        if len(out) >= 4096:
            yield _batch(out, _SCHEMA)
            out = []
    yield _batch(out, _SCHEMA)


_EDGE = (
    "shard int, key string, parent_key string, depth long, conv_id long, n long, children long, leaves long, lengths long,"
    "weight long, ends string"
)


def _owned(edges: pa.Table) -> pa.Table:
    """A shard's edge nodes with what belongs to other shards taken out of their sums.

    A node counts where it stands first; one that only seems childless here is no leaf.
    """
    rows = sorted(edges.to_pylist(), key=lambda row: -row["depth"])
    less: dict[str, list[int]] = {row["key"]: [0, 0, 0] for row in rows}
    for row in rows:  # deepest first, so that all below a node has arrived
        away = row["shard"] > row["owner"]
        mine = less[row["key"]]
        mine[1] += row["children"] == 0 and row["most"] > 0
        mine[2] += row["size"] * away
        up = less.get(row["parent_key"])
        if up is not None:
            up[0] += away
            up[1] += mine[1]
            up[2] += mine[2]
    for row in rows:
        for column, part in zip(("children", "leaves", "lengths"), less[row["key"]]):
            row[column] -= part
    names = [field.split()[0] for field in _EDGE.split(",")]
    return edges.select(names).schema.empty_table() if not rows else pa.Table.from_pylist(rows, edges.select(names).schema)


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    `conversations` has conv_id, turn, role and text.  Columns: conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    Turns are ordered by number, nulls first, equal numbers by their content; null roles and texts
    are empty strings; rows without conv_id belong to no conversation.  A conversation without
    turns is a member of the root.  Other columns are ignored; an empty table has no nodes.
    A conversation's turns (20 bytes each) must fit into a task.
    """
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sequences(conversations).repartitionByRange(parts, "turns")
    nodes = staged(dealt.mapInArrow(_shard, _FIELDS), "trie_nodes")
    inner, edges = nodes.filter("NOT edge"), nodes.filter("edge")
    known = edges.groupBy("key").agg(F.min("shard").alias("owner"), F.max("children").alias("most"))
    owned = staged(edges.join(known, "key").groupBy("shard").applyInArrow(_owned, _EDGE), "trie_edges")
    merged = owned.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "lengths", "weight")],
        F.max(F.when(F.col("ends") != _EMPTY, F.col("ends"))).alias("ends"),
    )
    of_parent = merged.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"))
    shared = merged.join(of_parent, F.col("parent_key") == F.col("up"), "left").withColumn("parent_conv_id", F.col("up_conv"))
    # the parent of an inner node by (shard, key): no key has more rows than a shard
    in_shard = owned.select("shard", F.col("key").alias("up")).join(of_parent, "up").withColumnRenamed("shard", "up_shard")
    hanging = inner.filter("parent_key IS NOT NULL").join(
        in_shard, (F.col("shard") == F.col("up_shard")) & (F.col("parent_key") == F.col("up"))
    )
    hanging = hanging.withColumn("parent_conv_id", F.col("up_conv"))
    columns = [
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("weight") - F.col("lengths")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"),
    ]
    return inner.filter("parent_key IS NULL").select(*columns).unionByName(hanging.select(*columns)).unionByName(shared.select(*columns))
