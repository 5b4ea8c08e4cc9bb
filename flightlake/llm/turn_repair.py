"""Repair of damaged conversations by the cheapest edits, with a square-root checkpointed search.

A repaired conversation's role initials are `(s?(ua)+)?`.  Edits of a row: Keep 0, Rerole to
user or assistant 1, Delete 2; an Insert of an empty turn costs 5, a truncated row that is not
deleted 5 more.  Blank and repeated rows must go.  Of the cheapest edit strings the least in
ASCII order is taken.

The search runs backwards over a conversation's rows, a byte each, with the cost of the rest for
four states (nothing yet, after s, after u, after a).  It stores that vector only at every
sqrt(n)-th row; walking forward it recomputes one stretch at a time and takes the least edit that
is tight, so memory is n bytes and some sqrt(n) vectors.  Two passes deal rows by conversation:
the first carries digests instead of texts and finds the edits, the second streams the texts past
them.  A conversation of any length is read as a stream by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.session import staged

# states: 0 nothing yet, 1 after s, 2 after u, 3 after a
_NEXT = (2, 2, 3, 2)
_INSERT, _DELETE, _REROLE, _CUT = 5, 2, 1, 5
_WANTED = ("user", "user", "assistant", "user")
_AFTER = {"s": 1, "u": 2, "a": 3}
_SPACE = " \t\n\x0b\x0c\r"
#: a row's byte: initial (s, u, a, other) plus 4 when it must go, plus 8 when it is truncated
_GONE, _TRUNCATED = 4, 8
_FLUSH_ROWS, _FLUSH_BYTES = 4096, 4 << 20
_ORDER = ["turn", "role", "digest"]


def _kept(code: int, state: int) -> int | None:
    """State after keeping a row, None where that is no repair."""
    after = (code & 3) + 1
    ok = after == 2 and state != 2 or after == 3 and state == 2 or after == 1 and state == 0
    return after if ok else None


_KEEP = [[_kept(code, state) for state in range(4)] for code in range(12)]


def _step(code: int, rest: tuple[int, ...]) -> tuple[int, ...]:
    """Costs from a row on, given those from the next row on."""
    base = []
    more = _CUT if code >= _TRUNCATED else 0
    for state in range(4):
        best = _DELETE + rest[state]
        if not code & _GONE:
            best = min(best, more + _REROLE + rest[_NEXT[state]])
            if (after := _KEEP[code][state]) is not None:
                best = min(best, more + rest[after])
        base.append(best)
    return _with_inserts(base)


def _with_inserts(base: list[int]) -> tuple[int, ...]:
    u, a = min(base[2], _INSERT + base[3]), min(base[3], _INSERT + base[2])
    return min(base[0], _INSERT + u), min(base[1], _INSERT + u), u, a


_END = (0, 2 * _INSERT, _INSERT, 0)


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and the ASCII-least string of the cheapest edits of rows given as bytes."""
    n = len(codes)
    size = isqrt(n) + 1
    saved = {n: _END}
    rest = _END
    for i in range(n - 1, -1, -1):
        rest = _step(codes[i], rest)
        if i % size == 0:
            saved[i] = rest
    cost, state, audit = rest[0], 0, []
    for start in range(0, n, size):
        stop = min(start + size, n)
        costs = [saved[stop]]
        for i in range(stop - 1, start - 1, -1):
            costs.append(_step(codes[i], costs[-1]))
        costs.reverse()
        for i in range(start, stop):
            here, after, code = costs[i - start], costs[i - start + 1], codes[i]
            more = _CUT if code >= _TRUNCATED else 0
            while True:
                if _DELETE + after[state] == here[state]:
                    audit.append("D")
                elif _INSERT + here[_NEXT[state]] == here[state]:
                    audit.append("I")
                    state = _NEXT[state]
                    continue
                elif (to := _KEEP[code][state]) is not None and more + after[to] == here[state]:
                    audit.append("K")
                    state = to
                else:
                    audit.append("R")
                    state = _NEXT[state]
                break
    while _END[state]:
        audit.append("I")
        state = _NEXT[state]
    return cost, "".join(audit)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by crc32(`conv_id:turn`) % 20.

    0 drops the row (copies 0), 1 empties its text, 2 removes its `[.!?]`, 3 repeats it
    (copies 2), 4 sets role user.  Nulls count as one space.
    """
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(conv.cast("string"), space), F.coalesce(turn.cast("string"), space))
    kind = F.crc32(name) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    return conversations.select(
        conv.alias("conv_id"), turn.alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _repeated() -> Column:
    return F.explode(F.when(F.col("copies") == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")


class _Findings:
    """What the stream of one conversation's rows has shown so far."""

    def __init__(self, conv: int | None):
        self.conv, self.codes = conv, bytearray()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = self.turn = None
        self.turns, self.before = 0, None

    def add(self, turn: int | None, initial: str, fault: str | None) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += turn != self.turn
            self.turn = turn
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.before = initial
        gone = _GONE if fault in ("blank", "duplicate") else 0
        self.codes.append(_AFTER.get(initial, 4) - 1 + gone + (_TRUNCATED if fault == "truncated" else 0))

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts.values(), *cheapest_edits(bytes(self.codes)))


_AUDIT = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string())]
)
_AUDIT_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or "")
        if len(held) >= _FLUSH_ROWS or size >= _FLUSH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _audited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def conversations() -> Iterator[tuple]:
        found = None
        for conv, turn, initial, fault, copies in _rows(batches):
            if found is None or found.conv != conv:
                if found is not None:
                    yield found.row()
                found = _Findings(conv)
            if copies:
                found.add(turn, initial, fault)
        if found is not None:
            yield found.row()

    yield from _batches(conversations(), _AUDIT)


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation of `damaged` rows."""
    last = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    narrow = (
        rows.select(
            "conv_id", "turn", "role", F.md5("text").alias("digest"), "copies",
            (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"), _repeated(),
        )
        .repartition("conv_id")
        .withColumn("seen", F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.desc(F.col("copies") > 0), "turn")))
    )
    fault = F.when(F.col("blank"), "blank").when(F.col("seen") > 1, "duplicate").when(F.col("cut"), "truncated")
    ordered = narrow.select("conv_id", *_ORDER, "copies", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    ordered = ordered.sortWithinPartitions("conv_id", *_ORDER).select("conv_id", "turn", "initial", "fault", "copies")
    return ordered.mapInArrow(_audited, _AUDIT_DDL)


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, new, edit, role, text) in order; a conversation's first event has edit None.

    Rows come sorted by conversation, its edits (kind 0) first.
    """
    edits, state, conv = iter(()), 0, None

    def inserted() -> Iterator[tuple]:
        """Inserts up to the next edit of a row, which is left in `edit`."""
        nonlocal state, edit
        for edit in edits:
            if edit != "I":
                return
            yield conv, "I", _WANTED[state], ""
            state = _NEXT[state]
        edit = None

    edit = None
    for this, kind, role, text in _rows(batches):
        if kind == 0:
            yield from inserted()  # what the last conversation has at its end
            conv, state, edits = this, 0, iter(text)
            yield conv, None, None, None
            continue
        yield from inserted()
        if edit == "K":
            state = _AFTER[role[0]]
            yield conv, edit, role, text
        elif edit == "R":
            yield conv, edit, _WANTED[state], text
            state = _NEXT[state]
    yield from inserted()


_TURNS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _as_turns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def turns() -> Iterator[tuple]:
        place = 0
        for conv, edit, role, text in _repaired(batches):
            place = 0 if edit is None else place + 1
            if edit is not None:
                yield conv, place, edit, role, text

    yield from _batches(turns(), _TURNS)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _as_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digests() -> Iterator[tuple]:
        sha, conv, some = None, None, False
        for this, edit, role, text in _repaired(batches):
            if edit is None:
                if sha is not None:
                    yield conv, sha.hexdigest()
                sha, conv, some = hashlib.sha256(), this, False
                continue
            sha.update((("\n" if some else "") + role + ":" + text).encode())
            some = True
        if sha is not None:
            yield conv, sha.hexdigest()

    yield from _batches(digests(), _DIGEST)


def _with_texts(rows: DataFrame, found: DataFrame, walk: Callable, ddl: str) -> DataFrame:
    """The edits of `found` walked along the texts of the damaged rows."""
    texts = rows.filter("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("digest"), "text", _repeated())
    edits = found.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("digest"), F.col("audit").alias("text"), F.lit(0).alias("copy"),
    )
    stream = texts.unionByName(edits).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER)
    return stream.select("conv_id", "kind", "role", "text").mapInArrow(walk, ddl)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of every repaired conversation, from place 1.

    `conversations` has conv_id, turn, role and text and is damaged first, see `damaged`.  A null
    conv_id names a conversation of its own.  Rows go by turn, nulls first, then role and text
    digest; a conversation without rows has none here.  Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = damaged(conversations)
    return _with_texts(rows, audits(rows), _as_turns, "conv_id long, place long, edit string, role string, text string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Handling as in `repaired_turns`.  repaired_sha256 is the digest of the repaired `role:text`
    lines; a conversation all of whose rows were dropped has zeros, an empty audit and the
    digest of the empty string.
    """
    rows = damaged(conversations)
    found = staged(audits(rows), "turn_repair")
    digests = _with_texts(rows, found, _as_digests, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "id")
    return found.join(digests, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
