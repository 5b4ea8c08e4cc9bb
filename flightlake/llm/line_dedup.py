"""Line deduplication with a segment-partition edit join.

Lines are what `\\n` separates.  Two lines link when their edit distance is at most one for
every CHARS_PER_EDIT code points of the shorter line, and at most EDITS; lines of white space
alone never do.  Of every class of lines linked, directly or through others, the first
occurrence by (doc_id, text digest, line number) stays and the others go.

1. A line is cut into one segment more than the edits its length allows.  If two lines link,
   a whole segment of the not longer one stands in the other, near its own place; the
   substrings that can be it follow from both lengths (left and right shift limits).
   Segments and substrings meet by hash, each with a sketch of its line's characters that
   rules most wrong pairs out at once.
2. Texts of the remaining pairs are fetched, and each pair is verified by an automaton of
   edit states, one bit per diagonal of the band, for all pairs of a batch at once.
3. Components of the links are the classes.

Nothing is capped: within a segment all pairs are tried against the sketch in the task that
holds it, and only pairs that pass leave it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.graph import components, passes, sieve
from flightlake.llm.words import blocks, bucket_of, bytes_of, mix
from flightlake.session import staged

EDITS = 2
CHARS_PER_EDIT = 12
_SHORT = (1 << 40) - 1
_FLUSH = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_POINTS = 0x110000
_BLANK = np.zeros(_POINTS, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


class _Lines:
    """Lines of a block of texts as code points, with hashes of any of their parts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        text = data.tobytes().decode("utf-8", "replace")
        self.points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        rows = lead[offsets]
        breaks = np.flatnonzero(self.points == 10)
        of_break = np.searchsorted(rows, breaks, "right") - 1
        n = len(rows) - 1
        self.count = np.bincount(of_break, minlength=n) + 1
        self.start = np.sort(np.concatenate([rows[:-1], breaks + 1]), kind="stable")
        first = np.cumsum(self.count) - self.count
        self.row = np.repeat(np.arange(n), self.count)
        self.number = np.arange(len(self.row)) - first[self.row]
        last = self.number == self.count[self.row] - 1
        self.end = np.empty_like(self.start)
        self.end[~last] = self.start[np.flatnonzero(~last) + 1] - 1
        self.end[last] = rows[1:][self.row[last]]
        solid = np.concatenate([[0], np.cumsum(~_BLANK[self.points])])
        self.blank = solid[self.end] == solid[self.start]
        value = mix(self.points.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        power, self.inverse = _powers(len(self.points) + 1)
        self.total = np.zeros(len(self.points) + 1, np.uint64)
        np.cumsum(value * power[: len(self.points)], out=self.total[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.inverse[start] + (end - start).astype(np.uint64))


_kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(n, 1 << 19)
    if size not in _kept:
        _kept.clear()
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _kept[size] = (both[0], both[1])
    return _kept[size]


def _line_blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, _Lines]]:
    data, offsets = bytes_of(batch.column("text"))
    for first, last in blocks(offsets):
        yield first, _Lines(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])


def _segments(length: np.ndarray, i: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment i (from 0); the last segments are one longer where it is uneven."""
    parts = edits + 1
    base, extra = length // parts, length % parts
    longer = np.maximum(i - (parts - extra), 0)
    return base * i + longer, base + (i >= parts - extra)


def allowed(length: np.ndarray, edits: int, per: int) -> np.ndarray:
    """Edits that a pair may differ by whose shorter line has this length."""
    return np.clip(length // per, 0, edits)


def segment_entries(lines: _Lines, take: np.ndarray, edits: int, per: int):
    """(line, key, is_segment) for the segments and the probed substrings of the lines `take`."""
    length = lines.end[take] - lines.start[take]
    for shorter in range(edits + 1):
        may = allowed(length - shorter, edits, per)
        for most in range(max(shorter, 1), edits + 1):
            some = np.flatnonzero(may == most)
            start, whole = lines.start[take[some]], length[some]
            target = whole - shorter
            for i in range(most + 1):
                at, size = _segments(target, i, most)
                low = max(-i, shorter - (most - i))
                high = min(i, shorter + (most - i))
                for shift in range(low, high + 1):
                    own = shorter == 0 and shift == 0
                    begin = start + at + shift
                    fits = (at + shift >= 0) & (at + shift + size <= whole) & (size > 0)
                    salt = mix((target * 64 + i).astype(np.uint64))
                    key = mix(lines.hash(begin[fits], (begin + size)[fits]) ^ salt[fits])
                    yield take[some[fits]], key, own


def _sketches(lines: _Lines, take: np.ndarray) -> np.ndarray:
    """16 counters of 4 bits per line: code points by hash, modulo 16."""
    size = lines.end[take] - lines.start[take]
    at = np.repeat(lines.start[take] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    cell = (mix(lines.points[at].astype(np.uint64)) >> np.uint64(40)).astype(np.int64) & 15
    counts = np.bincount(np.repeat(np.arange(len(take)), size) * 16 + cell, minlength=len(take) * 16) & 15
    counts = counts.reshape(-1, 8, 2).astype(np.uint8)
    return np.ascontiguousarray(counts[:, :, 0] | (counts[:, :, 1] << 4)).view(np.uint64).ravel()


def _close(a: np.ndarray, b: np.ndarray, edits: int) -> np.ndarray:
    """Sketches that a distance of `edits` allows: an edit moves two counters by one at most."""
    x, y = (s.view(np.uint8).reshape(-1, 8) for s in (a, b))
    d = np.concatenate([(x & 15) - (y & 15), (x >> 4) - (y >> 4)], axis=1) & 15
    return np.minimum(d, 16 - d).sum(1) <= 2 * edits


def _packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpacked(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(x, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view(np.int64)


def _index(edits: int, per: int, buckets: int):
    """Segments and substrings of the distinct lines of a task, packed by bucket."""

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        rows = []
        for own in (True, False):
            key, node, sketch = (np.concatenate(x) for x in zip(*[h[:3] for h in held if h[3] == own]))
            bucket = bucket_of(key, buckets)
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                if len(part):
                    rows.append((int(bucket[part[0]]), own, _packed(key[part]), _packed(node[part]), sketch[part].tobytes()))
        kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=["bucket", "own", "keys", "nodes", "sketches"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, count = [], 0
        for batch in batches:
            for _, lines in _line_blocks(batch):
                able = np.flatnonzero((lines.end - lines.start >= per) & ~lines.blank)
                nodes = lines.hash(lines.start, lines.end).view(np.int64)
                new = []
                for i, node in zip(able.tolist(), nodes[able].tolist()):
                    if node not in seen:
                        seen.add(node)
                        new.append(i)
                if not new:
                    continue
                take = np.array(new)
                sketch = np.zeros(len(nodes), np.uint64)
                sketch[take] = _sketches(lines, take)
                for who, key, own in segment_entries(lines, take, edits, per):
                    held.append((key, nodes[who] & _SHORT, sketch[who], own))
                    count += len(who)
                if count > _FLUSH:
                    yield from flush(held)
                    held, count = [], 0
        if held:
            yield from flush(held)

    return run


def _pairs(edits: int):
    """Pairs of lines of which one has the segment and the other holds it, sketches allowing."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for own, key, node, sketch in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                key = _unpacked(key)
                held.append((key, _unpacked(node), np.frombuffer(sketch, np.uint64), np.full(len(key), own)))
        if not held:
            return
        key, node, sketch, own = (np.concatenate(x) for x in zip(*held))
        del held
        order = np.lexsort((node, key))
        key, node, sketch, own = key[order], node[order], sketch[order], own[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        width = np.diff(np.append(start, len(key)))
        useful = (np.add.reduceat(own, start) > 0) & (width > 1)
        start, width = start[useful], width[useful]
        found, step = [], 1
        while len(start):
            count = width - step
            at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())
            ok = (own[at] | own[at + step]) & (node[at] != node[at + step])
            at = at[ok]
            at = at[_close(sketch[at], sketch[at + step], edits)]
            found.append(np.unique(np.stack([node[at], node[at + step]]), axis=1))
            step += 1
            start, width = start[width > step], width[width > step]
        if found:
            pairs = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return run


def _texts(per: int, bits):
    """(short, node, line) of the lines that pass the sieve, once a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            out = []
            for _, lines in _line_blocks(batch):
                nodes = lines.hash(lines.start, lines.end).view(np.int64)
                able = (lines.end - lines.start >= per) & ~lines.blank
                for i in np.flatnonzero(able & passes(bits.value, nodes & _SHORT)):
                    if (node := int(nodes[i])) not in seen:
                        seen.add(node)
                        line = lines.points[lines.start[i] : lines.end[i]]
                        out.append((node & _SHORT, node, line.tobytes().decode("utf-32-le", "surrogatepass")))
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=["short", "node", "line"]
            )

    return run


def within(first: list[str], second: list[str], most: int | np.ndarray) -> np.ndarray:
    """Which pairs of lines have an edit distance of at most `most`, one bound for all or one for each pair.

    State e holds a bit for each diagonal of the band that e edits can reach.  A step
    over a character of the second line keeps a diagonal where the first has the same
    character, and takes it over from state e - 1 by substitution (same diagonal),
    insertion (one down) or deletion (one up).
    """
    n = len(first)
    a, b = (np.array([len(t) for t in side], np.int64) for side in (first, second))
    limit = np.broadcast_to(most, n)
    edits = int(limit.max(initial=0))
    ok = np.abs(a - b) <= edits
    width = int(max(a.max(initial=0), b.max(initial=0))) + 2 * edits + 1

    def table(side: list[str], before: int, fill: int) -> np.ndarray:
        out = np.full((n, width), fill, np.uint32)
        for i, text in enumerate(side):
            out[i, before : before + len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.ascontiguousarray(out.T)

    left, right = table(first, edits, 0xFFFFFFFF), table(second, 0, 0xFFFFFFFE)
    mask = np.uint16((1 << (2 * edits + 1)) - 1)
    state = [np.full(n, 1 << edits, np.uint16)]
    for _ in range(edits):
        state.append(state[-1] | ((state[-1] << 1) & mask))
    for j in range(int(b.max(initial=0))):
        same = np.zeros(n, np.uint16)
        for d in range(2 * edits + 1):
            same |= (left[j + d] == right[j]).astype(np.uint16) << np.uint16(d)
        new = []
        for e, old in enumerate(state):
            step = old & same
            if e:
                step |= state[e - 1] | (state[e - 1] >> 1) | ((new[-1] << 1) & mask)
            new.append(step)
        live = j < b  # a line that has ended keeps its states
        state = [np.where(live, x, y) for x, y in zip(new, state)]
    end = np.clip(a - b + edits, 0, 2 * edits).astype(np.uint16)
    return ok & ((np.stack(state)[limit, np.arange(n)] >> end) & 1 == 1)


def _verified(edits: int, per: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            for at in range(0, rows, 2000):
                part = batch.slice(at, 2000)
                x, y = part.column("line").to_pylist(), part.column("other_line").to_pylist()
                order = sorted(range(len(x)), key=lambda i: len(x[i]))
                keep = []
                for low in range(0, len(order), 250):  # pairs of like length side by side
                    some = order[low : low + 250]
                    most = allowed(np.array([min(len(x[i]), len(y[i])) for i in some]), edits, per)
                    keep += np.array(some)[within([x[i] for i in some], [y[i] for i in some], most)].tolist()
                yield part.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, doc_id, text_key, line) of every line that is not blank."""
    for batch in batches:
        for first, lines in _line_blocks(batch):
            some = np.flatnonzero(~lines.blank)
            rows = pa.array(lines.row[some] + first)
            node = lines.hash(lines.start[some], lines.end[some]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), batch.column("doc_id").take(rows), batch.column("text_key").take(rows),
                 pa.array(lines.number[some].astype(np.int32))], names=["node", "doc_id", "text_key", "line"])


def line_classes(docs: DataFrame, edits: int = EDITS, per: int = CHARS_PER_EDIT) -> DataFrame:
    """(node, root) of every line that is linked with a different one."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("text").cast("string"))
    entries = texts.mapInArrow(
        _index(edits, per, 8 * parts), "bucket int, own boolean, keys binary, nodes binary, sketches binary"
    )
    pairs = staged(
        entries.repartition(parts, "bucket").mapInArrow(_pairs(edits), "a long, b long").distinct(), "line_pairs"
    )
    bits = spark.sparkContext.broadcast(sieve(pairs.select(F.explode(F.array("a", "b")).alias("short")), "short"))
    lines = texts.mapInArrow(_texts(per, bits), "short long, node long, line string")
    lines = staged(lines.dropDuplicates(["node"]), "line_texts")
    left = lines.select(F.col("short").alias("a_short"), F.col("node").alias("a"), "line")
    right = lines.select(F.col("short").alias("b_short"), F.col("node").alias("b"), F.col("line").alias("other_line"))
    shorts = pairs.select(F.col("a").alias("a_short"), F.col("b").alias("b_short"))
    both = shorts.join(left, "a_short").join(right, "b_short").select("a", "b", "line", "other_line")
    return components(both.mapInArrow(_verified(edits, per), "a long, b long"), "line_links")


def removed_lines(docs: DataFrame, edits: int = EDITS, per: int = CHARS_PER_EDIT) -> DataFrame:
    """(doc_id, text_key, removed): sorted line numbers to remove, for texts that lose any."""
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = keyed.withColumn("text_key", F.xxhash64("text"))
    at = staged(keyed.mapInArrow(_occurrences, "node long, doc_id long, text_key long, line int"), "line_places")
    place = F.struct("doc_id", "text_key", "line")
    first = at.groupBy("node").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    joined = first.join(line_classes(docs, edits, per), "node", "left").select(
        "node", "first", "last", F.coalesce("root", "node").alias("root"), F.col("root").isNotNull().alias("linked")
    )
    keeper = joined.groupBy("root").agg(F.min("first").alias("keeper"))
    # lines that occur once and are linked with none lose nothing
    several = staged(
        joined.filter("linked OR first != last").join(keeper, "root").select("node", "keeper"), "line_keepers"
    )
    out = at.join(several, "node").filter(place != F.col("keeper"))
    return out.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def deduplicated(docs: DataFrame, edits: int = EDITS, per: int = CHARS_PER_EDIT, counts: bool = True) -> DataFrame:
    """`docs` with `text` less the lines that repeat an earlier one.

    With `counts`, `n_lines` and `n_removed` are added, in place of columns of those names.
    Every row comes out once with its other columns.  Null text stays null and has no
    lines; a text may become empty.  Rows of equal id and text count as one document,
    so they keep the same lines; a null id comes before all others.  An empty table gives
    an empty result.
    """
    gone = removed_lines(docs, edits, per).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("removed").alias("__removed")
    )
    text = docs["text"].cast("string")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__key"))
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.col("__removed"), i))
    new = F.when(F.col("__removed").isNull(), text).otherwise(F.array_join(kept, "\n"))
    added = {
        "n_lines": F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_removed": F.greatest(F.size("__removed"), F.lit(0)).cast("long"),
    }
    own = [new.alias("text") if c == "text" else docs[c] for c in docs.columns if not (counts and c in added)]
    extra = [c.alias(name) for name, c in added.items()] if counts else []
    return docs.join(gone, same, "left").select(*own, *extra)
