"""Substring deduplication with suffix automata over reference shards.

A window of WINDOW words that also stands in a document of a smaller id is a repeat; words
covered by repeats go.

1. Anchors.  Of the GRAM-word runs inside each window the one with the smallest hash is its
   anchor, so equal windows have equal anchors; about one word in twenty starts one.  Only
   anchors meet, never windows.  With an anchor goes a digest of its surroundings: all
   words of the windows that hold it.
2. Where an anchor has equal surroundings in a smaller document, all its windows are
   repeats.  Where its surroundings differ between documents, the smallest document of each
   kind is a reference and goes to the anchor's shard with those words.
3. A shard builds a suffix automaton of its references, document by document in the order
   of their ids; each is streamed first against what stands there, and where the
   matching statistics reach WINDOW, the maximal spans are repeats.
4. An anchor with more than CROWD references would be one task's work.  Their windows that
   have it as their anchor are dealt by their own hash instead: the smallest document of
   each is found before the shuffle, and larger documents with it have a repeat.

The automata are not broadcast: the repeated text of a corpus has no size bound.  They are
built in the task of their shard, and the text that can match comes to them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.graph import passes, sieve
from flightlake.llm.words import _tables, blocks, bucket_of, bytes_of, grams, hash_spans, mix, word_spans
from flightlake.session import staged

WINDOW = 50
GRAM = 10
#: most references of one anchor that go to one automaton
CROWD = 64
_FLUSH = 1 << 18


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """pick over values[i : i + size] for every full run, by doubling."""
    width = 1
    while width * 2 <= size:
        values = pick(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def run_sums(words: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Sums over words[low:high] that depend on these words alone, not on where they stand."""
    power, inverse = _tables(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=total[1:])
    return (total[high] - total[low]) * inverse[low]


def anchors(words: np.ndarray, bounds: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Word numbers where an anchor starts, over rows bounded by `bounds`."""
    span = window - gram + 1
    n = len(words)
    if n < window:
        return np.zeros(0, np.int64)
    value = grams(words, gram) | np.uint64(1)
    least = _sliding(value, span, np.minimum)  # by first word of the window
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = row[: n - window + 1] == row[window - 1 :]
    least = np.where(inside, least, np.uint64(0))
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    return np.flatnonzero(_sliding(padded, span, np.maximum)[: len(value)] == value)


class _Texts:
    """Words of a block of texts, with text identities."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.bounds = word_spans(data, offsets)
        self.words = hash_spans(data, starts, ends)
        whole = hash_spans(data, offsets[:-1], offsets[1:])
        self.key = (mix(whole + np.diff(offsets).astype(np.uint64)) >> np.uint64(1)).view(np.int64)


def _text_blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, _Texts]]:
    data, offsets = bytes_of(batch.column("text"))
    for first, last in blocks(offsets):
        yield first, _Texts(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])


def _found(window: int, gram: int, buckets: int):
    """Anchors by bucket: hash, digest of the surroundings, id, text and place, packed."""
    names = ["bucket", "anchor", "around", "doc_id", "key", "place"]
    kinds = (pa.int32(), *[pa.binary()] * 5)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(x) for x in zip(*held)]
        bucket = bucket_of(columns[0], buckets)
        order = np.argsort(bucket, kind="stable")
        rows = [
            (int(bucket[p[0]]), *[c[p].tobytes() for c in columns])
            for p in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, t in _text_blocks(batch):
                at = anchors(t.words, t.bounds, window, gram)
                if not len(at):
                    continue
                row = np.searchsorted(t.bounds, at, "right") - 1
                low = np.maximum(at - (window - gram), t.bounds[row])
                high = np.minimum(at + window, t.bounds[row + 1])
                digest = mix(run_sums(t.words, low, high) + (at - low).astype(np.uint64))
                digest ^= mix((high - low).astype(np.uint64))
                value = grams(t.words, gram)[at]
                held.append((value, digest, ids[first + row].astype(np.int64), t.key[row], (at - t.bounds[row]).astype(np.int32)))
                count += len(at)
                if count > _FLUSH:
                    yield from flush(held)
                    held, count = [], 0
        if held:
            yield from flush(held)

    return run


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of several documents: those with equal surroundings in a smaller one, and references."""
    kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int32)
    held: list[list[np.ndarray]] = [[np.zeros(0, k)] for k in kinds]
    for batch in batches:
        for i, kind in enumerate(kinds):
            held[i] += [np.frombuffer(x, kind) for x in batch.column(i + 1).to_pylist()]
    anchor, around, doc, key, place = (np.concatenate(x) for x in held)
    del held
    if not len(anchor):
        return
    order = np.lexsort((doc, around, anchor))
    anchor, around, doc, key, place = (x[order] for x in (anchor, around, doc, key, place))
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    kind_new = new | np.concatenate([[True], around[1:] != around[:-1]])
    start = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    least, most = np.minimum.reduceat(doc, start), np.maximum.reduceat(doc, start)
    several = (least != most)[group]
    kind = np.cumsum(kind_new) - 1
    first_doc = doc[np.flatnonzero(kind_new)]  # sorted by id within its kind
    reference = doc == first_doc[kind]
    mixed = (np.bincount(group[kind_new], minlength=len(start)) > 1)[group]
    crowd = (np.bincount(group[reference], minlength=len(start)) > CROWD)[group]
    for repeat, some in ((True, several & ~reference), (False, several & reference & mixed)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(int(some.sum()), repeat)), pa.array(crowd[some]), pa.array(anchor[some].view(np.int64)),
             pa.array(doc[some]), pa.array(key[some]), pa.array(place[some])],
            names=["repeat", "crowd", "anchor", "doc_id", "key", "place"])


def _keyed(bits=None):
    """Texts with their identity; only those whose identity passes, where a sieve is given."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.zeros(0, np.int64)]
            data, offsets = bytes_of(batch.column("text"))
            for first, last in blocks(offsets):
                part, rows = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                whole = hash_spans(part, rows[:-1], rows[1:])
                keys.append((mix(whole + np.diff(rows).astype(np.uint64)) >> np.uint64(1)).view(np.int64))
            key = np.concatenate(keys)
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "key"])
            yield out if bits is None else out.filter(pa.array(passes(bits.value, key)))

    return run


def _regions(window: int, gram: int):
    """(anchor, doc_id, key, low, words) for the references of each text; 32 bits a word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(out: list) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)],
                names=["anchor", "doc_id", "key", "low", "words"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 200):  # a text has many regions
                part, out = batch.slice(at, 200), []
                ids, keys, wanted = (part.column(c).to_pylist() for c in ("doc_id", "key", "wanted"))
                for first, t in _text_blocks(part):
                    for r in range(len(t.bounds) - 1):
                        words = (t.words[t.bounds[r] : t.bounds[r + 1]] >> np.uint64(32)).astype(np.uint32)
                        for want in wanted[first + r]:
                            low = max(want["place"] - (window - gram), 0)
                            region = words[low : want["place"] + window].tobytes()
                            out.append((want["anchor"], ids[first + r], keys[first + r], low, region))
                yield rows(out)

    return run


def _windows(window: int, gram: int):
    """(anchor, window, doc_id, key, low) for each window of the references that has their anchor."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):  # a text has many windows
                part = batch.slice(at, 200)
                ids, keys, wanted = (part.column(c).to_pylist() for c in ("doc_id", "key", "wanted"))
                for first, t in _text_blocks(part):
                    if len(t.words) < window:
                        continue
                    value = grams(t.words, gram) | np.uint64(1)
                    least = _sliding(value, window - gram + 1, np.minimum)
                    for r in range(len(t.bounds) - 1):
                        if not wanted[first + r]:
                            continue
                        place = np.array([w["place"] for w in wanted[first + r]], np.int64) + t.bounds[r]
                        starts = place[:, None] - np.arange(window - gram, -1, -1)
                        inside = (starts >= t.bounds[r]) & (starts + window <= t.bounds[r + 1])
                        own = inside & (least[np.where(inside, starts, 0)] == value[place][:, None])
                        low = np.unique(starts[own])
                        anchor = least[low]
                        digest = mix(run_sums(t.words, low, low + window)) ^ mix(anchor)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64)),
                             pa.array(np.full(len(low), ids[first + r], np.int64)), pa.array(np.full(len(low), keys[first + r], np.int64)),
                             pa.array((low - t.bounds[r]).astype(np.int32))],
                            names=["anchor", "window", "doc_id", "key", "low"])

    return run


class SuffixAutomaton:
    """Automaton of all substrings of the word sequences added so far."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[int]) -> None:
        next_, link, length = self.next, self.link, self.length
        last = 0
        for w in words:
            old = next_[last].get(w)
            if old is not None:
                if length[old] == length[last] + 1:
                    last = old
                else:
                    last = self._split(last, old, w)
                continue
            state = len(next_)
            next_.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and w not in next_[p]:
                next_[p][w] = state
                p = link[p]
            if p != -1:
                q = next_[p][w]
                link[state] = q if length[q] == length[p] + 1 else self._split(p, q, w)
            last = state

    def _split(self, p: int, q: int, w: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def spans(self, words: list[int], least: int) -> list[tuple[int, int]]:
        """Maximal spans of words covered by matches of at least `least` words."""
        next_, link, length = self.next, self.link, self.length
        state = size = 0
        out: list[tuple[int, int]] = []
        for i, w in enumerate(words):
            while state and w not in next_[state]:
                state = link[state]
                size = length[state]
            to = next_[state].get(w)
            if to is None:
                continue
            state, size = to, size + 1
            if size >= least:
                low = i + 1 - size
                if out and low <= out[-1][1]:
                    out[-1] = (min(out[-1][0], low), i + 1)
                else:
                    out.append((low, i + 1))
        return out


def _matched(window: int):
    """Rows sorted by (anchor, doc_id): repeats (doc_id, key, low, high) of references."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = doc = None
        automaton, held = SuffixAutomaton(), []
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "doc_id", "key", "low", "words"))
            for a, d, key, low, raw in zip(*columns):
                if a != anchor:
                    anchor, doc, automaton, held = a, d, SuffixAutomaton(), []
                elif d != doc:
                    for words in held:
                        automaton.add(words)
                    doc, held = d, []
                words = np.frombuffer(raw, np.uint32).tolist()
                out += [(d, key, low + s, low + e) for s, e in automaton.spans(words, window)]
                held.append(words)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=["doc_id", "key", "low", "high"]
            )

    return run


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, n_removed, kept): words of each text outside its spans."""
    for batch in (b.slice(at, 250) for b in batches for at in range(0, b.num_rows, 250)):
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            gone = np.zeros(len(words), bool)
            for span in spans or ():
                gone[max(span["low"], 0) : span["high"]] = True
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if spans else words)
            kept.append(left.decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"])


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, key, low, high): word ranges of repeats; they may overlap."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id IS NOT NULL")
    packed = texts.mapInArrow(
        _found(window, gram, 8 * parts),
        "bucket int, anchor binary, around binary, doc_id binary, key binary, place binary",
    )
    shared = staged(
        packed.repartition(parts, "bucket").mapInArrow(
            _compared, "repeat boolean, crowd boolean, anchor long, doc_id long, key long, place int"
        ),
        "span_anchors",
    )
    found = shared.filter("repeat").select(
        "doc_id", "key", (F.col("place") - (window - gram)).alias("low"), (F.col("place") + window).alias("high")
    )
    regions = _referred(texts, shared.filter("NOT repeat AND NOT crowd")).mapInArrow(
        _regions(window, gram), "anchor long, doc_id long, key long, low int, words binary"
    )
    matched = (
        regions.repartition(parts, "anchor")
        .sortWithinPartitions("anchor", "doc_id")
        .mapInArrow(_matched(window), "doc_id long, key long, low int, high int")
    )
    found = found.unionByName(matched)
    crowds = shared.filter("NOT repeat AND crowd")
    return found if crowds.isEmpty() else found.unionByName(_crowded(texts, crowds, window, gram))


def _referred(texts: DataFrame, references: DataFrame) -> DataFrame:
    """Distinct texts with references, and those in `wanted`."""
    wanted = references.groupBy("doc_id", "key").agg(F.collect_list(F.struct("anchor", "place")).alias("wanted"))
    bits = texts.sparkSession.sparkContext.broadcast(sieve(references, "key"))
    needed = texts.mapInArrow(_keyed(bits), "doc_id long, text string, key long").dropDuplicates(["doc_id", "key"])
    return needed.join(wanted, ["doc_id", "key"])


def _crowded(texts: DataFrame, references: DataFrame, window: int, gram: int) -> DataFrame:
    """Repeats (doc_id, key, low, high) of anchors with too many references for one task.

    The windows are dealt by their own hash.  One that stands in very many documents is
    combined before the shuffle; only windows of several documents are joined back, where
    adaptive execution splits a large one, since both sides come from files.
    """
    windows = staged(
        _referred(texts, references).mapInArrow(_windows(window, gram), "anchor long, window long, doc_id long, key long, low int"),
        "span_windows",
    )
    first = staged(
        windows.groupBy("anchor", "window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .filter("least < most").drop("most"),
        "span_first",
    )
    return windows.join(first, ["anchor", "window"]).filter("doc_id > least").select(
        "doc_id", "key", "low", (F.col("low") + window).alias("high")
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of `docs` (doc_id, text).

    `kept` has the words that stay, joined by one space.  Null text has no words.  A null id
    is neither smaller nor larger than another: such rows lose nothing and are no reference.
    Repeated rows have one id, so they are no repeats of each other.  Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    spans = staged(
        repeated_spans(docs, window, gram).groupBy("doc_id", "key").agg(F.collect_set(F.struct("low", "high")).alias("spans")), "span_sets"
    )
    bits = spark.sparkContext.broadcast(sieve(spans, "key"))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = texts.mapInArrow(_split_by(bits), "doc_id long, text string, key long, hit boolean")
    clean = keyed.filter("NOT hit").select("doc_id", "text", F.lit(None).cast("array<struct<low:int,high:int>>").alias("spans"))
    hit = keyed.filter("hit").join(spans, ["doc_id", "key"], "left").select("doc_id", "text", "spans")
    return clean.unionByName(hit).mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")


def _split_by(bits):
    """Texts with their identity and whether it passes the sieve; only those are shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _keyed()(batches):
            hit = passes(bits.value, batch.column("key").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], names=["doc_id", "text", "key", "hit"])

    return run
