"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Training takes at most TRAIN_ROWS labelled documents (those with the smallest digest of
their id), so it is bounded work on the driver; it is the only bounded sample.  The trees
are complete and lie in flat arrays (feature, threshold, leaf), which a task walks for all
rows of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.words import blocks, bytes_of, hash_spans, shingle_sets, word_spans

TRAIN_ROWS = 20_000
KEEP_AT = 0.7
HELD_OUT_REMAINDER = 2
FEATURES = (
    "log_bytes", "log_words", "word_bytes", "words_per_line", "lower", "upper", "digit", "space", "stop",
    "symbol", "pipe", "bang", "high", "distinct_words", "distinct_triples", "no_letter", "ends_in_symbol",
)
_CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "pipe", "bang", "high")
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 4
_CLASS[ord("|")], _CLASS[ord("!")] = 6, 7
_CLASS[128:] = 8
_LETTER = (_CLASS == 0) | (_CLASS == 1) | (_CLASS == 8)


def text_statistics(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text, all finite; empty and null texts give zeros."""
    data, offsets = bytes_of(texts)
    out = [np.zeros((0, len(FEATURES)))]
    for first, last in blocks(offsets):
        part = data[offsets[first] : offsets[last]]
        rows = offsets[first : last + 1] - offsets[first]
        size = np.diff(rows)
        n = last - first
        row = np.repeat(np.arange(n), size)
        counts = np.bincount(row * len(_CLASSES) + _CLASS[part], minlength=n * len(_CLASSES)).reshape(n, -1)
        lines = np.bincount(row[part == 10], minlength=n) + 1
        starts, ends, bounds = word_spans(part, rows)
        words = np.diff(bounds)
        letters = np.concatenate([[0], np.cumsum(_LETTER[part])])
        of = np.repeat(np.arange(n), words)
        bare = np.bincount(of[letters[ends] == letters[starts]], minlength=n)
        final = np.bincount(of[np.isin(_CLASS[part[ends - 1]], (5, 6, 7))], minlength=n) if len(ends) else np.zeros(n)
        hashes = hash_spans(part, starts, ends)
        once = np.diff(shingle_sets(hashes, bounds, 1)[1])
        triples = np.diff(shingle_sets(hashes, bounds, 3)[1])
        some, any_word = np.maximum(size, 1), np.maximum(words, 1)
        out.append(
            np.column_stack(
                [np.log1p(size), np.log1p(words), (size - counts[:, 3]) / any_word, words / lines, counts / some[:, None],
                 once / any_word, triples / np.maximum(words - 2, 1), bare / any_word, final / any_word]
            )
        )
    return np.concatenate(out)


@dataclass
class Trees:
    """Complete trees of one depth; children of node i are 2 i + 1 and 2 i + 2."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2 ** depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        depth = self.leaf.shape[1].bit_length() - 1 if len(self.leaf) else 0
        every = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[every, feature[node]] > threshold[node])
            total += leaf[node - (2**depth - 1)]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    penalty: float = 1.0, least: float = 4.0,
) -> Trees:
    """Logistic boosting with Newton leaves; splits are searched on histograms of binned values."""
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Trees(base, np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 1)))
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    edges = np.full((d, bins), np.inf)
    for j, c in enumerate(cuts):
        edges[j, : len(c)] = c
    inner, leaves = 2**depth - 1, 2**depth
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    total = np.full(n, base)
    flat = binned + np.arange(d) * bins
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        grad, hess = y - p, p * (1 - p) + 1e-9
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width = 2**level
            at = ((node - (width - 1))[:, None] * (d * bins) + flat).ravel()
            g, h, c = (
                np.bincount(at, np.repeat(w, d), minlength=width * d * bins).reshape(width, d, bins)
                for w in (grad, hess, np.ones(n))
            )
            gl, hl, cl = g.cumsum(2), h.cumsum(2), c.cumsum(2)
            gt, ht, ct = gl[:, :1, -1:], hl[:, :1, -1:], cl[:, :1, -1:]
            gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
            gain[(cl < least) | (ct - cl < least) | ~np.isfinite(edges)[None]] = -1
            best = gain.reshape(width, -1).argmax(1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            spots = width - 1 + np.arange(width)
            feature[t, spots] = np.where(good, best // bins, 0)
            threshold[t, spots] = np.where(good, edges[best // bins, best % bins], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        spot = node - inner
        leaf[t] = rate * np.bincount(spot, grad, minlength=leaves) / (np.bincount(spot, hess, minlength=leaves) + penalty)
        total += leaf[t, spot]
    return Trees(base, feature, threshold, leaf)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == HELD_OUT_REMAINDER, F.lit(False))


def _statistics(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = text_statistics(batch.column("text"))
        values = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("quality"), values], names=["quality", "x"])


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Trees fitted to `labels.quality` outside the held-out fold.

    Only text statistics are inputs.  Null ids and labels are not learned from; without
    labels, or with labels of one kind, every text scores the share of label 1
    (one half without labels).
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).filter(
        "doc_id IS NOT NULL AND quality IN (0, 1)"
    )
    order = [F.md5(F.col("doc_id").cast("string")), "doc_id", "quality"]
    chosen = known.filter(~held_out(F.col("doc_id"))).orderBy(*order).limit(rows)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # at most `rows` ids of 12 bytes
    sample = texts.join(F.broadcast(chosen), "doc_id").select("quality", "text")
    table = sample.mapInArrow(_statistics, "quality int, x array<double>").toArrow()
    x = np.array(table.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = table.column("quality").to_numpy().astype(float)
    order = np.lexsort([*x.T, y])  # the rows' order must not depend on the tasks'
    return fit_trees(x[order], y[order])


def score_quality(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, score) for every row of `docs`; null text scores as an empty one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = trees.score(text_statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, "doc_id long, score double")


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text).

    Repeated rows come out as often as they went in; other columns are ignored; an
    empty table gives an empty result.
    """
    scored = score_quality(docs, fit_quality(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= KEEP_AT, 1).otherwise(0).alias("predicted"),
    )


def keep_quality(docs: DataFrame, trees: Trees, at: float = KEEP_AT) -> DataFrame:
    """The rows of `docs` that score at least `at`, in one pass over the texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(trees.score(text_statistics(batch.column("text"))) >= at))

    return docs.mapInArrow(run, docs.schema)
