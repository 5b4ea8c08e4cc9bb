"""Word hashes of whole texts, computed with numpy on the bytes of an Arrow column.

A word is a maximal run of bytes outside space and 0x09 to 0x0D, which in UTF-8 is
the same as a run of code points outside that set.  Each word gets a 64-bit hash
that depends only on its bytes.  Texts are taken in blocks of about half a
megabyte, so memory does not follow the batch; a longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_FOLDED = _BYTE.copy()
_BYTE_FOLDED[65:91] = _BYTE[97:123]
_MULT = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for i, base in enumerate((_BASE, inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay within the limit, single longer rows alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each row's first word number."""
    solid = np.zeros(len(data) + 2, bool)
    np.logical_not(_SPACE[data], out=solid[1:-1])
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | cut[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hashes of byte ranges; with `fold`, A to Z count as a to z."""
    power, inverse = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    table = _BYTE_FOLDED if fold else _BYTE
    np.cumsum(table[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def tokenise(texts: pa.Array, fold: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, word bounds of the rows) for each block of rows."""
    data, offsets = bytes_of(texts)
    for first, last in blocks(offsets):
        part = data[offsets[first] : offsets[last]]
        rows = offsets[first : last + 1] - offsets[first]
        starts, ends, bounds = word_spans(part, rows)
        yield first, hash_spans(part, starts, ends, fold), bounds


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words, by its first word; runs cross row bounds."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += words[i : i + n] * _MULT[i % 64] + np.uint64(i)
    return mix(total)


def shingle_sets(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, sorted, and their bounds.

    A row with fewer words has its whole sequence as its one shingle; a row
    without words has none.
    """
    counts = np.diff(bounds)
    runs = np.maximum(counts - size + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < size))
    row = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(bounds[:-1], runs)
    values = grams(words, size)[at] if len(at) else np.zeros(0, np.uint64)
    if len(short):
        few = [
            mix((words[a:b] * _MULT[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
            for a, b in zip(bounds[short], bounds[short + 1])
        ]
        values = np.concatenate([values, *few])
        row = np.concatenate([row, short])
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    first = np.ones(len(row), bool)
    first[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[first], row[first]
    return values, np.searchsorted(row, np.arange(len(counts) + 1))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket number from the hash alone, in bits that the order of hashes does not use."""
    return ((mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def by_bucket(hashes: np.ndarray, buckets: int, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Rows packed as bytes, one item for each bucket that has any."""
    if not len(hashes):
        return
    bucket = bucket_of(hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        yield int(bucket[part[0]]), [c[part].tobytes() for c in (hashes, *columns)]
