"""Word hashes, shingle sets, components and sieves against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from flightlake.llm import graph, words
from tests_llm import WORD, Union, shingles

TEXTS = [
    "a b  c", None, "", "  \t\n", "one", "é ñ\x0bß\x0c梦\r\n😀 x", "word " * 30, "A a A a", "x" * 5000, "tail ", " head",
]


def test_equal_words_have_equal_hashes_and_others_not():
    seen = {}
    for first, hashes, bounds in words.tokenise(pa.array(TEXTS)):
        for r in range(len(bounds) - 1):
            mine = WORD.findall(TEXTS[first + r] or "")
            assert bounds[r + 1] - bounds[r] == len(mine)
            for word, h in zip(mine, hashes[bounds[r] : bounds[r + 1]].tolist()):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_blocks_do_not_change_hashes(monkeypatch):
    whole = np.concatenate([h for _, h, _ in words.tokenise(pa.array(TEXTS))])
    monkeypatch.setattr(words.blocks, "__defaults__", (7,))
    parts = np.concatenate([h for _, h, _ in words.tokenise(pa.array(TEXTS))])
    assert (whole == parts).all()


def test_fold_takes_ascii_letters_only():
    (_, h, _), = words.tokenise(pa.array(["ABC abc É é"]), fold=True)
    assert h[0] == h[1] and h[2] != h[3]


def test_shingle_sets():
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choices("abc", k=rng.randint(0, 12))) for _ in range(60)]
    values, sizes = {}, []
    for first, h, bounds in words.tokenise(pa.array(texts), fold=True):
        v, b = words.shingle_sets(h, bounds, 5)
        for r in range(len(b) - 1):
            mine = v[b[r] : b[r + 1]].tolist()
            assert mine == sorted(set(mine))
            sizes.append(len(mine))
            values.setdefault(shingles(texts[first + r]), set()).add(tuple(mine))
    assert sizes == [len(shingles(t)) for t in texts]
    assert all(len(v) == 1 for v in values.values())
    assert len({next(iter(v)) for v in values.values()}) == len(values)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(7, 7), (2000, 3000), (2000, 3000)]  # a path, a loop, a repeat
    union = Union()
    for a, b in edges:
        union.join(a, b)
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r.node: r.root for r in graph.components(df, "test").collect()}
    want = {n: union.find(n) for e in edges for n in e if e[0] != e[1]}
    assert {n: r for n, r in got.items()} == {n: union.find(n) for n in got}
    assert set(want) <= set(got) | {7}


def test_components_of_nothing(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long"), "none").count() == 0


def test_sieve_lets_every_key_pass(spark):
    keys = [-5, 0, 3, 1 << 40, -(1 << 62)]
    bits = graph.sieve(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 1 << 12)
    assert graph.passes(bits, np.array(keys)).all()
    assert graph.passes(bits, np.arange(10_000, 20_000)).mean() < 0.01
