"""Joins and deduplication against comparing everything with everything."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from flightlake.llm import ngram_join, substring_dedup
from flightlake.llm.embedding_dedup import embedding_links, pivot_lists, sharing
from flightlake.llm.graph import local_roots
from flightlake.llm.line_dedup import deduplicated, within
from flightlake.llm.ngram_join import group_leaders, ngram_components, segment_keys, size_classes
from flightlake.llm.substring_dedup import SuffixAutomaton, _compared, _found, anchors, remove_repeats
from tests_llm import edit_distance, kept_lines, ngram_groups

CLASHING = "doc_id long, text string, node string, key string, bucket string, root int, n int, n_lines string, spans int"


def rows_with_extras(spark, rows):
    return spark.createDataFrame([(i, t, "x", None, "b", 1, 2, "own", 3) for i, t in rows], CLASHING)


def near_copies(seed, n, low=1, high=60):
    """Texts of few words, with copies of which some words were changed, and edge cases."""
    rng = random.Random(seed)
    bank = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 5))) for _ in range(400)]
    line = " ".join(rng.choices(bank, k=12))
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            words = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(bank)
        else:
            words = rng.choices(bank, k=rng.randint(low, high))
            if rng.random() < 0.4:
                words += line.split(" ")
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, ""), (n + 4, texts[0].upper()), (n + 5, "word " * 4000)]


@pytest.mark.parametrize("seed,low,high", [(1, 1, 12), (2, 20, 200)])
def test_ngram_components(spark, monkeypatch, seed, low, high):
    rows = near_copies(seed, 250, low, high)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 16)  # components over several blocks
    monkeypatch.setattr(ngram_join, "GROUP", 4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(rows_with_extras(spark, rows)).collect()}
    want = ngram_groups(rows)
    assert sum(i != c for i, (_, c) in want.items()) > 20
    assert got == want


def test_chains_of_a_large_group_are_added_up_before_they_are_rows():
    """Every task sees the whole group in a crowded segment; a chain is a row for each document once, not once a task."""
    many, tasks, ranges = 500, 40, 7
    nodes = np.arange(1, many + 1) * 7919
    kinds = [("bucket", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary()), ("roots", pa.binary())]
    met = []
    for task in range(tasks):
        held = nodes[task % 3 :]  # not the same smallest one everywhere
        row = dict(bucket=task, keys=ngram_join._packed(np.full(len(held), task)), nodes=ngram_join._packed(held), roots=None)
        met += ngram_join._meet(ranges)(iter([pa.RecordBatch.from_pylist([row], schema=pa.schema(kinds))]))
    assert sum(batch.num_rows for batch in met) <= tasks * ranges
    rows = pa.Table.from_batches(met)
    parts = [rows.filter(pc.equal(rows["part"], p)).combine_chunks().to_batches() for p in range(ranges)]
    edges = [edge for part in parts if part for batch in ngram_join._chains(iter(part)) for edge in zip(*batch.to_pydict().values())]
    assert len(edges) <= many + 3 * ranges
    found, roots = local_roots(*np.array(edges).T)
    assert found.tolist() == nodes.tolist() and set(roots.tolist()) == {7919}


def test_sketches_bound_the_difference_of_sets():
    rng = np.random.default_rng(7)
    for n in (1, 5, 33, 100, 129, 1500):
        for share in (0.0, 0.6, 0.8, 0.95, 1.0):
            common = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
            a, b = (np.unique(np.append(common, rng.integers(0, 1 << 63, m - len(common), dtype=np.uint64))) for m in (n, n + n // 4))
            least = ngram_join.least_difference(ngram_join.sketch(a), ngram_join.sketch(b))
            assert least == ngram_join.least_difference(ngram_join.sketch(b), ngram_join.sketch(a)) <= len(np.setxor1d(a, b))
            if n >= 100 and share <= 0.8:  # no candidates, their similarity is at most 0.6
                assert least * 180 > (len(a) + len(b)) * 20


def test_sifting_joins_what_may_link_and_nothing_else():
    rng = np.random.default_rng(8)
    common = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = [np.append(common, rng.integers(0, 1 << 63, m, dtype=np.uint64)) for m in [60] * 30 + [75] * 30]
    sets += [np.append(s[2:], rng.integers(0, 1 << 63, 2, dtype=np.uint64)) for s in sets]  # a near copy of each
    n, cells, of = np.array([len(s) for s in sets]), [ngram_join.sketch(s) for s in sets], np.arange(120) % 60
    none = np.zeros(120, bool)
    label = ngram_join.sift(n, cells, none.astype(int), none, 80)
    assert len(set(zip(label.tolist(), of.tolist()))) == len(set(label.tolist())) == 60
    crossed = ngram_join.sift(n, cells, (np.arange(120) >= 60).astype(int), none, 80)
    assert len(set(zip(crossed.tolist(), of.tolist()))) == len(set(crossed.tolist())) == 60
    assert len(set(ngram_join.sift(n, cells, none.astype(int), ~none, 80).tolist())) == 120


def test_a_shared_passage_makes_no_candidates(spark, monkeypatch):
    """Segments of a passage that many texts share are crowded; they joined all its texts, and each block was sent to every other."""
    rng = random.Random(3)
    bank = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    passage = rng.choices(bank, k=200)
    texts = [" ".join(passage + rng.choices(bank, k=100)) for _ in range(60)]
    texts += [text + " more" for text in texts[:5]]
    largest, real = {}, ngram_join.components

    def spied(edges, name):
        found = real(edges, name)
        largest[name] = max((r["count"] for r in found.groupBy("root").count().collect()), default=0)
        return found

    monkeypatch.setattr(ngram_join, "components", spied)
    monkeypatch.setattr(ngram_join, "GROUP", 4)
    monkeypatch.setattr(ngram_join, "SIFT_SETS", 16)  # chains over several blocks
    got = {r.doc_id: r.component_id for r in ngram_components(rows_with_extras(spark, list(enumerate(texts)))).collect()}
    assert got == {i: i if i < 60 else i - 60 for i in range(65)}
    assert largest["ngram_chained"] > 30 and largest["ngram_near"] == 2


def test_ngram_repeated_rows_and_nulls(spark):
    text = "a b c d e f g"
    rows = [(5, text), (5, text), (None, text), (9, text), (None, ""), (7, "q")]
    got = sorted(map(tuple, ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(5, 3, 5), (5, 3, 5), (None, 3, 5), (9, 3, 5), (None, 0, None), (7, 1, 7)], key=repr)
    kept = group_leaders(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(5, text), (7, "q"), (None, "")], key=repr)


def test_group_leaders_keep_columns(spark):
    df = rows_with_extras(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, None)])
    kept = group_leaders(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_partner_is_in_the_same_class_or_the_next():
    first, segments, _ = size_classes(30_000, 80)
    for n in list(range(1, 400)) + [1000, 7777, 20_000]:
        c = np.searchsorted(first, n, "right") - 1
        for m in {n, n * 5 // 4}:
            level = np.searchsorted(first, m, "right") - 1
            assert level - c in (0, 1)
            assert (n + m) * 20 // 180 < segments[c]  # more segments than differences


def test_linked_sets_share_a_segment():
    rng = np.random.default_rng(4)
    for n in list(range(4, 80)) + [150, 400, 2000]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            change = n // 9
            b = np.unique(np.concatenate([a[rng.permutation(len(a))[change:]], rng.integers(0, 1 << 63, change, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both):
                continue
            keys, row = segment_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 80)
            assert len(np.intersect1d(keys[row == 0], keys[row == 1]))


def test_edit_automaton():
    rng = random.Random(2)
    first, second = [], []
    for _ in range(1500):
        a = "".join(rng.choices("abé", k=rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["x", "", "ab"])
        first.append(a)
        second.append("".join(b))
    for edits in (0, 1, 2, 3):
        want = [edit_distance(a, b) <= edits for a, b in zip(first, second)]
        assert within(first, second, edits).tolist() == want
    each = [rng.randint(0, 3) for _ in first]
    assert within(first, second, np.array(each)).tolist() == [edit_distance(a, b) <= e for a, b, e in zip(first, second, each)]


def test_lines(spark):
    rng = random.Random(8)
    bank = ["".join(rng.choices("abcdefgh éñ😀", k=rng.randint(20, 80))) for _ in range(70)]
    rows = []
    for i in range(160):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(bank))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                at = rng.randrange(len(line))
                line[at : at + rng.randint(0, 1)] = rng.choice(["x", "", "yz"])
            lines.append("".join(line))
        lines += ["  "] * (i % 7 == 0) + ["short"] * (i % 5 == 0) + [""] * (i % 3 == 0)
        rows.append((i, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "k" * 1500), (204, "k" * 1499 + "j"), (None, bank[0])]
    out = deduplicated(rows_with_extras(spark, rows))
    assert out.columns == ["doc_id", "text", "node", "key", "bucket", "root", "n", "spans", "n_lines", "n_removed"]
    got = {r.doc_id: r for r in out.collect()}
    want = kept_lines(rows)
    assert {i: r.text for i, r in got.items()} == want
    assert got[204].text == "" and got[203].n_removed == 0 and got[200].n_lines == 0
    for i, text in rows:
        assert got[i].n_lines - got[i].n_removed == (0 if text is None else len(want[i].split("\n")) if got[i].n_removed < got[i].n_lines else 0)


def test_short_lines(spark):
    """Around the lengths at which one and two edits become possible, and at the old bound of 32."""
    rng = random.Random(12)
    rows = []
    for size in (1, 2, 5, 10, 11, 12, 13, 14, 22, 23, 24, 25, 26, 30, 31, 32, 33, 34):
        for edits in (1, 2, 3):
            for _ in range(3):
                line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=size - 1)) + "x"
                other = list(line)
                for _ in range(edits):
                    at = rng.randrange(max(len(other), 1))
                    other[at : at + rng.randint(0, 1)] = rng.choice(["Q", "", "Z"])
                rows += [(len(rows), line), (len(rows) + 1, "".join(other))]
    rows += [(1000, "The thertion."), (1001, "The, thertion."), (1002, "the cats"), (1003, "the cat")]
    got = {r.doc_id: r.text for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == kept_lines(rows)
    assert got[1001] == "" and got[1003] == "the cat"


def test_lines_of_repeated_rows(spark):
    rows = [(1, "same line\nother"), (1, "same line\nother"), (2, "same line")]
    got = deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), counts=False)
    assert sorted(map(tuple, got.collect())) == [(1, "same line\nother"), (1, "same line\nother"), (2, "")]


def removed_by_brute_force(rows, window):
    out, first = {}, {}
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in texts:
        if i is not None:
            for k in range(len(words) - window + 1):
                run = tuple(words[k : k + window])
                first[run] = min(first.get(run, i), i)
    for i, words in texts:
        gone = bytearray(len(words))
        if i is not None:
            for k in range(len(words) - window + 1):
                if first[tuple(words[k : k + window])] < i:
                    gone[k : k + window] = b"\1" * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.setdefault(i, []).append((len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("window,gram", [(12, 4), (50, 10)])
def test_repeated_passages(spark, window, gram):
    rng = random.Random(window)
    bank = ["".join(rng.choices("abcdé", k=rng.randint(1, 4))) for _ in range(300)]
    passages = [rng.choices(bank, k=rng.randint(window - 3, 3 * window)) for _ in range(12)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            words += p[a : len(p) - rng.randint(0, 5)] if rng.random() < 0.7 else rng.choices(bank, k=rng.randint(1, window))
        rows.append((i * 3, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(400, None), (401, ""), (402, "z " * 3 * window), (403, "z " * 4 * window), (None, rows[0][1]), (5, rows[7][1]), (5, rows[7][1])]
    rng.shuffle(rows)
    got = {}
    for r in remove_repeats(rows_with_extras(spark, rows), window, gram).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()))
    want = removed_by_brute_force(rows, window)
    assert sum(v[0][1] > 0 for v in want.values()) > 20
    assert {i: sorted(v) for i, v in got.items()} == want


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    a, b, c = (rng.integers(1, 1 << 60, n, dtype=np.uint64) for n in (90, 70, 40))
    words = np.concatenate([a, b, b, c])  # b stands in two rows
    at = anchors(words, np.array([0, 160, 270]))
    first = set((at[(at >= 90) & (at <= 150)] - 90).tolist())
    second = set((at[(at >= 160) & (at <= 220)] - 160).tolist())
    inside = lambda s: {x for x in s if 40 <= x <= 20 + 40}  # noqa: E731  held by windows of b alone
    assert inside(first) == inside(second) and first & second


def test_equal_surroundings_have_equal_digests_in_any_block():
    rng = random.Random(4)
    passage = [str(rng.random()) for _ in range(200)]
    seen = []
    for extra in (0, 1, 57):  # each batch is a block of another word count
        texts = [" ".join(str(rng.random()) for _ in range(90 + extra)), " ".join(passage)]
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts)], names=["doc_id", "text"])
        packed = pa.Table.from_batches(_found(50, 10, 1)([batch])).to_pydict()
        anchor, around = (np.frombuffer(b"".join(packed[c]), np.uint64) for c in ("anchor", "around"))
        mine = np.frombuffer(b"".join(packed["doc_id"]), np.int64) == 2
        seen.append(set(zip(anchor[mine].tolist(), around[mine].tolist())))
    assert len(seen[0]) > 3 and seen[0] == seen[1] == seen[2]


def crowded_rows():
    rng = random.Random(5)
    word = lambda: str(rng.randrange(10**6))
    passage = [word() for _ in range(70)]
    rows = []
    for i in range(100):  # one passage or a part of it, each time in other surroundings
        a, b = rng.randint(0, 8), rng.randint(62, 70)
        rows.append((100 - i, " ".join([*[word() for _ in range(45)], *passage[a:b], *[word() for _ in range(45)]])))
    return rows


def test_crowded_anchors_stay_out_of_the_automata():
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*crowded_rows())], names=["doc_id", "text"])
    rows = pa.Table.from_batches(_compared(_found(50, 10, 1)([batch]))).to_pydict()
    crowd = rows.get("crowd", [False] * len(rows["anchor"]))
    sent = [a for a, c, repeat in zip(rows["anchor"], crowd, rows["repeat"]) if not repeat and not c]
    assert any(crowd) and max((sent.count(a) for a in sent), default=0) <= 64


@pytest.mark.parametrize("crowd", [None, 1])
def test_crowded_passages(spark, monkeypatch, crowd):
    if crowd:
        monkeypatch.setattr(substring_dedup, "CROWD", crowd)
    rows = [*crowded_rows(), (400, "z " * 150), (401, "z " * 200), (402, None)]
    got = {}
    for r in remove_repeats(rows_with_extras(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()))
    want = removed_by_brute_force(rows, 50)
    assert sum(v[0][1] > 0 for v in want.values()) > 90
    assert {i: sorted(set(v)) for i, v in got.items()} == want


def test_suffix_automaton_spans():
    rng = random.Random(1)
    for _ in range(60):
        refs = [rng.choices(range(3), k=rng.randint(0, 25)) for _ in range(4)]
        text = rng.choices(range(3), k=40)
        machine = SuffixAutomaton()
        for r in refs:
            machine.add(r)
        known = {tuple(r[i : i + 5]) for r in refs for i in range(len(r) - 4)}
        want = {p for i in range(36) if tuple(text[i : i + 5]) in known for p in range(i, i + 5)}
        assert {p for low, high in machine.spans(text, 5) for p in range(low, high)} == want


def embedding_rows(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(500):
        v = rng.normal(size=16)
        if rows and rng.random() < 0.6:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(size=16) * rng.choice([0, 0.02, 0.1, 0.2])
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(3))))
    big = [x * 1e30 for x in rows[0][1]]
    return rows + [
        (600, None, 1), (601, [0.0] * 16, 1), (602, [float("nan")] * 16, 1), (603, [None] + [1.0] * 15, 1),
        (604, rows[0][1], None), (605, rows[0][1][:8], rows[0][2]), (606, big, rows[0][2]), (607, [], 1),
        (608, [float("inf")] * 16, 1), (3, rows[3][1], rows[3][2]),
    ]


def test_shared_pivots_are_counted():
    rng = np.random.default_rng(3)
    for shared, pivot in ((1, 0), (2, 3), (3, 5)):
        x, y = (np.array([rng.choice(9, 4, replace=False) for _ in range(n)], np.int32) for n in (7, 11))
        x[:, 0], y[:, 0] = np.where((x == pivot).any(1), x[:, 0], pivot), np.where((y == pivot).any(1), y[:, 0], pivot)
        got = sharing(x, pivot_lists(y), len(y), shared, pivot)
        want = [[len(set(a) & set(b)) >= shared and min(set(a) & set(b)) == pivot for b in y.tolist()] for a in x.tolist()]
        assert got.tolist() == want


def test_embeddings(spark, monkeypatch):
    from flightlake.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "BLOCK", 20)
    rows = embedding_rows(1)
    schema = "vec_id long, embedding array<float>, label int, node string, size string, links int"
    df = spark.createDataFrame([(*r, "n", "s", 1) for r in rows], schema)
    got = embedding_links(df).collect()
    assert len(got) == len(rows)

    def good(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links, up = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (_, v, x) in enumerate(rows):
        for b, (_, w, y) in enumerate(rows[:a]):
            if x is None or x != y or not good(v) or not good(w) or len(v) != len(w):
                continue
            p, q = np.float64(np.float32(v)), np.float64(np.float32(w))
            if p @ q / math.sqrt(p @ p) / math.sqrt(q @ q) >= 0.98:
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    smallest = {}
    for i, r in enumerate(rows):
        smallest[root(i)] = min(r[0], smallest.get(root(i), r[0]))
    want = sorted((r[0], links[i], smallest[root(i)], r[0] == smallest[root(i)]) for i, r in enumerate(rows))
    found, total = sum(r.n_links for r in got), sum(links)
    assert total > 100 and found >= 0.99 * total  # recall of the index
    if found == total:
        assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("operator", [ngram_components, group_leaders, deduplicated, remove_repeats])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_empty_embeddings(spark):
    assert embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
