"""Fingerprints, URL verdicts and mixing against plain Python and SQL."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from flightlake.llm import url_filter
from flightlake.llm.fingerprints import SAMPLES, fingerprint_pairs
from flightlake.llm.mixing import mix_sources, mixed_documents, source_targets
from flightlake.llm.queries import QUERIES, SQL
from flightlake.llm.url_filter import Cascade, filter_urls
from tests_llm import WORD

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), SQL[name]) == []


def test_no_python_in_native_plans(spark):
    for name in ("op1_weighted_fingerprints", "op2_url_filter_cascade", "op6_source_mixing"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop")), name


def check_fingerprints(rows, got):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in ordered]
    by_text, gaps = {}, []
    got = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert len(got) == len(ordered)
    spare = list(got)
    for at, (i, _) in enumerate(ordered):
        text, after = texts[at], texts[at - 1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        row = next(r for r in spare if r.doc_id == i and r.n_chars == len(text) and r.edited_sha256 == digest)
        spare.remove(row)
        for form, mark in ((text, row.fingerprint), (edited, row.edited_fingerprint)):
            assert by_text.setdefault(form, mark) == mark
        pairs = ((form, near) for form, near in ((edited, row.near_edited), (after, row.near_next)))
        for form, near in pairs:
            a, b = Counter(WORD.findall(text)), Counter(WORD.findall(form))
            true = sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0
            gaps.append((true, near))
            if true in (0.0, 1.0):
                assert near == true
    return gaps


def test_fingerprints(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs]
    rows += [(900, None), (901, ""), (902, " \n "), (-7, "é ñ 😀 wörter"), (None, "no id here"), (5, rows[5][1]), (903, "w " * 9000)]
    schema = "doc_id long, text string, range int, n string, term int, next string"
    df = spark.createDataFrame([(*r, 1, "n", 2, "x") for r in rows], schema).repartition(3)
    gaps = check_fingerprints(rows, fingerprint_pairs(df).collect())
    error = [near - true for true, near in gaps]
    assert abs(sum(error) / len(error)) < 0.03  # unbiased
    assert (sum(e * e for e in error) / len(error)) ** 0.5 < 0.6 / SAMPLES**0.5


def test_likeness_error_is_small(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    gaps = check_fingerprints(rows, fingerprint_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    error = [near - true for true, near in gaps]
    assert (sum(e * e for e in error) / len(error)) ** 0.5 < 0.06


def test_fingerprints_of_one_and_none(spark):
    one = fingerprint_pairs(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")).collect()
    assert check_fingerprints([(1, "a b c d e f")], one) and one[0].near_next == 1.0
    assert fingerprint_pairs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


URLS = [
    (1, "https://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
    (2, "http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    (3, "http://m.www.example.com/en/1", "m.www.example.com", "/en/1", "www.example.com/en/", "allow"),
    (4, "http://badexample.com/en/1", "badexample.com", "/en/1", "com/", "allow"),
    (5, "http://x.net/es/", "x.net", "/es/", "net/es/", "block"),
    (6, "http://x.net/es", "x.net", "/es", None, "allow"),
    (7, "http://x.com", "x.com", "", None, "allow"),
    (8, None, "", "", None, "allow"),
    (9, "no scheme.com/en/", "", "", None, "allow"),
    (10, "http://ads-track.example.org?u=://y.net/es/", "ads-track.example.org", "", None, "block"),
    (11, "http://m.casino-win.net/fr/1#a/b", "m.casino-win.net", "/fr/1", "net/fr/", "block"),
    (12, "http://casino-win2.org/1", "casino-win2.org", "/1", None, "allow"),
    (12, "http://casino-win2.org/1", "casino-win2.org", "/1", None, "allow"),
    (None, "://net/fr/", "net", "/fr/", "net/fr/", "block"),
]


def test_urls(spark):
    schema = "page_id long, url string, host string, shard string, level1 int, listed string"
    df = spark.createDataFrame([(p, u, "h", "s", 1, "l") for p, u, *_ in URLS], schema)
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in filter_urls(df).collect()]
    assert sorted(got, key=repr) == sorted([(u[0], *u[2:]) for u in URLS], key=repr)
    assert filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_urls_of_a_given_list(spark):
    """A host table with nulls, repeats and hosts that no page has; a very long url."""
    far = "http://w.org/" + "x" * 300_000
    pages = spark.createDataFrame([(1, "http://V.org/a"), (2, "http://w.org/a"), (3, None), (4, far), (5, "http://v.org.com/")], "page_id long, url string")
    listed = spark.createDataFrame([("w.org", 1), ("w.org", 2), (None, 3), ("", 4), ("else.org", 5)], "host string, listed int")
    got = {r.page_id: (r.verdict, r.listed, len(r.path)) for r in filter_urls(pages, listed=listed).collect()}
    assert got == {1: ("allow", False, 2), 2: ("block", True, 2), 3: ("allow", False, 0), 4: ("block", True, 300_001), 5: ("allow", False, 1)}


def test_pages_are_not_joined(spark):
    """Filters below the bound are constants: pages are neither joined nor shuffled."""
    plan = filter_urls(spark.read.parquet(f"{SF}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("bound", [0, 1 << 30])
def test_cascade_is_exact(spark, monkeypatch, bound):
    monkeypatch.setattr(url_filter, "LITERAL_BITS", bound)
    monkeypatch.setattr(url_filter, "SHARD_BITS", 1 << 10)  # several shards
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 3)  # many false positives, so many levels
    hosts = spark.range(6000).selectExpr("concat('h', id, '.org') host", "id % 7 = 0 listed")
    cascade = Cascade(hosts)
    assert cascade.shards > 1 and len(cascade.bits) > 2
    assert cascade.mark(hosts, "found").filter("found != listed").count() == 0


def targets(sizes, weights=(1, 2, 3)):
    """Shares by weight, capped at three times the size, the excess dealt again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**share, **capped}
        capped.update({s: 3.0 * sizes[s] for s in over})


def mixing_rows():
    rows = [(i, ["a", "b", "é", None, "big"][min(i % 9, 4)], "w " * (i * 37 % 90)) for i in range(400)]
    return rows + [(900, "tiny", "one"), (901, "none", ""), (902, "none", None), (903, "big", "x y " * 6000), (5, "é", "w " * 5), (None, "a", "q r")]


def test_mixing(spark):
    rows = mixing_rows()
    schema = "doc_id long, source string, text string, size string, sid int, block int, taken int"
    df = spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], schema).repartition(4)
    got = mix_sources(df).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want, taken = targets(sizes), Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[s] - want[s]) <= max(5, 0.01 * want[s]) for s in sizes)
    again = mix_sources(df.repartition(2)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    mixed = mixed_documents(df)
    assert mixed.columns == df.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(WORD.findall(r.text))
    assert all(abs(words[s] - want[s]) <= 3 * max(len(WORD.findall(t or "")) for _, x, t in rows if x == s) for s in sizes)


def test_mixing_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mix_sources(empty).collect() == [] and mixed_documents(empty).collect() == []
    blank = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in mix_sources(blank).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_targets_follow_the_rule(spark):
    sizes = {"a": 10, "b": 1000, "c": 3, "d": 500, None: 0}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))


def test_texts_are_dealt_once(spark):
    """Counting words and looking at neighbours read one exchange of the texts."""
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words"), F.col("id")).alias("text"))
    found = fingerprint_pairs(docs)
    assert len(found.collect()) == 40
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    dealt = [line for line in plan.split("\n") if "REPARTITION_BY_NUM" in line and "ReusedExchange" not in line]
    assert len(dealt) == 1
