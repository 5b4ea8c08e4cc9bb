"""Personal data, pieces, quality and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from flightlake.llm import pieces as sp
from flightlake.llm import pii
from flightlake.llm.pieces import Pieces, encode_documents, read_model
from flightlake.llm.quality import FEATURES, Trees, fit_trees, keep_quality, quality_table, text_statistics
from flightlake.session import staged
from tests_llm import kept_lines, ngram_groups

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def spans_by_pattern(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans():
    rng = random.Random(6)
    parts = ["a@b.c", "@", ".", "1.2.3.4", "256.1.1.1", "00001.2.3.4.5.6.7.8", "+1 (293) 555-9179", "4111 1111 1111 1111", " ", "-",
             "x", "é", "a@b", "+", "12", "4111111111111111", "a@b@c.de", "%", "(", "+12", "0" * 20]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 9)))
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == spans_by_pattern(text), text
    assert pii.base_spans("a" * 300_000 + " @ " + "1" * 300_000) == []  # not quadratic


def test_tagger_gradients():
    rng = np.random.default_rng(0)
    tagger = pii.Tagger.fresh()
    tagger.w = {k: v.astype(np.float64) for k, v in tagger.w.items()}
    x = rng.integers(0, pii._CODES, (3, pii.WIDTH))
    y = np.zeros((3, pii.WIDTH), int)
    y[0, 5], y[0, 6:12] = 1, 2
    grads = tagger.gradients(x, y)[1]
    for name, at in (("xf", (x[0, 6], 3)), ("hb", (2, 7)), ("out", (5, 1)), ("bias", (0,)), ("move", (0, 1)), ("move", (1, 2))):
        old, loss = tagger.w[name][at], []
        for step in (1e-4, -1e-4):
            tagger.w[name][at] = old + step
            loss.append(tagger.gradients(x, y)[0])
        tagger.w[name][at] = old
        assert grads[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-4, rel=2e-2, abs=2e-3)


def test_reconcile_is_the_best_choice():
    rng = random.Random(3)
    for _ in range(200):
        spans = [(rng.random(), (0, s, s + rng.randint(1, 6))) for s in rng.choices(range(20), k=7)]
        taken = [(1, 9, 11)]
        best = 0.0
        for mask in range(1 << len(spans)):
            some = sorted((s for i, s in enumerate(spans) if mask >> i & 1), key=lambda c: c[1][1])
            apart = all(a[1][2] <= b[1][1] for a, b in zip(some, some[1:])) and all(s[2] <= 9 or s[1] >= 11 for _, s in some)
            best = max(best, sum(w for w, _ in some) if apart else 0.0)
        got = pii.reconcile(spans, taken)
        weight = {}
        for w, s in spans:
            weight[s] = max(w, weight.get(s, 0.0))
        assert sum(weight[s] for s in got) == pytest.approx(best)


@pytest.fixture(scope="module")
def tagger(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return pii.fit_tagger(docs.filter("doc_id % 2 = 0"))


def test_tagger_learns_the_spans(spark, tagger):
    """Base spans and rewritten ones of texts that it has not seen."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 2 = 1 AND text RLIKE '[0-9@]'")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    for form in (lambda t: (t, pii.base_spans(t)), lambda t: pii.varied(t, pii.base_spans(t), len(t))):
        found = missed = wrong = 0
        pairs = [form(t) for t in texts]
        for (text, want), spans in zip(pairs, pii.tagged_spans(tagger, [pii.codes(t) for t, _ in pairs])):
            mine = {s for s in pii.reconcile(spans, []) if pii.plausible(s[0], text[s[1] : s[2]])}
            found, missed, wrong = found + len(mine & set(want)), missed + len(set(want) - mine), wrong + len(mine - set(want))
        print(found, missed, wrong)
        assert found / (found + missed) >= 0.9 and found / (found + wrong) >= 0.9


def test_tags_are_stitched():
    """Every position has one window; spans go on across windows, whatever their length."""

    class Fixed:
        def decode(self, x):
            digit = x == pii._CODE[48]
            tags = np.where(digit, 6, 0)
            tags[:, 1:][digit[:, 1:] & ~digit[:, :-1]] = 5
            return tags, np.where(digit, 1.0, 0.0)

    rng = random.Random(4)
    for _ in range(40):
        texts, want = [], []
        for _ in range(rng.randint(1, 6)):
            text, spans = "a" * rng.randint(0, 200), []
            for _ in range(rng.randint(0, 4)):
                size = rng.choice([1, 15, 33, 64, 255, 256, 257, 700])
                spans.append((float(size), (2, len(text), len(text) + size)))
                text += "1" * size + "b" * rng.randint(1, 150)
            texts.append(text)
            want.append(spans)
        assert pii.tagged_spans(Fixed(), [pii.codes(t) for t in texts]) == want
    for size in (0, 1, 31, 32, 33, 255, 256, 257, 1000):
        starts = pii.window_starts(size)
        assert len(starts) == 0 if size == 0 else starts[0] == 0 and starts[-1] + pii.WIDTH >= size


def test_decode_is_viterbi(tagger):
    """The early way out changes nothing."""
    text = "mail a.b@c.de or +1 (293) 555-9179, 4111 1111 1111 1111 at 10.0.0.7 " * 3 + "only words here and there " * 20
    code = pii.codes(text)
    x = np.array([code[s : s + pii.WIDTH] for s in range(0, len(code) - pii.WIDTH, 16)])
    tags, gain = tagger.decode(x)
    all_tags, all_gain = tagger._best(tagger.emissions(x)[0], tagger.transitions())
    assert (tags == all_tags).all() and (~tags.any(axis=1)).any()
    assert np.allclose(gain[tags > 0], all_gain[tags > 0])


def test_open_windows_miss_no_way():
    """Scores are the emissions, and the bound leaves open every window whose best tags are not O alone."""
    rng = np.random.default_rng(5)
    opened = shut = 0
    for seed in range(30):
        tagger = pii.Tagger.fresh(seed)
        tagger.w["move"] = rng.normal(0, 2, tagger.w["move"].shape).astype(np.float32)
        tagger.w["bias"][0] += rng.uniform(0, 3)
        x = rng.integers(0, pii._CODES, (40, 12)).astype(np.uint8)
        e, scores = tagger.emissions(x)[0], tagger._scores(x)
        assert np.allclose(scores.transpose(0, 2, 1), e, atol=1e-4)
        other = np.flatnonzero(tagger._best(e, tagger.transitions())[0].any(axis=1))
        found = tagger._open(scores)
        assert set(other) <= set(found)
        opened, shut = opened + len(found), shut + len(x) - len(found)
    assert opened and shut


def test_personal_data_with_a_tagger(spark, tagger):
    """Null, empty, very long and repeated texts, clashing columns, and spans that no pattern knows."""
    texts = [None, "", "und card 4111/1111/1111/1111 ere", "here 10 . 0 . 0 . 7 and", "the john.smith (at) corp.org thea", "no digits " * 9000,
             "x" * 100_000 + " a.b@c.de " + "y" * 100_000, "ip 1.2.3.4, +1 (293) 555-9179"]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)] + [(2, texts[2], "s", 1)], "doc_id long, text string, spans string, n_ip int")
    got = pii.find_personal_data(df, tagger).collect()
    assert len(got) == 9
    for r in got:
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in spans_by_pattern(texts[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].n_added for i in (0, 1, 5, 6, 7)] == [0] * 5
    assert (by_id[2].n_card, by_id[3].n_ip, by_id[4].n_email) == (1, 1, 1)


def test_personal_data_rows(spark):
    texts = [None, "", "mail a.b@c.de now", "ip 1.2.3.4, +1 (293) 555-9179", "no digits", "é" * 5000 + " x@y.zz"]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)] + [(2, texts[2], "s", 1)], "doc_id long, text string, spans string, n_ip int")
    got = pii.find_personal_data(df, None).collect()
    assert len(got) == 7
    for r in got:
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in spans_by_pattern(texts[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans == base
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_personal_data(empty, pii.fit_tagger(empty)).collect() == []


def test_pieces_are_the_best_segmentation():
    table, scores, byte_ids = read_model()
    model = Pieces(table, scores, byte_ids)
    ids = {p: i for i, p in enumerate(table) if np.isfinite(scores[i])}
    rng = random.Random(1)
    for _ in range(150):
        text = "".join(rng.choices("abcdeé ñß\n😀thing", k=rng.randint(0, 40)))
        marked = (" " + text).replace(" ", sp.MARK)
        best = [0.0]
        for end in range(1, len(marked) + 1):
            steps = [best[end - 1] + model.missing]
            steps += [best[s] + scores[ids[marked[s:end]]] for s in range(max(0, end - 20), end) if marked[s:end] in ids]
            best.append(max(steps))
        got = model.encode(text)
        plain = [i for i in got if np.isfinite(scores[i])]
        raw = b"".join(model.bytes_of[i] for i in got if not np.isfinite(scores[i])).decode()
        assert sum(scores[i] for i in plain) + model.missing * len(raw) == pytest.approx(best[-1], rel=1e-9)
        assert model.decode(got) == text


def test_pieces_rows(spark):
    texts = [None, "", " ", "▁ kept ▁▁", "tab\tnew\nline  two", "😀" * 3000, "plain words"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(6, texts[6], "x")], "doc_id long, text string, ids string")
    got = encode_documents(df).collect()
    assert len(got) == 8
    for r in got:
        assert r.text_sha256 == r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
        assert r.n_pieces == len(r.ids) and r.n_chars == len(texts[r.doc_id] or "")
    assert encode_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_statistics_are_finite():
    rows = text_statistics(pa.array([None, "", " \n", "Word. word!! | x", "é" * 100, "a " * 20_000]))
    assert rows.shape == (6, len(FEATURES)) and np.isfinite(rows).all() and (rows[:2, 0] == 0).all()


def test_trees_walk_like_a_plain_loop():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    trees = fit_trees(x, y, trees=25, depth=3)
    scores = trees.score(x)
    for i in range(0, 400, 17):
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if x[i, f[node]] > t[node] else 1)
            total += leaf[node - len(f)]
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((scores > 0.5) == y).mean() > 0.97


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    got = quality_table(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in known]
    assert len(held) > 50 and sum(r.predicted == known[r.doc_id] for r in held) / len(held) > 0.95
    # labels of the held-out fold change nothing
    flipped = labels.selectExpr("doc_id", "CASE WHEN pmod(crc32(CAST(doc_id AS STRING)), 4) = 2 THEN 1 - quality ELSE quality END quality")
    assert sorted(map(tuple, quality_table(docs, flipped).collect())) == sorted(map(tuple, got))


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (None, None, 2), (1, "a b", 1)], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted(map(tuple, quality_table(docs, labels).collect()), key=repr) == sorted(
        [(1, False, 0.5, 0), (1, False, 0.5, 0), (None, False, 0.5, 0)], key=repr
    )
    none = Trees(0.0, np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 1)))
    assert keep_quality(docs, none, 0.5).count() == 3 and keep_quality(docs, none).count() == 0
    assert quality_table(docs.limit(0), labels).collect() == []


def test_pipeline_stages(spark):
    """Each stage on its own input, against brute force where there is one."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.columns
    outs = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, staged(stage(spark, docs, "/root/testdata/sf0.001"), f"test_{name}")
        outs[name] = docs
        if name != "pieces":
            assert docs.columns == columns and docs.dtypes == before.dtypes
        old = {r.doc_id: r.text for r in before.collect()}
        if name == "line_dedup":
            assert {r.doc_id: r.text for r in docs.collect()} == kept_lines(list(old.items()))
            assert docs.filter("n_chars != length(text)").isEmpty()
        if name == "ngram_join":
            groups = ngram_groups(list(old.items()))
            assert sorted(r.doc_id for r in docs.collect()) == sorted(i for i, (_, c) in groups.items() if i == c)
    assert outs["pieces"].count() == outs["mixing"].count()
    assert outs["pieces"].filter("text_sha256 != decoded_sha256").isEmpty()


def test_pipeline_on_empty_documents(spark, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
