"""Exact copies, the prefix trie and the repair of conversations against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from flightlake.llm import exact_dedup, prefix_trie
from flightlake.llm.exact_dedup import drop_copies, exact_groups, golomb_decode, golomb_encode
from flightlake.llm.prefix_trie import BurstTrie, prefix_nodes
from flightlake.llm.turn_repair import cheapest_edits, damaged, repair_report, repaired_turns

CLASHING = "block string, place string, doc_id long, text string, print string, row int, words string"
CONV = "conv_id long, turn int, role string, text string, key string, copies string, kind int, turns int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("n,width", [(1, 1), (2, 1 << 40), (500, 500), (3000, 1 << 20), (3000, 1 << 46)])
def test_golomb_round_trip(n, width):
    values = np.unique(np.random.default_rng(n).integers(7 << 20, (7 << 20) + width, n))
    code = golomb_encode(values, 7 << 20)
    assert (golomb_decode(len(values), 7 << 20, *code) == values).all()
    if n == 3000:  # within two and a half bits of what the gaps need
        assert 8 * (len(code[1]) + len(code[2])) < n * (np.log2(width / n) + 2.5)


def wanted_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[A-Z]", lambda m: m[0].lower(), text or "")].append(doc_id)
    return sorted(
        (repr((i, max((j for j in ids if j is not None), default=None), len(ids), sha(t))) for t, ids in groups.items() for i in ids)
    )


def test_exact_groups(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_BITS", 6)  # many blocks
    rng = random.Random(3)
    texts = ["", None, "ÀB", "àb", "ab", "AB", "x" * 100_000, " a", "a "] + ["word %d" % rng.randrange(300) for _ in range(600)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10_000 + i, "HOT text") for i in range(400)]
    rows += [(None, "ab"), (None, "lonely"), (None, "twice"), (None, "twice"), (5, "AB"), (5, "ab"), (3, "ab"), (7, "q"), (7, "q")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([("b", "p", i, t, "f", 1, "w") for i, t in rows], CLASHING)
    got = exact_groups(docs).collect()
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == wanted_groups(rows)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(map(repr, ((r.doc_id, r.text or "") for r in left.collect() if (r.text or "").lower() == "ab"))) == sorted(
        repr((r.doc_id, t)) for r in got if r.kept for t in ("ab", "AB") if r.text_sha256 == sha("ab") and (r.doc_id, t) in rows
    )[:1]
    assert left.count() == len(kept)


def test_false_suspects_cost_nothing_but_a_comparison(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FINGERPRINT_BITS", 8)  # nearly all texts meet by fingerprint
    rows = [(i, f"text {i % 900}") for i in range(1000)]
    got = exact_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == wanted_groups(rows)


def test_exact_empty(spark):
    docs = spark.createDataFrame([], CLASHING)
    assert exact_groups(docs).count() == 0 and drop_copies(docs).columns == docs.columns


def with_extras(spark, rows):
    return spark.createDataFrame([(*r, "k", "2", 9, 1) for r in rows], CONV)


def wanted_nodes(rows):
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1])):
        if conv is not None:
            own[conv].append((role or "", text or ""))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = (own.get(c - c % 100, [])[:h] if c % 100 or c in own else []) + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(path[:-1] for path in members if path)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(path))))
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        leaves = sum(not children[p] for p in below)
        up = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), up, len(convs), children[path], leaves, saved, sha(ends)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,choices", [(1, 2), (2, 1), (3, 6)])
def test_prefix_nodes(spark, monkeypatch, seed, choices):
    monkeypatch.setattr(prefix_trie, "CONTAINER", 3)
    monkeypatch.setattr(prefix_trie, "_PIECE_BYTES", 8)
    rng = random.Random(seed)
    rows = [
        (c, t if rng.random() < 0.95 else None, "user" if t % 2 == 0 else None, rng.choice([None, "ab", "é" * 7, "x\ny"][:choices] + ["z"]))
        for c in range(340)
        if c not in (100, 217)
        for t in range(rng.randint(1, 8))
    ]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    rows += [(901, 0, "user", "own head is absent"), (None, 0, "user", "no conversation")]
    rows += [(c, t, "user", "deep") for c in (950, 951) for t in range(700)]
    rng.shuffle(rows)
    got = sorted(map(tuple, prefix_nodes(with_extras(spark, rows)).collect()), key=repr)
    assert got == wanted_nodes(rows)


def test_prefix_nodes_empty(spark):
    assert prefix_nodes(with_extras(spark, [])).count() == 0


def test_burst_trie_holds_no_container_above_its_limit():
    rng = random.Random(5)
    rows = {tuple(rng.choices(range(3), k=rng.randint(0, 9))) for _ in range(2000)}
    trie = BurstTrie([1] * 3, limit=10)
    for i, turns in enumerate(sorted(rows, key=hash)):
        trie.insert((turns, i, 1, ""))
    open_heads, seen = [trie.root], 0
    while open_heads:
        for turn, part in open_heads.pop().items():
            if isinstance(part, dict):
                open_heads.append(part)
            else:
                seen += 1 if turn < 0 else len(part)
                assert turn < 0 or len(part) <= 10
    assert seen == len(rows)
    assert len(list(trie.nodes())) == len({r[:d] for r in rows for d in range(len(r) + 1)})


def all_edits(codes):
    """Cheapest and least edits by trying every string of up to three inserts."""
    found = []

    def go(i, roles, cost, audit, inserts):
        if i == len(codes) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, audit))
        if inserts < 3:
            for r in "ua":
                go(i, roles + r, cost + 5, audit + "I", inserts + 1)
        if i < len(codes):
            more = 5 if codes[i] >= 8 else 0
            go(i + 1, roles, cost + 2, audit + "D", inserts)
            if not codes[i] & 4:
                go(i + 1, roles + "sua?"[codes[i] & 3], cost + more, audit + "K", inserts)
                for r in "ua":
                    go(i + 1, roles + r, cost + 1 + more, audit + "R", inserts)

    go(0, "", 0, "", 0)
    return min(found)


def test_cheapest_edits():
    rng = random.Random(4)
    for n in range(5):
        for _ in range(40):
            codes = bytes(rng.choice([0, 1, 2, 3, 1, 2, 5, 6, 9, 10]) for _ in range(n))
            assert cheapest_edits(codes) == all_edits(codes)
    cost, audit = cheapest_edits(bytes([1, 2] * 100_000))
    assert cost == 0 and audit == "K" * 200_000


def damage(rows):
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv, turn, "user" if kind == 4 else role, text)
        yield from [] if kind == 0 else [row, row] if kind == 3 else [row]


def wanted_report(rows):
    rest = {c: [] for c, *_ in rows}
    for conv, *row in damage(rows):
        rest[conv].append(row)
    out = []
    for conv, held in rest.items():
        held.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen, codes = Counter(), set(), []
        for _, role, text in held:
            solid = text.strip(" \t\n\r\x0b\x0c")
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            codes.append("sua".find(role[:1] or "?") % 4 + (4 if fault in ("blank", "duplicate") else 8 if fault else 0))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, audit = cheapest_edits(bytes(codes))
        turns = [r[0] for r in held if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        lines, left = [], iter(held)
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[1:]
            if edit in "IR":
                role = "assistant" if lines and lines[-1].startswith("u") else "user"
            if edit != "D":
                lines.append(f"{role}:{text}".replace("\n", "\r"))
        digest = sha("\n".join(line.replace("\r", "\n") for line in lines))
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


def test_repair_report(spark):
    rng = random.Random(6)
    rows = []
    for conv in [None, -7, *range(60)]:
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["system"] if turn == 0 else ["user", "assistant", "assistant", "user", "tool", "", None])
            text = rng.choice(["Well done.", "Why? \n", "cut off", None, "", " \t\x0b", "é.", "one", "two!", "x" * 5000 + "."])
            rows.append((conv, rng.choice([turn, turn, turn * 2, None]), role, text))
    rows += [(c, 0, "user", "only.") for c in range(1000, 1040)]  # some lose their only row
    rows += [(77, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(3000)]
    rng.shuffle(rows)
    want = wanted_report(rows)
    got = sorted(map(tuple, repair_report(with_extras(spark, rows)).collect()), key=repr)
    assert got == want
    assert any(r[7] == "" and r[8] == sha("") and not any(r[1:7]) for r in got)
    turns = defaultdict(list)
    for r in sorted(repaired_turns(with_extras(spark, rows)).collect(), key=lambda r: r.place):
        turns[r.conv_id].append(r.role + ":" + r.text)
    assert {r[0]: r[8] for r in got} == {r[0]: sha("\n".join(turns[r[0]])) for r in got}


def test_repair_empty(spark):
    assert repair_report(with_extras(spark, [])).count() == 0
    assert damaged(with_extras(spark, [])).count() == 0
