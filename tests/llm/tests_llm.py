"""Helpers shared by the tests of the corpus operators."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Union:
    """Smallest member of every class of joined things."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, size=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def ngram_groups(rows, percent=80):
    """{doc_id: (set size, smallest linked id)} of (doc_id, text) rows, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    union, holders = Union(), defaultdict(list)
    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                union.join(i, j)
    return {i: (len(s), union.find(i)) for i, s in sets.items()}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def kept_lines(rows, edits=2, per=12):
    """{doc_id: text less repeated lines} of (doc_id, text) rows with distinct ids, by comparing all pairs."""
    places = [
        (i, n, line)
        for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0]))
        if t is not None
        for n, line in enumerate(t.split("\n"))
        if line.strip(" \t\n\r\x0b\x0c")
    ]
    lines = sorted({p[2] for p in places})
    union = Union()
    for i, a in enumerate(lines):
        for b in lines[:i]:
            most = min(edits, min(len(a), len(b)) // per)
            if most and abs(len(a) - len(b)) <= most and edit_distance(a, b) <= most:
                union.join(a, b)
    seen, gone = set(), defaultdict(set)
    for i, n, line in places:
        root = union.find(line)
        if root in seen:
            gone[i].add(n)
        seen.add(root)
    return {
        i: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t in rows
    }
