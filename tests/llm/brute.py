"""Plain Python versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re

BLANK = re.compile("[^\x20\x09-\x0D]+")
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring_dedup(docs, window=50):
    """(doc_id, n_words, n_removed, kept_sha256) for rows of (doc_id, text)."""
    order = lambda i: (i is None, i or 0)
    words = [(i, BLANK.findall(t or "")) for i, t in docs]
    low = {}
    for i, w in words:
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            if key not in low or order(i) < order(low[key]):
                low[key] = i
    out = []
    for i, w in words:
        gone = set()
        for at in range(len(w) - window + 1):
            if order(low[tuple(w[at : at + window])]) < order(i):
                gone.update(range(at, at + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), sha(" ".join(kept))))
    return out


def shingles(text, width=4):
    w = BLANK.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def near_duplicates(docs, width=4, percent=80):
    """doc_id -> (n_shingles, component); doc_ids are different."""
    sets = {i: shingles(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in sets.items():
        common = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def contamination(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = NORMAL.findall((text or "").translate(LOWER))
        for at in range(max(len(w) - n + 1, 1) if w else 0):
            windows.setdefault(tuple(w[at : at + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w = NORMAL.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for length in lengths:
            for at in range(len(w) - length + 1):
                held = windows.get(tuple(w[at : at + length]))
                if held:
                    found |= held
                    hit.update(range(at, at + length))
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out
