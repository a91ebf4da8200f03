"""Plain versions the operators are held against."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
FOLDER = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size):
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(*(w[k:] for k in range(size))))


def smallest_reachable(ids, links):
    """{id: smallest id reachable} by plain union."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_copies(texts, size, share=80, of=100):
    """{id: smallest id reachable over links of shingle sets} for {id: text}."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    links = []
    for i, s in sets.items():
        for j in {j for x in s for j in holders[x] if j > i}:
            both = len(s & sets[j])
            if of * both >= share * (len(s) + len(sets[j]) - both):
                links.append((i, j))
    return smallest_reachable(texts, links), {i: len(s) for i, s in sets.items()}
