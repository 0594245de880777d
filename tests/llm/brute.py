"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Forest:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def ngram_groups(docs, k=5, percent=75):
    """{id: (set size, component)} of distinct ids."""
    sets = {}
    for i, text in docs:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[i] = {tuple(words[j:j + k]) for j in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()
    forest = Forest(sets)
    holders = defaultdict(list)
    for i, found in sets.items():
        shared = defaultdict(int)
        for gram in found:
            for j in holders[gram]:
                shared[j] += 1
            holders[gram].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(found) + len(sets[j]) - n):
                forest.link(i, j)
    return {i: (len(sets[i]), forest.root(i)) for i in sets}


def passages(docs, k=13):
    """[(id, words, removed, digest of the kept words)], one per row; ids may repeat."""
    rows = [(i, WORD.findall(text or "")) for i, text in docs]
    first = {}
    for i, words in rows:
        for j in range(len(words) - k + 1):
            if i is not None:
                key = tuple(words[j:j + k])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in rows:
        gone = [False] * len(words)
        for j in range(len(words) - k + 1):
            if i is not None and first[tuple(words[j:j + k])] < i:
                gone[j:j + k] = [True] * k
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def near_vectors(rows, least=0.98):
    """{id: (links, component)} of the rows (id, vector, label)."""
    groups, links, forest = defaultdict(list), {}, Forest([r[0] for r in rows])
    for i, vector, label in rows:
        links[i] = 0
        if vector is None or label is None or any(x is None for x in vector):
            continue
        x = np.array(vector, float)
        if len(x) and np.isfinite(x).all() and x.any():
            groups[label, len(x)].append((i, x / np.linalg.norm(x)))
    for found in groups.values():
        unit = np.array([x for _, x in found])
        near = unit @ unit.T >= least
        for a, b in zip(*np.nonzero(np.triu(near, 1))):
            a, b = found[a][0], found[b][0]
            links[a] += 1
            links[b] += 1
            forest.link(a, b)
    return {i: (links[i], forest.root(i)) for i in links}
