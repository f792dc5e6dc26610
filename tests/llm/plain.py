"""Brute-force versions that the operators are held against."""

import hashlib
from collections import defaultdict

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def near_classes(docs, n, percent=80):
    """doc_id to (set size, component, kept), by comparing all pairs that
    share a shingle."""
    sets = {}
    for i, text in docs.items():
        w = words(text, True)
        sets[i] = {tuple(w[j:j + n]) for j in range(max(1, len(w) - n + 1))} if w else set()
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        both = defaultdict(int)
        for g in sets[i]:
            for j in holders[g]:
                both[j] += 1
            holders[g].append(i)
        for j, c in both.items():
            if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


def without_repeats(docs, width):
    """doc_id to (words, removed, kept words)."""
    split = {i: words(t) for i, t in docs.items()}
    first = {}
    for i in sorted(split):
        for j in range(len(split[i]) - width + 1):
            first.setdefault(tuple(split[i][j:j + width]), i)
    out = {}
    for i, w in split.items():
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if first[tuple(w[j:j + width])] < i:
                gone[j:j + width] = [True] * width
        out[i] = (len(w), sum(gone), [x for x, g in zip(w, gone) if not g])
    return out


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


#: Words for odd texts: long, empty, repeated, not ASCII.
ODD_TEXTS = [None, "", "   \n", "one", "Ünï cödé 漢字", "a " * 5000, "x" * 20000, "Same text, twice over and over again.",
             "Same text, twice over and over again.", " \x1f\x85 odd spaces"]
