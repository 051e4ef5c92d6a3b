"""Brute-force versions of the operators, over lists of rows: (doc_id, text, source)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def base_counts(text):
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), failed


def suffix_dedup(texts, window=200):
    """[(n_bytes, n_removed, n_spans, sha256 of the kept bytes)]"""
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + window] for b in data for i in range(len(b) - window + 1))
    out = []
    for b in data:
        cover = [False] * len(b)
        for i in range(len(b) - window + 1):
            if count[b[i:i + window]] > 1:
                cover[i:i + window] = [True] * window
        spans = sum(c and (i == 0 or not cover[i - 1]) for i, c in enumerate(cover))
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out.append((len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text):
    w = lower(text or "").encode().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, fps, bits=2):
    """Smallest id reachable from each row; null ids last."""
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    best = {}
    for i, d in enumerate(ids):
        r = find(i)
        known = [x for x in (best.get(r), d) if x is not None]
        best[r] = min(known) if known else None
    return [best[find(i)] for i in range(len(ids))]


def exact(rows):
    """{text: (keep id, group size)}; null ids lowest."""
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    return {t: (max((x for x in g if x is not None), default=None), len(g)) for t, g in groups.items()}


def mix_targets(rows, weights=(1, 2, 3), cap=3):
    """{source: (size, target)} by resharing the excess until none is above its cap."""
    size = Counter()
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + ([None] if None in size else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:
        rest = total - sum(cap * size[s] for s in capped)
        ww = sum(w[s] for s in names if s not in capped)
        t = {s: cap * size[s] if s in capped else rest * w[s] / ww for s in names}
        over = {s for s in names if s not in capped and t[s] > cap * size[s]}
        if not over:
            return {s: (size[s], t[s]) for s in names}
        capped |= over


def license_places(text, phrases):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    found = [(label, i) for label, p in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    return len(w), found


def best_fit(pieces, capacity, max_per_source):
    """Plain search over all bins: tightest compatible, lowest number of equals."""
    bins = []
    out = []
    for size, cluster, source in pieces:
        fits = [(b[0], i) for i, b in enumerate(bins)
                if b[0] >= size and cluster not in b[1] and b[2][source] < max_per_source]
        if not fits:
            bins.append([capacity, set(), Counter()])
        i = min(fits)[1] if fits else len(bins) - 1
        bins[i][0] -= size
        bins[i][1].add(cluster)
        bins[i][2][source] += 1
        out.append(i)
    return out
