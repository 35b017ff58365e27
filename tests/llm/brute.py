"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BIG = 1 << 63


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def line_dedup(docs, most=10):
    out, held, every = [], defaultdict(int), []
    for _, text in docs:
        lines = (text or "").split("\n")
        keys = [x.strip("\x20\t\n\x0b\x0c\r").translate(LOWER) for x in lines]
        every.append((lines, keys))
        for k in set(keys):
            held[k] += 1
    for (i, _), (lines, keys) in zip(docs, every):
        kept = [x for x, k in zip(lines, keys) if not (k and held[k] >= most)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def exact(docs):
    groups = defaultdict(list)
    for i, text in docs:
        groups[(text or "").translate(LOWER)].append(i)
    return [(i, max(g), len(g), i == max(g), sha(t)) for t, g in groups.items() for i in g]


def substring(docs, n=50):
    least, out = {}, []
    words = [PLAIN.findall(t or "") for _, t in docs]
    for (i, _), w in zip(docs, words):
        for p in range(len(w) - n + 1):
            k = tuple(w[p : p + n])
            least[k] = min(least.get(k, BIG), BIG - 1 if i is None else i)
    for (i, _), w in zip(docs, words):
        gone = set()
        for p in range(len(w) - n + 1):
            if least[tuple(w[p : p + n])] < (BIG - 1 if i is None else i):
                gone.update(range(p, p + n))
        out.append((i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return out


def suffixes(docs, n=400):
    seen, out = defaultdict(int), []
    raw = [(t or "").encode() for _, t in docs]
    for b in raw:
        for p in range(len(b) - n + 1):
            seen[b[p : p + n]] += 1
    for (i, _), b in zip(docs, raw):
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if seen[b[p : p + n]] > 1:
                gone[p : p + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = len([1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1])])
        out.append((i, len(b), sum(gone), runs, sha(kept)))
    return out


def shingles(text, n=3):
    w = PLAIN.findall((text or "").translate(LOWER))
    return {tuple(w[p : p + n]) for p in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def near(docs, percent=90, n=3):
    sets = [shingles(t, n) for _, t in docs]
    up = list(range(len(docs)))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        least[top(k)] = min(least.get(top(k), BIG), BIG - 1 if i is None else i)
    return [(i, len(sets[k]), None if least[top(k)] == BIG - 1 else least[top(k)]) for k, (i, _) in enumerate(docs)]


def contamination(docs, items, n=13):
    at = defaultdict(set)
    for item, text in items:
        w = ITEM.findall((text or "").translate(LOWER))
        for p in range(len(w) - n + 1) if len(w) >= n else range(1 if w else 0):
            at[tuple(w[p : p + n])].add(item)
    sizes = sorted({len(k) for k in at})
    out = []
    for i, text in docs:
        w, hit, found = ITEM.findall((text or "").translate(LOWER)), set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                if items_at := at.get(tuple(w[p : p + size])):
                    found |= items_at
                    hit.update(range(p, p + size))
        names = sorted(str(x) for x in found)
        out.append((i, len(w), len(hit), len(names), sha(",".join(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return out
