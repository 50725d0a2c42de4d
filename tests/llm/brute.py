"""Plain versions of the operators, over lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _marked(items, width):
    """For each sequence, which places a window that occurs again covers."""
    seen = Counter(t[i : i + width] for t in items for i in range(len(t) - width + 1))
    out = []
    for t in items:
        mark = [False] * len(t)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                mark[i : i + width] = [True] * width
        out.append(mark)
    return out


def byte_repeats(docs, length=200):
    texts = [(t or "").encode() for _, t in docs]
    out = []
    for (d, _), t, mark in zip(docs, texts, _marked(texts, length), strict=True):
        runs = "".join("x" if m else " " for m in mark).split()
        out.append((d, len(t), sum(mark), len(runs), sha(bytes(b for b, m in zip(t, mark, strict=True) if not m))))
    return out


def word_repeats(docs, width=35):
    texts = [tuple((t or "").encode().split()) for _, t in docs]
    out = []
    for (d, _), t, mark in zip(docs, texts, _marked(texts, width), strict=True):
        out.append((d, len(t), sum(mark), sha(b" ".join(w for w, m in zip(t, mark, strict=True) if not m))))
    return out


def near_duplicates(docs, width=5, percent=80):
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        whole = [tuple(w)] if w else []
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) or frozenset(whole))
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            holders[g].append(k)
    pairs = Counter((a, b) for held in holders.values() for i, b in enumerate(held) for a in held[:i])
    for (a, b), n in pairs.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    least = {}
    for k, (d, _) in enumerate(docs):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    return [(d, len(sets[k]), least.get(find(k))) for k, (d, _) in enumerate(docs)]


def benchmark_hits(docs, items, width=10):
    rx = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = defaultdict(set)
    for name, text in items:
        w = rx.findall((text or "").encode().lower())
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(str(name))
    sizes = sorted({len(k) for k in windows})
    out = []
    for d, text in docs:
        w = rx.findall((text or "").encode().lower())
        mark, found = [False] * len(w), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if names := windows.get(tuple(w[i : i + n])):
                    mark[i : i + n] = [True] * n
                    found |= names
        out.append((d, len(w), sum(mark), len(found), sha(",".join(sorted(found)).encode())))
    return out


def hard_negatives(rows, positives=5, negatives=10, every=100):
    """``rows`` are (id, label, vector of floats); rows that take no part are to be left out before."""
    import math

    def clip(x):
        return max(-(2**63) + 1, min(2**63 - 1, x))

    whole = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows]
    out = []
    for k, (a, label, v) in enumerate(whole):
        if a % every:
            continue
        scored = sorted((-clip(sum(x * y for x, y in zip(v, w, strict=False))), i, other) for n, (i, other, w) in enumerate(whole) if n != k)
        for p, i, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [(n, j) for n, j, other in scored if other != label and 30 * -p <= 100 * -n <= 90 * -p][:negatives]
            out += [(a, i, rank, j, -p, -n) for rank, (n, j) in enumerate(fits, 1)]
    return out


def alignment(docs, a_encode, a_bytes, b_encode, b_bytes):
    """Per document the counts and the text of its groups, by sets of ends."""
    read = []
    for d, t in docs:
        a, b = (a_encode(" " + t), b_encode(t)) if t else ([], [])
        whole = (" " + t).encode() if t else b""
        if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            a, b = [], []
        ends = []
        for ids, of in ((a, a_bytes), (b, b_bytes)):
            at, places = 0, {}
            for i in ids:
                at += len(of(i))
                places[at] = i
            ends.append(places)
        read.append((d, a, b, *ends))
    links = [[(x[e], y[e]) for e in sorted(x.keys() & y.keys())] for *_, x, y in read]
    counts = Counter(p for found in links for p in found)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for (d, a, b, x, y), found in zip(read, links, strict=True):
        groups, sides = [], ([], [])
        for e in sorted(x.keys() | y.keys()):
            for s, side in zip((x, y), sides, strict=True):
                side += [str(s[e])] if e in s else []
            if e in x and e in y:
                groups.append("|".join(",".join(side) for side in sides))
                sides = ([], [])
        best = sum(counts[p] == highest[p[1]] for p in found)
        out.append((d, len(a), len(b), len(groups), len(found), best, sum(counts[p] for p in found), ";".join(groups)))
    return out
