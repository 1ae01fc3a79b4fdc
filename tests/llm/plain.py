"""Brute-force versions of the operators, on lists of (id, text)."""

import collections
import hashlib
import math
import re
import zlib

UPPER = {i: i + 32 for i in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def low(text):
    return (text or "").translate(UPPER)


def exact(docs):
    groups = collections.defaultdict(list)
    for d, t in docs:
        groups[low(t)].append(d)
    return {d: (max(groups[low(t)]), len(groups[low(t)]), d == max(groups[low(t)]), sha(low(t))) for d, t in docs}


def leaks(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    windows = collections.defaultdict(lambda: collections.defaultdict(set))
    for i, t in items:
        w = words(t)
        size = min(10, len(w))
        for s in range(len(w) - size + 1 if w else 0):
            windows[size][tuple(w[s:s + size])].add(str(i))
    out = {}
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for size, known in windows.items():
            for s in range(len(w) - size + 1):
                if (k := tuple(w[s:s + size])) in known:
                    hit.update(range(s, s + size))
                    found |= known[k]
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def secrets(docs):
    letters = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    names = "|".join(map(letters, ("password", "passwd", "secret", "token"))) + "|" + letters("api") + "_?" + letters("key")
    rules = [("assign", f"({names})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
             ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)]
    out = {}
    for d, t in docs:
        found, n = [], [0, 0, 0]
        for k, (kind, pattern, group, least) in enumerate(rules):
            for m in re.finditer(pattern, t or ""):
                if len(m[group]) >= least:
                    found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
                    n[k] += 1
        listed = ",".join(x[2] for x in sorted(found))
        out[d] = (*n, sha(listed), listed)
    return out


def repeats(docs, span=50):
    first, split = {}, {d: (t or "").encode().split() for d, t in docs}
    for d, w in split.items():
        for s in range(len(w) - span + 1):
            k = tuple(w[s:s + span])
            first[k] = min(d, first.get(k, d))
    out = {}
    for d, w in split.items():
        gone = set()
        for s in range(len(w) - span + 1):
            if first[tuple(w[s:s + span])] < d:
                gone.update(range(s, s + span))
        out[d] = (len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def linked(docs, size=3, percent=90):
    sets = {}
    for d, t in docs:
        w = low(t).encode().split()
        sets[d] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    where = collections.defaultdict(list)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d in sorted(sets):
        shared = collections.Counter(e for g in sets[d] for e in where[g])
        for e, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                root[b] = a
        for g in sets[d]:
            where[g].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def base_scores(docs):
    words = lambda t: [*low(t).encode().split(), None]
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    c = collections.Counter(w for d, t in docs if not held(d) for w in words(t))
    n, v = sum(c.values()), len(c)
    return {d: (held(d), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t))) for d, t in docs}
