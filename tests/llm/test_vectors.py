"""Vector codes against Lloyd rounds in plain integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from cardloom.llm import vector_codes


def by_hand(rows, parts=4, entries=256, rounds=4):
    """[(id, codes, error, label_error)] and codebooks from (id, vector, label)."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], [[] for _ in range(parts)]
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, 0 if r[0] is None else r[0], r[1]))[:entries]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((apart(x, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for _, v, _ in kept:
                members[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else old for m, old in zip(members, books[p])]
    out, by_label = [], {}
    for i, v, label in kept:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, [e for _, e in best], sum(d for d, _ in best), label))
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    long = lambda x: x if x < 1 << 63 else None
    return sorted(((i, c, long(e), long(by_label[label])) for i, c, e, label in out), key=repr), books


def table(spark, rows):
    full = [(*r, "z", "z", "z", "z") for r in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, id string, vector string, codes string, of string").repartition(3)


def found(spark, rows, **kw):
    frame, books = vector_codes.compress(table(spark, rows), **kw)
    return sorted(((r.id, list(r.codes), r.error, r.label_error) for r in frame.collect()), key=repr), books


def f32(*xs):
    return [float(np.float32(x)) for x in xs]


def vectors(rng, n, dim, spread=1.0, levels=None):
    one = lambda: rng.choice(levels) if levels else rng.gauss(0, spread)
    return [(i, f32(*[one() for _ in range(dim)]), rng.choice([None, 0, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("case", ["plain", "ties", "wide", "few", "clusters"])
def test_rounds(spark, case):
    rng = random.Random(case)
    rows, kw = {
        "plain": (vectors(rng, 500, 8), dict(entries=20)),
        "ties": (vectors(rng, 400, 8, levels=[0.0, 0.5, 1.0]), dict(entries=33)),
        "wide": (vectors(rng, 60, 8, 1e6) + vectors(rng, 60, 8), dict(entries=9)),
        "few": (vectors(rng, 30, 12), {}),
        "clusters": ([(i, f32(*[100 * (i % 7) + rng.random() for _ in range(4)]), i % 3) for i in range(900)], dict(entries=16)),
    }[case]
    assert found(spark, rows, **kw) == by_hand(rows, **kw)


def test_odd_rows(spark):
    rng = random.Random(1)
    nan, inf = float("nan"), float("inf")
    rows = vectors(rng, 40, 8) + [(100, None, 1), (101, [None] * 8, 1), (102, f32(*[1] * 7) + [nan], 1), (103, f32(*[1] * 7) + [-inf], 2),
                                  (None, f32(*range(8)), None), (None, f32(*range(8)), None), (3, f32(*[9] * 8), 1), (3, f32(*[2] * 8), 1),
                                  (104, f32(1, 2, 3), 0), (105, [], 0), (106, f32(*[-0.0001] * 8), 5)]
    for entries in (4, 5, 256):
        assert found(spark, rows, entries=entries) == by_hand(rows, entries=entries)
    # uneven parts are filled up with zeros
    uneven = [(i, v[:7], label) for i, v, label in vectors(rng, 50, 8)]
    assert found(spark, uneven, entries=6) == by_hand(uneven, entries=6)


def test_empty(spark):
    for rows in ([], [(1, None, 1)], [(1, [float("nan")], 1)]):
        assert found(spark, rows) == ([], [[], [], [], []])


def test_first_vectors_of_many_blocks(spark, monkeypatch):
    """More blocks than entries: only those with the smallest ids are read."""
    monkeypatch.setattr(vector_codes, "_BLOCK_BYTES", 1)
    rng = random.Random(4)
    rows = vectors(rng, 1500, 4)
    rng.shuffle(rows)
    kw = dict(entries=5, rounds=1)
    assert found(spark, rows, **kw) == by_hand(rows, **kw)


def test_walk_prunes_and_ties():
    """Whole nodes go to one entry; equal entries go to the first."""
    rng = np.random.default_rng(0)
    for dtype in (np.int64, object):
        points = np.concatenate([rng.integers(0, 50, (300, 3)) + 10000 * c for c in range(5)]).astype(dtype)
        entries = np.array([[10025] * 3, [25] * 3, [25] * 3, [40025] * 3, [20000, 20025, 20050], [30000] * 3], dtype)
        order = vector_codes.tree_order(points, 32)
        codes, sums, counts = vector_codes.Walk(entries, 50000 if dtype is np.int64 else 1 << 80).assign(vector_codes.Tree(points[order], 32))
        apart = ((points[order][:, None] - entries[None]) ** 2).sum(2)
        assert codes.tolist() == np.argmin(apart, 1).tolist()
        assert counts.tolist() == np.bincount(codes, minlength=6).tolist()
        assert sums.tolist() == [[int(x) for x in points[order][codes == e].sum(0)] if (codes == e).any() else [0] * 3 for e in range(6)]


def test_query(run, duck):
    rows = duck.execute("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    want, books = by_hand(rows)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    assert run("op12_vector_codes", "vec_id", "code", "error", "label_error", "codebooks_sha256") == {
        i: ("".join(f"{c:02x}" for c in codes), e, le, sha) for i, codes, e, le in want}
