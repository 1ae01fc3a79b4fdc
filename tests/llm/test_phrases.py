"""Phrase mining against counting by hand."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cardloom.llm import phrases

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def by_hand(rows, at_least=10, words=3, contained=50, top=2000):
    """(lang, rank, phrase) -> (a, l, r, n, score) from (id, text, lang)."""
    total, f = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(_LOWER)):
            found = re.findall("[^ \t]+", piece)
            total[lang] += len(found)
            for k in range(1, words + 1):
                for i in range(len(found) - k + 1):
                    f[lang][tuple(found[i:i + k])] += 1
    out = {}
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= at_least}
        kept = []
        for p, a in candidates.items():
            if any(100 * b >= contained * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in candidates.items() if len(q) > len(p)):
                continue
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out[lang, rank, p.decode()] = (-a, left, right, total[lang], -score)
    return out


def found(frame):
    return {(r.lang, r["rank"], r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in frame.collect()}


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(3)
    names = ["Ab", "b", "ab", "ß", "É", "é", "x y", "日本", "c-d", "(e)", "f\x1f"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "! ", "\r\n", " "]
    text = lambda n: "".join(rng.choice(names) + rng.choice(ends) for _ in range(n))
    rows = [(i, text(rng.randrange(60)), rng.choice(["en", "de", None, "und", ""])) for i in range(80)]
    return rows + [(None, "new york city " * 30, "en"), (200, "new york city " * 30, "en"), (200, "new york city " * 30, "en"),
                   (201, None, "en"), (202, "", "fr"), (203, " .,;\n", None), (204, "a" * 3_000_000 + " b", "en"), (205, "q " * 40, "xx")]


def test_small_counts(make, prose):
    for kw in ({}, dict(at_least=3, contained=80), dict(at_least=2, words=4, top=5), dict(at_least=2, words=2, top=None)):
        assert found(phrases.collocations(make(prose), **kw)) == by_hand(prose, **{k: v if k != "top" or v else 10**9 for k, v in kw.items()})


def test_empty(make):
    assert phrases.collocations(make([])).count() == 0
    assert phrases.collocations(make([(1, None), (2, " , ")])).count() == 0


def test_pointers(make):
    rows = [(5, "z. one two one two", "en"), (3, "z z, one two", "en"), (9, "one two", "en")]
    r, = phrases.collocations(make(rows).coalesce(1).sort("doc_id"), at_least=3, words=2).collect()
    assert (r.phrase, r.a, r.first_doc) == ("one two", 4, 3)


def test_shared_fingerprints_are_told_apart(make, prose, monkeypatch):
    """Fingerprints and word hashes of two bits: nearly all phrases share one."""
    import sys

    blunt = lambda x: (np.asarray(x, np.uint64) % np.uint64(3)) << np.uint64(62)
    monkeypatch.setattr(sys.modules["cardloom.llm.phrases"], "mixed", blunt)
    few = prose[:60]
    assert found(phrases.collocations(make(few), at_least=4)) == by_hand(few, 4)


def test_crowded_marks(make, prose, monkeypatch):
    monkeypatch.setattr(phrases, "MARK_BITS", 1 << 8)
    assert found(phrases.collocations(make(prose[:60]), at_least=3)) == by_hand(prose[:60], 3)


def test_query(run, duck):
    rows = duck.execute("SELECT doc_id, text, lang FROM documents").fetchall()
    got = run("op13_phrases", "phrase", "lang", "rank", "a", "l", "r", "n", "score")
    want = {p: (lang, rank, *rest) for (lang, rank, p), rest in by_hand(rows).items()}
    assert len(got) > 0 and got.keys() == want.keys()


def test_words_by_bytes():
    texts = ["A b.c", "", "d  e,,f", "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    w = phrases.words_of(data, np.cumsum([0] + [len(t) for t in texts]))
    raw = w.data.tobytes()
    assert [raw[s:e].decode() for s, e in zip(w.starts, w.ends)] == ["a", "b", "c", "d", "e", "f", "x"]
    assert w.doc.tolist() == [0, 0, 0, 2, 2, 2, 3]
    assert w.follows.tolist() == [True, False, False, True, False, False, False]
