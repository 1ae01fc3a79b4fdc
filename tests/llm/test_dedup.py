"""Exact dedup, substring dedup and the Jaccard join."""

from __future__ import annotations

import random

import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardloom.llm import exact_dedup, jaccard_join, substring_dedup


def by_id(frame, *columns):
    return {r[0]: tuple(r[1:]) for r in frame.select("id", *columns).collect()}


def kept_sha(frame):
    return frame.withColumn("kept", F.sha2("kept", 256))


def words(rng, n, kinds=40):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


@pytest.fixture(scope="module")
def crafted():
    """Copies, near copies with edits at many places, shared passages at many offsets, loops of one word."""
    rng = random.Random(5)
    docs = []
    base = words(rng, 300, 2000)
    passage = words(rng, 70, 2000)
    for i in range(40):
        own = list(base)
        for _ in range(i % 7):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        docs.append(own)
    for i in range(30):
        docs.append(words(rng, rng.randrange(60), 3000) + passage[i % 12:] + words(rng, rng.randrange(60), 3000))
    docs += [base[:100], base[40:140], base + passage, passage[:49], passage[:50], ["loop"] * 120, ["loop"] * 51, ["loop"] * 49, ["a", "b"] * 60]
    docs += [words(rng, n, 3) for n in (0, 1, 2, 3, 49, 50, 51, 200)]
    rng.shuffle(docs)
    return [(i, " ".join(w)) for i, w in enumerate(docs)]


def test_exact_query(run, documents):
    assert run("op2_exact_dedup", "doc_id", "keep_id", "group_size", "kept", "text_sha256") == plain.exact(documents)


def test_exact_odd_rows(make, odd):
    assert by_id(exact_dedup.exact_groups(make(odd)), "keep_id", "group_size", "kept", "text_sha256") == plain.exact(odd)
    stay = exact_dedup.drop_copies(make(odd))
    assert sorted(r.doc_id for r in stay.collect()) == sorted(d for d, x in plain.exact(odd).items() if x[2])
    assert stay.columns == make(odd).columns
    assert exact_dedup.exact_groups(make([])).count() == exact_dedup.drop_copies(make([])).count() == 0


def test_exact_repeated_rows_and_null_ids(make):
    rows = [(1, "t"), (1, "t"), (None, "t"), (None, "u"), (None, "u"), (2, "other"), (2, "t")]
    got = sorted(map(str, exact_dedup.exact_groups(make(rows)).select("id", "keep_id", "group_size", "kept").collect()))
    assert got == sorted([*["Row(id=1, keep_id=2, group_size=4, kept=False)"] * 2, "Row(id=None, keep_id=2, group_size=4, kept=False)",
                          *["Row(id=None, keep_id=None, group_size=2, kept=True)"] * 2, "Row(id=2, keep_id=2, group_size=1, kept=True)",
                          "Row(id=2, keep_id=2, group_size=4, kept=True)"])


def test_exact_compares_texts_where_digests_meet(make, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda column, bits: F.lit("00" * 32))
    got = by_id(exact_dedup.exact_groups(make([(1, "a"), (2, "A"), (3, "b")])), "keep_id", "group_size", "kept")
    assert got == {1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True)}


def test_substring_query(run, documents):
    assert run("op5_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == plain.repeats(documents)


def test_substring_crafted(make, crafted, odd):
    for docs in (crafted, odd):
        assert by_id(kept_sha(substring_dedup.without_repeats(make(docs))), "n_words", "n_removed", "kept") == plain.repeats(docs)
    assert substring_dedup.without_repeats(make([])).count() == 0


@pytest.mark.parametrize("span, kmer", [(5, 2), (6, 6), (9, 1)])
def test_substring_other_sizes(make, span, kmer):
    rng = random.Random(span)
    docs = [(i, " ".join(words(rng, rng.randrange(80), 4))) for i in range(60)]
    assert by_id(kept_sha(substring_dedup.without_repeats(make(docs), span=span, kmer=kmer)), "n_words", "n_removed", "kept") == plain.repeats(docs, span)


def test_substring_repeated_and_null_ids(make):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (3, text), (3, text + " more"), (None, text), (5, text)]
    got = substring_dedup.without_repeats(make(rows)).select("id", "n_removed").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(3, 0), (3, 0), (3, 0), (None, 0), (5, 60)], key=str)


def test_jaccard_query(run, documents):
    assert run("op10_jaccard_join", "doc_id", "n_shingles", "component_id") == plain.linked(documents)


@pytest.mark.parametrize("shingle, percent", [(3, 90), (5, 80), (1, 60), (2, 100)])
def test_jaccard_crafted(make, crafted, shingle, percent):
    got = by_id(jaccard_join.near_components(make(crafted), shingle=shingle, percent=percent), "n_shingles", "component_id")
    assert got == plain.linked(crafted, shingle, percent)


def test_jaccard_chain(make):
    """Each text links with the next only; nothing may be lost on the way through one component."""
    docs = [(i, " ".join(f"w{j}" for j in range(i * 2, i * 2 + 60))) for i in range(40)]
    got = by_id(jaccard_join.near_components(make(docs)), "n_shingles", "component_id")
    assert got == plain.linked(docs)
    assert {c for _, c in got.values()} == {0}


def test_jaccard_pairs_do_not_grow_with_the_square_of_a_group(make, monkeypatch):
    """Short rows that are the centres of all blocks do not leave every pair of near copies to be compared."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    docs = [(1000 + i, " ".join(base[i:i + 5])) for i in range(116)]
    for i in range(300):
        words = list(base)
        words[rng.randrange(120)] = f"e{i}"
        docs.append((i, " ".join(words)))
    made, first = {}, jaccard_join.stored

    def stored(frame, folder, name):
        if name == "wide":
            frame = frame.withColumn("cid", F.when(F.col("low_id") >= 1000, -F.col("low_id")).otherwise(F.col("cid")))
        out = first(frame, folder, name)
        if name.endswith("-pairs"):
            made[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    got = by_id(jaccard_join.near_components(make(docs), shingle=5, percent=80), "n_shingles", "component_id")
    assert all(x[1] == (d if d >= 1000 else 0) for d, x in got.items())
    assert sum(made.values()) < 25 * len(docs)


def test_near_copies_of_which_not_all_link_cost_few_pairs(make, monkeypatch):
    """One centre or two link too few of the rows to leave only a few for the comparison across components."""
    rng = random.Random(5)
    docs = []
    for i in range(400):
        own = [f"w{j}" for j in range(400)]
        for j in rng.sample(range(400), rng.randint(3, 6)):
            own[j] = f"e{i}.{j}"
        docs.append((i, " ".join(own)))
    made, first = {}, jaccard_join.stored

    def stored(frame, folder, name):
        out = first(frame, folder, name)
        if name.endswith(("-pairs", "-links")):
            made[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    got = by_id(jaccard_join.near_components(make(docs), shingle=5, percent=80), "n_shingles", "component_id")
    assert got == plain.linked(docs, 5, 80) == {i: (396, 0) for i, _ in docs}
    assert sum(made.values()) < 25 * len(docs)


def test_rows_of_two_components_meet_once(make, monkeypatch):
    """Rows that are near, yet not near enough, share many blocks and are a pair in one of them."""
    places = random.Random(5).sample(range(2, 300, 5), 60)
    docs = []
    for i in range(15):
        own = [f"w{j}" for j in range(300)]
        for j in places[4 * i:4 * i + 4]:
            own[j] = f"e{i}.{j}"
        docs.append((i, " ".join(own)))
    made, first = [], jaccard_join._met_once

    def met(open_blocks, percent):
        pairs = first(open_blocks, percent)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(jaccard_join, "_met_once", met)
    got = by_id(jaccard_join.near_components(make(docs), shingle=5, percent=80), "n_shingles", "component_id")
    assert got == plain.linked(docs, 5, 80)
    (rows, different), = made
    assert 50 < different <= rows <= 1.2 * different


def test_stars_need_one_step(spark, tmp_path, monkeypatch):
    """What one step has made stars of is not stepped through again."""
    steps, first = [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda frame, folder, name: steps.append(name) or first(frame, folder, name))
    ends = lambda links: {tuple(r) for r in jaccard_join.components(spark.createDataFrame(links, "u long, v long"), str(tmp_path / "s")).collect()}
    assert ends([(i, 0) for i in range(1, 9)]) == {(i, 0) for i in range(1, 9)} and steps == ["star0"]
    assert ends([]) == set() and steps == ["star0"] * 2
    assert ends([(i, i + 1) for i in range(40)] + [(50, 60), (60, 55)]) == {(i, 0) for i in range(1, 41)} | {(55, 50), (60, 50)}


def test_grams_of_a_batch_are_those_of_each_text():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["A", "b", "É", "cc", "\t", "\x0b", "\u2003"]) for _ in range(rng.randrange(9))) for _ in range(300)] + ["", " ", "one"]
    low = [t.translate({c: c + 32 for c in range(65, 91)}) for t in texts]
    for size in (1, 2, 3, 9):
        alone = jaccard_join.Shingles(size)
        found = [sorted(set(codes[a:b].tolist())) for places, codes in jaccard_join._grams(pa.array(texts), size) for a, b in zip(places, places[1:])]
        assert found == [alone(t).tolist() for t in low]


def test_jaccard_lowers_texts_in_workers(make, odd, monkeypatch):
    """In the plan each letter of a text with others than ASCII ones is looked up by itself: only compared texts bear that."""
    plans, first = {}, jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda frame, folder, name: plans.update({name: frame._jdf.queryExecution().analyzed().toString()}) or first(frame, folder, name))
    jaccard_join.near_components(make(odd)).count()
    assert "translate" not in plans["heads"]
    assert "Join" not in plans["star-texts"].split("translate")[0] and "Join" in plans["star-texts"]


def test_jaccard_odd_rows(make, odd):
    assert by_id(jaccard_join.near_components(make(odd)), "n_shingles", "component_id") == plain.linked(odd)
    assert jaccard_join.near_components(make([])).count() == 0
    stay = jaccard_join.drop_near_copies(make([*odd, (None, "one"), (None, None), (4, "Same text Here")]))
    left = {d for d, x in plain.linked(odd, 5, 80).items() if x[1] == d}
    assert sorted((r.doc_id or 0 for r in stay.collect())) == sorted([*left, 0, 0])


def test_stages_keep_one_of_repeated_rows(make):
    """Rows that repeat id and text, and rows without an id, in both stages of the pipeline."""
    text = "a b c d e f g h i j k l m n o p q r s t"
    rows = [(1, text), (1, text), (2, text), (2, text), (2, text), (3, "other"), (3, "other"), (3, "third"), (None, "x"), (None, "x"), (None, "y"), (5, None), (5, "")]
    ids = lambda frame: sorted(((r.doc_id, r.text or "") for r in frame.collect()), key=str)
    want = sorted([(2, text), (3, "other"), (3, "third"), (None, "x"), (None, "y"), (5, "")], key=str)
    exact = exact_dedup.drop_copies(make(rows))
    assert ids(exact) == want and exact.columns == make(rows).columns
    near = jaccard_join.drop_near_copies(make(rows))
    assert ids(near) == sorted([(1, text), *[w for w in want if w[1] != text]], key=str)
    assert near.columns == make(rows).columns
    assert exact_dedup.drop_copies(make([(7, "z"), (8, "w")])).count() == jaccard_join.drop_near_copies(make([(7, "z"), (8, "w")])).count() == 2
