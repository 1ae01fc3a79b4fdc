"""Reading in blocks until the first empty page."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardloom.operators.paging import before_first_empty
from cardloom.operators.rules import Pick, Profile
from cardloom.plans.early import read_until_empty
from cardloom.sources.layout import shared_folder

PROFILES = [Profile("p", "p", "", "li", dict(name=(Pick(None),))), Profile("z", "z", "", shape="zip", blocks=dict(name="b", title="i"), keep=())]
COLUMNS = "source_id string, profile_id string, role string, page_no int, url string, html string"


def pages(spark, cards, profile="p"):
    """``cards``: source -> cards of its pages 1, 2, ..."""
    one = {"p": "<li>x</li>", "z": "<b>n</b><i>t</i>"}[profile]
    rows = [(s, profile, "listing", n, f"/{s}/{n}", f"<ul>{one * k}</ul>") for s, ks in cards.items() for n, k in enumerate(ks, 1)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.mark.parametrize("profile", ["p", "z"])
def test_records_and_pages_read(spark, profile):
    cards = {"a": [2] * 40, "b": [1, 2, 0, 5, 5] + [1] * 30, "c": [0] + [1] * 20, "d": [3], "e": [1] * 16 + [0] + [1] * 90, "f": [1, 1, 1, 0]}
    records, read = read_until_empty(pages(spark, cards, profile), PROFILES, shared_folder(spark))
    ends = {s: ks.index(0) if 0 in ks else len(ks) for s, ks in cards.items()}
    got = {}
    for r in records.groupBy("source_id", "page_no").count().collect():
        got.setdefault(r.source_id, {})[r.page_no] = r["count"]
    assert got == {s: {n: k for n, k in enumerate(ks[:ends[s]], 1)} for s, ks in cards.items() if ends[s]}
    upto = {r.source_id: r.n for r in read.groupBy("source_id").agg(F.max("page_no").alias("n")).collect()}
    assert upto == {"a": 40, "b": 4, "c": 4, "d": 1, "e": 64, "f": 4}


def test_as_the_filter_on_all_pages(spark):
    given = pages(spark, {f"s{i}": [(i * n) % 7 for n in range(1, 30)] for i in range(12)})
    records, _ = read_until_empty(given, PROFILES, shared_folder(spark), first=1, growth=2)
    whole, counted = read_until_empty(given, PROFILES, shared_folder(spark), first=1000)
    kept = before_first_empty(given.select("source_id", "page_no").join(counted, ["source_id", "page_no"]))
    want = kept.filter("cards > 0").select("source_id", "page_no", "cards")
    assert sorted(map(tuple, records.groupBy("source_id", "page_no").count().collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(str, records.collect())) == sorted(map(str, whole.collect()))


def test_odd_pages(spark):
    base = pages(spark, {"a": [1, 1]})
    rows = [("a", "p", "listing", None, "u", "<li>no number</li>"), ("a", "p", "detail", 1, "u", "<li>d</li>"), ("b", "other", "listing", 1, "u", "<li>o</li>"),
            ("c", "p", "listing", 1, "u", None), ("c", "p", "listing", 2, "u", "<li>behind</li>"), ("d", "p", "listing", 2, "u", "<li>x</li>"),
            ("d", "p", "listing", 2, "u", ""), ("e", "p", "listing", -3, "u", "<li>y</li>")]
    given = base.unionAll(spark.createDataFrame(rows, COLUMNS))
    records, _ = read_until_empty(given, PROFILES, shared_folder(spark))
    assert sorted((r.source_id, r.page_no) for r in records.collect()) == [("a", 1), ("a", 2), ("e", -3)]
    for none in (given.filter("false"), given.filter("page_no IS NULL")):
        records, read = read_until_empty(none, PROFILES, shared_folder(spark))
        assert records.count() == read.count() == 0 and "name" in records.columns
