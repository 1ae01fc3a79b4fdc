"""Chains of next links against following them one by one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cardloom.operators.chains import chain_report, follow_links
from cardloom.operators.markup import parse_pages
from cardloom.operators.paging import next_number
from cardloom.operators.rules import Paging
from cardloom.sources.layout import shared_folder


def by_hand(links):
    """(source, page) -> (next, stored_next, steps, reached, cycle)."""
    pages = {}
    for s, p, n in links:
        if p is not None:
            known = pages.setdefault(s, {})
            known[p] = min((x for x in (known.get(p), n) if x is not None), default=None)
    out = {}
    for s, following in pages.items():
        steps, at = {}, 1
        while at in following and at not in steps:
            steps[at] = len(steps)
            at = following[at]
        for p, n in following.items():
            path, at = [], following[p]
            while at in following and at not in path and at != p:
                path.append(at)
                at = following[at]
            cycle = min([p, *path]) if at == p else None
            out[s, p] = (n, None if n is None else n in following, steps.get(p), p in steps, cycle)
    return out


def found(spark, links):
    frame = spark.createDataFrame(links, "source_id string, page_no int, next_page long").repartition(3)
    return {(r.source_id, r.page_no): tuple(r)[2:] for r in follow_links(frame, shared_folder(spark)).collect()}


CASES = {
    "chain": [("a", p, p + 1 if p < 40 else None) for p in range(1, 41)],
    "ring": [("a", p, p % 33 + 1) for p in range(1, 34)] + [("b", 1, 1), ("c", 2, 2), ("c", 1, None)],
    "shapes": [("a", 1, 2), ("a", 2, 3), ("a", 3, 2), ("a", 9, 3), ("a", 7, 9), ("b", 1, 5), ("b", 6, 6), ("d", 5, 6), ("d", 6, 7), ("d", 7, 5),
               ("e", 1, 2), ("e", 1, 3), ("e", 3, None), ("e", 2, None), ("e", 1, 2), ("e", None, 4), ("f", -1, 1), ("f", 1, -1)],
    "empty": [],
}


@pytest.mark.parametrize("case", [*CASES, "random"])
def test_chains(spark, case):
    rng = random.Random(8)
    links = CASES.get(case, [(f"s{s}", p, rng.choice([None, rng.randrange(1, 60), p + 1])) for s in range(20) for p in range(1, 50)])
    assert found(spark, links) == by_hand(links)


def test_report(spark):
    frame = spark.createDataFrame(CASES["shapes"], "source_id string, page_no int, next_page long")
    report = {r.source_id: tuple(r)[1:] for r in chain_report(follow_links(frame, shared_folder(spark))).collect()}
    assert report == {"a": (5, 3, 2, 2, 1, 0), "b": (2, 1, 1, 1, 1, 1), "d": (3, 0, 3, 3, 1, 0), "e": (3, 2, 1, 0, 0, 0), "f": (2, 2, 0, 2, 1, 0)}


def test_rounds_grow_with_the_logarithm(spark, tmp_path):
    frame = spark.range(1, 1001).select(F.lit("s").alias("source_id"), F.col("id").alias("page_no"), (F.col("id") + 1).alias("next_page"))
    assert follow_links(frame, str(tmp_path)).agg(F.max("steps")).first()[0] == 999
    assert len(list(tmp_path.glob("jumps_*"))) <= 12


def test_next_numbers(spark):
    pages = spark.createDataFrame(
        [(1, '<li class="next"><a href="/x?page_no=9&s=1">Next</a></li>'), (2, '<li class="next"><a>Next</a></li>'),
         (3, '<li class="next"><a class="disabled" href="/x?page_no=4">Next</a></li>'), (4, "")], "page_no int, html string")
    number = F.expr(next_number(Paging("next_link", "li.next a:not(.disabled)", query="?page_no=")))
    assert {r.page_no: r.n for r in parse_pages(pages).select("page_no", number.alias("n")).collect()} == {1: 9, 2: 3, 3: None, 4: None}
