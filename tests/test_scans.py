"""Sequences of blocks dealt over many rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cardloom.operators.markup import parse_pages
from cardloom.operators.scans import block_rows, records_of_blocks
from cardloom.operators.shapes import page_records
from cardloom.plans.profiles import BY_ID

IDS = {"heading_text": "association_house", "heading_list": "toddlertown", "slots": "harbor_school_ny"}
COLUMNS = ("key", "card_ord", "name", "job_title", "email")


def blocks(spark, shape, rng, sizes):
    """Random blocks of a shape, as ``block_rows`` gives them."""
    text = lambda: rng.choice([None, "", "Head of art", "Teacher", "Director", "x"])
    rows = []
    for key, n in sizes:
        for i in range(n):
            if shape == "heading_text":
                values = (text(), text())
            elif shape == "heading_list":
                values = (rng.random() < 0.6, rng.random() < 0.4, text(), rng.choice([None, "a@b.c", ""]))
            else:
                values = (rng.choice(["", "Head of art", "Ann", "Director"]), rng.random() < 0.3, rng.choice([None, None, "a@b.c", ""]))
            rows.append((key, i, 10 * i + 1, *values))
    types = {"heading_text": "heading string, text string", "heading_list": "is_heading boolean, is_list boolean, heading string, email string",
             "slots": "text string, is_bold boolean, email string"}[shape]
    return spark.createDataFrame(rows, f"key string, i long, pos int, {types}").repartition(4)


def listed(frame):
    return sorted(map(str, frame.select(*COLUMNS).collect()))


@pytest.mark.parametrize("shape", IDS)
def test_any_chunk_gives_what_one_row_gives(spark, shape):
    rng = random.Random(shape)
    given = blocks(spark, shape, rng, [("a", 400), ("b", 37), ("c", 1), (None, 60)]).cache()
    whole = listed(records_of_blocks(given, shape, ("key",), 10_000))
    assert len(whole) > 10
    for chunk in (1, 2, 3, 7, 50, 400):
        assert listed(records_of_blocks(given, shape, ("key",), chunk)) == whole


@pytest.mark.parametrize("shape", IDS)
def test_as_folding_the_page(spark, sf_dir, shape):
    from cardloom.plans.rendered import listing_pages

    profile = BY_ID[IDS[shape]]
    pages = listing_pages(spark, sf_dir, (profile.profile_id,)).filter("page_no <= 4").select(F.col("page_no").cast("string").alias("key"), "html")
    parsed = parse_pages(pages).cache()
    folded = parsed.select("key", F.expr(f"inline({page_records(BY_ID[IDS[shape]], 'nodes')})"))
    rows = block_rows(parsed, profile, "key")
    assert rows.count() > 3 * pages.count()
    got = records_of_blocks(rows, shape, ("key",), 4)
    if profile.keep:
        got = got.filter("name <> ''")
    assert listed(got) == listed(folded)


def test_gaps_and_empty(spark):
    given = blocks(spark, "slots", random.Random(1), [("a", 200)])
    gaps = given.withColumn("i", F.col("i") * 1000 + 5)
    assert listed(records_of_blocks(gaps, "slots", ("key",), 64)) == listed(records_of_blocks(given, "slots", ("key",), 64))
    assert records_of_blocks(given.filter("false"), "slots", ("key",)).count() == 0
