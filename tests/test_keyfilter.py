"""Detail pages nobody asks for are dropped before they are parsed."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardloom.operators import keyfilter
from cardloom.plans.catalog.profiles import rendered_pages
from cardloom.plans.extract import Stores, extract, wanted_details
from cardloom.plans.profiles import BY_ID
from cardloom.sources.layout import shared_folder
from cardloom.sources.registry import source_table

IDS = ("easterseals_ny", "new_york_mills", "lyceechicago")


def parsed_rows(frame):
    """Pages each parser of an executed plan was given, from the plan's metrics."""
    found = []

    def visit(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if name.endswith("QueryStage"):
            return visit(node.plan())
        if name == "MapInArrow":
            found.append(node.metrics().apply("pythonNumRowsReceived").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(frame._jdf.queryExecution().executedPlan())
    return found


@pytest.fixture(scope="module")
def stored_pages(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pages"))
    rendered_pages(spark, sf_dir, IDS).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_parsed_pages_follow_the_keys_asked_for(spark, stored_pages):
    profiles = [BY_ID[i] for i in IDS]
    sources = source_table(spark, profiles)
    given = {}
    for asked in (1, 3, 1000):
        pages = stored_pages.filter((F.col("role") == "detail") | (F.col("page_no") <= asked))
        found = extract(pages, sources, profiles, Stores(shared_folder(spark)))
        assert rows(found) == rows(extract(pages, sources, profiles))
        given[asked] = sum(parsed_rows(found))
        listed = found.count()
        assert given[asked] <= listed * 1.2 + 2
    every = stored_pages.filter("role = 'detail'").count()
    assert 0 < given[1] < given[3] < given[1000] <= every and given[1] < every / 2


def test_the_filter_is_one_row_below_the_parser(spark, stored_pages):
    profiles = [BY_ID[i] for i in IDS]
    found = extract(stored_pages, source_table(spark, profiles), profiles, Stores(shared_folder(spark)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in plan and "getbit" in plan.lower() and "Cartesian" not in plan and "NestedLoop" not in plan


def test_no_key_is_missed_and_few_pass_by_chance(spark):
    keys = spark.range(0, 20_000, 2).select(F.col("id").cast("string").alias("k"), F.lit("s").alias("s"))
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 2 == 0).alias("even"))
    kept = keyfilter.keep_wanted(rows, (F.lit("s"), F.col("key")), keys, ("s", "k"))
    assert kept.columns == rows.columns
    assert kept.filter("even AND CAST(key AS INT) < 20000").count() == 10_000
    assert kept.count() < 10_000 + 400


def test_too_many_keys_are_joined(spark, monkeypatch):
    monkeypatch.setattr(keyfilter, "MAX_BITS", 1 << 10)
    keys = spark.range(0, 2000, 2).select(F.col("id").alias("k")).unionAll(spark.range(4).select("id")).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    rows = spark.range(3000).withColumn("k", F.col("id").cast("string")).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT), 'x'"))
    kept = keyfilter.keep_wanted(rows, (F.col("id"),), keys, ("k",))
    assert sorted(r.id for r in kept.collect()) == sorted({*range(0, 2000, 2), 1, 3})
    assert "LeftSemi" in kept._jdf.queryExecution().executedPlan().toString()


def test_nothing_asked_for(spark, stored_pages):
    profiles = [BY_ID[i] for i in IDS]
    none = spark.createDataFrame([("easterseals_ny", ""), ("easterseals_ny", None)], "source_id string, lookup_key string")
    assert wanted_details(stored_pages, profiles, none).count() == 0
    null = spark.createDataFrame([(None,)], "id long")
    assert keyfilter.keep_wanted(null, (F.col("id"),), null.withColumnRenamed("id", "k"), ("k",)).count() == 0
