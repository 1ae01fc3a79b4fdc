"""Merge runs that go on from earlier ones."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cardloom.operators.rules import Pick
from cardloom.plans import ledger as lg
from cardloom.plans.catalog.profiles import rendered_pages
from cardloom.plans.profiles import BY_ID
from cardloom.plans.run import merge_run
from cardloom.sources.registry import source_table

IDS = ("seattle_prep", "harrow_ny", "easterseals_ny", "lyceechicago", "chicagochristian")
PROFILES = [BY_ID[i] for i in IDS]


@pytest.fixture(scope="module")
def pages(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pages"))
    rendered_pages(spark, sf_dir, IDS).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture
def run(spark, tmp_path):
    number = iter(range(100))

    def go(pages, profiles=PROFILES, ledger=f"{tmp_path}/ledger"):
        return merge_run(pages, source_table(spark, profiles), f"{tmp_path}/run{next(number)}", profiles, ledger=ledger)

    go.ledger = f"{tmp_path}/ledger"
    return go


def rows(frame):
    return sorted(map(str, frame.collect()))


def same(a, b):
    return rows(a.merged) == rows(b.merged) and rows(a.report) == rows(b.report)


def parsed(spark, ledger):
    """Rows of the ledger by run, copies of one content counted each."""
    out = {}
    for part in ("plain", "linked", "details"):
        for r in lg.read_ledger(spark, f"{ledger}/{part}").groupBy("run", "profile_id").count().collect():
            out[part, r.run, r.profile_id] = r["count"]
    return out


def test_second_run_parses_nothing(spark, pages, run, monkeypatch):
    plain = run(pages, ledger=None)
    first = run(pages)
    assert same(first, plain)
    before = parsed(spark, run.ledger)
    assert sum(before.values()) <= pages.count()

    def refused(*_):
        raise AssertionError("nothing is left to parse")

    monkeypatch.setattr(lg, "parse_pages", refused)
    assert same(run(pages), plain)
    assert parsed(spark, run.ledger) == before
    # fewer pages, nothing new
    fewer = pages.filter("role = 'detail' OR page_no = 1")
    monkeypatch.undo()
    want = run(fewer, ledger=None)
    monkeypatch.setattr(lg, "parse_pages", refused)
    assert same(run(fewer), want)


def test_only_changed_profiles_and_pages_are_parsed(spark, pages, run):
    run(pages)
    before = parsed(spark, run.ledger)
    other = replace(BY_ID["harrow_ny"], fields=BY_ID["harrow_ny"].fields | {"job_title": (Pick("h1", "first"),)})
    changed = [other if p.profile_id == "harrow_ny" else p for p in PROFILES]
    assert same(run(pages, changed), run(pages, changed, ledger=None))
    after = parsed(spark, run.ledger)
    new = {k: v for k, v in after.items() if k not in before}
    assert new == {("plain", 2, "harrow_ny"): before["plain", 1, "harrow_ny"]}
    edited = pages.withColumn("html", F.when((F.col("profile_id") == "seattle_prep") & (F.col("page_no") == 1),
                                             F.replace("html", F.lit("Director"), F.lit("Head"))).otherwise(F.col("html")))
    assert same(run(edited), run(edited, ledger=None))
    assert {k: v for k, v in parsed(spark, run.ledger).items() if k not in after} == {("plain", 3, "seattle_prep"): 1}


def test_copies_nulls_and_empty_tables(spark, pages, run):
    some = pages.filter("profile_id = 'seattle_prep' AND page_no <= 2").select(
        "source_id", "profile_id", "role", "page_no", "url", "html", F.lit("z").alias("digest"), F.lit("z").alias("rules"), F.lit(1).alias("run"))
    blank = some.limit(1).withColumns({"html": F.lit(None).cast("string"), "page_no": F.lit(None).cast("int")})
    given = some.unionAll(some).unionAll(blank).unionAll(blank.withColumn("url", F.lit(None).cast("string")))
    want = run(given, ledger=None)
    for _ in range(2):
        assert same(run(given), want)
    none = run(given.filter("false"))
    assert none.merged.count() == 0 and none.report.count() == len(PROFILES)


def test_failed_appends_are_resumed(spark, pages, run, monkeypatch):
    """A run that ends behind its first part leaves rows the next run uses."""
    from cardloom.plans import extract as ex

    def broken(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(ex, "wanted_details", broken)
    with pytest.raises(RuntimeError):
        run(pages)
    left = lg.read_ledger(spark, f"{run.ledger}/plain").count()
    assert left > 0 and lg.read_ledger(spark, f"{run.ledger}/details") is None
    monkeypatch.undo()
    assert same(run(pages), run(pages, ledger=None))
    assert lg.read_ledger(spark, f"{run.ledger}/plain").count() == left


def test_report_before_the_first_run(spark, tmp_path):
    assert lg.ledger_report(spark, f"{tmp_path}/none").count() == 0
