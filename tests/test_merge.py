"""Joins, merging, reports, sinks and the plans behind them."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardloom.operators import merge, paging as pg
from cardloom.operators.lookup import join_details, never_matching, one_per_key
from cardloom.operators.markup import parse_pages
from cardloom.operators.rules import RECORD_FIELDS, RECORD_TYPE, Paging
from cardloom.plans.catalog.profiles import rendered_pages
from cardloom.plans.extract import extract
from cardloom.plans.profiles import BY_ID, MERGE_RUN, PROFILES
from cardloom.plans.rendered import MARKUP
from cardloom.plans.run import merge_run, write_run
from cardloom.sources import layout, sinks
from cardloom.sources.registry import source_table


def test_registry_is_complete():
    assert len(PROFILES) == len(BY_ID) == 85 and set(MARKUP) == set(BY_ID)
    assert len(MERGE_RUN) == 20
    assert all(p.url.startswith("http") and p.school_name for p in PROFILES)
    known = set(RECORD_TYPE.fieldNames()) | {"school_name", "url"}
    assert all(field in known for p in PROFILES for _, field in p.columns)


def test_dedup_then_order(spark):
    rows = [(0, "A", "t", ""), (1, "B", "t", "b@x.io"), (2, "A", "t", "a@x.io")]
    records = spark.createDataFrame(rows, "card_ord int, name string, job_title string, email string").withColumns(
        {"source_ord": F.lit(0), "page_no": F.lit(1)}
    )
    firsts = merge.first_of_each(records, ["name", "job_title"], ["card_ord"])
    assert firsts.columns == records.columns
    assert [(r.name, r.email) for r in merge.email_first(firsts).collect()] == [("B", "b@x.io"), ("A", "")]


def test_order_is_stable_over_sources_and_pages(spark):
    rows = [(s, p, c, "x@y.z" if (s + p + c) % 3 == 0 else " ") for s in range(4) for p in range(3) for c in range(5)]
    shuffled = spark.createDataFrame(rows[::-1], "source_ord int, page_no int, card_ord int, email string").repartition(3)
    found = [tuple(r) for r in merge.email_first(shuffled).collect()]
    assert found == sorted(rows, key=lambda r: (r[3] == " ", r[:3]))
    assert [tuple(r) for r in merge.in_order(shuffled).collect()] == rows


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    records = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("key"), F.col("id").alias("ord"), F.lit("v").alias("v")
    )
    firsts = merge.first_of_each(records, ["key"], ["ord"])
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange")  # printed top-down: partial below the exchange
    assert firsts.count() == 10_000 and firsts.filter("key = 0").first().ord == 0


def test_lookup_without_key_matches_nothing(spark):
    listing = spark.createDataFrame([(1, ""), (2, None), (3, "/a")], "card_ord int, lookup_key string")
    keyed = listing.withColumn("join_key", never_matching(F.col("lookup_key"), F.col("card_ord")))
    assert len({r.join_key for r in keyed.collect()}) == 3
    details = spark.createDataFrame([("/a", 2, "late"), ("/a", 1, "first"), ("", 1, "x")], "join_key string, page_no int, email string")
    joined = keyed.join(one_per_key(details, ["join_key"], ["page_no"]), "join_key", "left")
    assert {r.card_ord: r.email for r in joined.collect()} == {1: None, 2: None, 3: "first"}


def test_hot_lookup_keys_are_split(spark):
    """A third of all rows asks for one page: the adaptive plan splits that partition."""
    sized = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) if k in ("spark.sql.shuffle.partitions",) else None for k in sized}
    for k, v in sized.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60_000, 1, 8).withColumns({f: F.lit("") for f in RECORD_FIELDS}).withColumns({
            "source_id": F.lit("s"), "profile_id": F.lit("p"), "page_no": F.lit(1), "card_ord": F.col("id").cast("int"),
            "url": F.concat(F.lit("/"), F.col("id") % 5000),
            "name": F.sha2(F.col("id").cast("string"), 256),
            "lookup_key": F.when(F.col("id") % 3 == 0, F.lit("/0")).otherwise(F.concat(F.lit("/"), F.col("id") % 5000)),
        })
        details = rows.filter("id < 5000").withColumns({"lookup_key": F.col("url"), "email": F.lit("x@y.z")})
        joined = join_details(rows, details, [], {"email": ["p"]})
        assert joined.filter("email = 'x@y.z'").count() == 60_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_page_counts_without_links_and_with_text(spark):
    pages = spark.createDataFrame(
        [(1, "<p>no links</p>"), (2, '<nav class="p"><a>1</a><a> 12 </a><a>3x</a><a>Next</a></nav>'),
         (3, '<div class="l">showing 1 - 24 of 0</div>')], "id int, html string")
    counted = parse_pages(pages).select(
        "id", F.expr(pg.page_count(Paging("max_text", ".p a"))).alias("t"),
        F.expr(pg.page_count(Paging("label_div", ".l", size=24))).alias("l"))
    assert {r.id: (r.t, r.l) for r in counted.collect()} == {1: (1, 1), 2: (12, 1), 3: (1, 1)}
    with pytest.raises(ValueError):
        pg.page_count(Paging("next_link", "a"))


def test_announcements_beyond_32_bits_and_unreadable_ones(spark):
    pages = spark.createDataFrame(
        [(1, '<div class="l">showing 1\u00a0-\u00a08 of\u00a03000000000</div>'), (2, '<div class="l">page 1 of ' + "9" * 30 + "</div>")],
        "id int, html string")
    counted = parse_pages(pages).select("id", F.expr(pg.page_count(Paging("label_of", ".l"))).alias("n"))
    assert {r.id: r.n for r in counted.collect()} == {1: 3_000_000_000, 2: None}


def test_pager_with_many_numbers(spark):
    links = lambda numbers: '<nav class="p">' + "".join(f"<a>{n}</a>" for n in numbers) + "</nav>"
    pages = spark.createDataFrame(
        [(1, links(range(1, 21))), (2, links([*range(1, 15), "Next"])), (3, links([1, 2, "9" * 30]))], "id int, html string")
    counted = parse_pages(pages).select("id", F.expr(pg.page_count(Paging("max_text", ".p a"))).alias("n"))
    assert {r.id: r.n for r in counted.collect()} == {1: 20, 2: 14, 3: None}
    plan = pg.numbered(counted, pg.whole_range("n")).groupBy("id").count()
    assert {r.id: r["count"] for r in plan.collect()} == {1: 20, 2: 14}


def test_only_the_page_number_decides_whether_a_count_is_readable(spark):
    """Ids of sessions and the like stand in links and labels; 19 digits that fit are a number too."""
    long_id = "1234567890123456789"
    pages = spark.createDataFrame([
        (1, f'<a href="/s?sid={long_id}0&page_no=7" data-page="7" title="{long_id}0">7</a>'
            f'<a href="/s?sid={long_id}0">{long_id}0th</a><p>{long_id}0 showing 1 - 8 of 56</p>'),
        (2, f'<a href="/s?page_no={long_id}" data-page="{long_id}">{long_id}</a><p>of {long_id}</p>'),
        (3, f'<a href="/s?page_no={long_id}0" data-page="{long_id}0">{long_id}0</a><a href="/s?page_no=2" data-page="2">2</a><p>of {long_id}0</p>'),
        (4, '<a href="/s" data-page="next">Next</a><p>all</p>')], "id int, html string")
    kinds = {"max_href": Paging("max_href", "a"), "max_attr": Paging("max_attr", "a"), "max_text": Paging("max_text", "a"),
             "last_attr": Paging("last_attr", "a"), "label_of": Paging("label_of", "p"), "label_div": Paging("label_div", "p", size=8)}
    counted = parse_pages(pages).select("id", *[F.expr(pg.page_count(p)).alias(k) for k, p in kinds.items()])
    whole = int(long_id)
    want = {1: (7, 7, 7, 7, 56, 7), 2: (whole,) * 5 + (-(-whole // 8),), 3: (None,) * 6, 4: (1,) * 6}
    assert {r.id: tuple(r)[1:] for r in counted.collect()} == want


def test_plans_are_written_out_in_blocks(spark):
    some = spark.createDataFrame([(1, 3), (2, None), (3, 2_500_000)], "id int, n long")
    rows = pg.numbered(some, pg.whole_range("n"))
    got = {r.id: (r.a, r.b, r.c) for r in rows.groupBy("id").agg(
        F.min("page_no").alias("a"), F.max("page_no").alias("b"), F.count("*").alias("c")).collect()}
    assert got == {1: (1, 3, 3), 3: (1, 2_500_000, 2_500_000)}
    huge = spark.createDataFrame([(1, 1 << 50)], "id int, n long")
    assert [r.page_no for r in pg.numbered(huge, pg.whole_range("n")).limit(2).collect()] == [1, 2]


def test_linked_pages_are_exactly_the_linked_ones(spark):
    nav = "".join(f'<a href="/staff?page_no={n}">{n}</a>' for n in (1, 2, 3, 57, 2))
    pages = spark.createDataFrame([("https://x.org/staff", f"<nav>{nav}</nav>")], "url string, html string")
    found = parse_pages(pages).select(F.expr(pg.linked_numbers(Paging("hrefs", "nav a", query="?page_no="))).alias("n"))
    assert found.first().n == [1, 2, 3, 57]


def test_all_sources_of_a_shared_address_are_listed(spark):
    pages = spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "c"), ("u", "a"), ("v", "a")], "url string, source_id string")
    assert sorted(map(tuple, merge.shared_addresses(pages).collect())) == [("u", "a", 3), ("u", "b", 3), ("u", "c", 3)]


@pytest.fixture(scope="module")
def small_run(spark, sf_dir, tmp_path_factory):
    ids = ("seattle_prep", "harrow_ny", "easterseals_ny", "chicagowaldorf", "little_miami_board")
    profiles = [BY_ID[i] for i in ids]
    folder = str(tmp_path_factory.mktemp("run"))
    pages = rendered_pages(spark, sf_dir, ids).filter("profile_id <> 'little_miami_board'")
    layout.write_pages(pages, f"{folder}/pages")
    return folder, profiles, source_table(spark, profiles)


def test_plan_over_stored_pages(spark, small_run):
    """Each branch prunes to its own partitions, extraction is map-only, nothing is a cross join."""
    folder, profiles, sources = small_run
    stored = layout.read_pages(spark, f"{folder}/pages")
    plain = extract(stored, sources, profiles[:2])
    text = plain._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(role" in text and "Exchange hash" not in text
    assert "BroadcastHashJoin" in text and "Cartesian" not in text and "NestedLoop" not in text
    assert text.count("MapInArrow") == 1
    looked_up = extract(stored, sources, profiles[2:3])
    assert "partial_min_by" in looked_up._jdf.queryExecution().executedPlan().toString()


def test_run_writes_everything_once(spark, small_run):
    folder, profiles, sources = small_run
    stored = layout.read_pages(spark, f"{folder}/pages")
    run = merge_run(stored, sources, f"{folder}/out", profiles)
    assert "MapInArrow" not in run.merged._jdf.queryExecution().executedPlan().toString()
    write_run(run, f"{folder}/out")
    report = {r.source_id: r for r in run.report.collect()}
    assert report["little_miami_board"].status == "failed" and report["little_miami_board"].error == "no stored page"
    assert all(report[p.profile_id].success for p in profiles[:4])
    lines = [line for f in sorted(Path(f"{folder}/out/merged_csv").glob("part-*")) for line in f.read_text().splitlines()[1:]]
    assert len(lines) == run.records.count() == sum(r.records for r in report.values())
    with_email = [not line.endswith('""') for line in lines]
    assert with_email == sorted(with_email, reverse=True) and True in with_email and False in with_email
    assert len(list(Path(f"{folder}/out/per_source").glob("source_id=*"))) == 4


def test_csv_and_json_forms(spark, tmp_path):
    records = spark.createDataFrame([('a"b', "c,d", None), ("x\ny", "", "é")], "name string, job_title string, email string")
    sinks.write_csv(records.coalesce(1), f"{tmp_path}/csv", [("name", "name"), ("title", "job_title"), ("email", "email")])
    text = next(Path(f"{tmp_path}/csv").glob("part-*")).read_text()
    assert text == '"name","title","email"\n"a""b","c,d",""\n"x\ny","","é"\n'
    sinks.write_csv(records.filter("false"), f"{tmp_path}/none")
    assert next(Path(f"{tmp_path}/none").glob("part-*")).read_text() == '"name","job_title","email"\n'
    sinks.write_json(records.coalesce(1), f"{tmp_path}/json")
    assert '{"name":"a\\"b","job_title":"c,d","email":""}' in next(Path(f"{tmp_path}/json").glob("part-*")).read_text()


def test_shared_folder_comes_from_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    folder = layout.shared_folder(spark)
    assert before is None or folder.startswith(before.rstrip("/"))
    assert folder != layout.shared_folder(spark)


def test_shared_folder_takes_the_context_folder_and_refuses_clusters(spark, monkeypatch):
    if spark.conf.get("spark.checkpoint.dir", None):
        pytest.skip("the session names a folder")
    monkeypatch.setattr(layout, "_context_folder", lambda s: "hdfs://shared/place")
    assert layout.shared_folder(spark).startswith("hdfs://shared/place/cardloom-")
    monkeypatch.setattr(layout, "_context_folder", lambda s: None)

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    with pytest.raises(ValueError):
        layout.shared_folder(type("Session", (), {"conf": Conf()})())


def test_workers_need_no_copy_of_the_package(sf_dir, tmp_path):
    """Run from another folder, with the package reachable only through the driver's path."""
    code = (
        f"import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from cardloom.plans.catalog import CATALOG\n"
        f"print('rows', CATALOG['page_titles'].run(spark, {sf_dir!r}).count(), CATALOG['custom_extractor'].run(spark, {sf_dir!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
