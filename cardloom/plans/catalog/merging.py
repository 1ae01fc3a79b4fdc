"""Merge run: all sources of the run into one ordered, counted result with its report."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cardloom.operators import merge
from cardloom.operators.custom import Limits
from cardloom.plans.catalog.base import query
from cardloom.plans.catalog.profiles import COLUMNS, MERGE_IDS, rendered_pages, rendered_records
from cardloom.plans.extract import extract
from cardloom.plans.ledger import ledger_report
from cardloom.plans.profiles import BY_ID, MERGE_RUN
from cardloom.plans.rendered import expected_sql
from cardloom.operators.ordinal import with_place
from cardloom.plans.run import merge_run as run_merge
from cardloom.sources import sinks
from cardloom.sources.layout import shared_folder
from cardloom.sources.registry import source_table

# The run plus a source whose profile fails without records; one source has no stored page, one
# has pages without cards.
RUN_IDS = MERGE_IDS + ("little_miami_board",)
UNSTORED, CARDLESS = "d187", ("little_miami_board", "cps")
LABELS = dict(MERGE_RUN) | {"little_miami_board": "Little Miami Board"}
BATCH = 5


def run_inputs(spark, sf):
    profiles = [BY_ID[i] for i in RUN_IDS]
    sources = source_table(spark, profiles, LABELS)
    pages = rendered_pages(spark, sf, RUN_IDS).filter(F.col("profile_id") != UNSTORED)
    blank = F.col("profile_id").isin(*CARDLESS)
    pages = pages.withColumn("html", F.when(blank, F.lit("<html></html>")).otherwise(F.col("html")))
    return sources, pages, profiles


def report(spark, sf):
    sources, pages, profiles = run_inputs(spark, sf)
    records = extract(pages, sources, profiles)
    return merge.run_report(sources, pages.select("source_id"), records)


def _labels_sql():
    rows = ", ".join(f"({n}, '{i}', '{LABELS[i]}')" for n, i in enumerate(RUN_IDS))
    return f"labels_of(source_ord, source_id, label) AS (VALUES {rows})"


_LOST = ", ".join(f"'{i}'" for i in (UNSTORED, *CARDLESS))
_FOUND = f"found AS (SELECT * FROM expected WHERE profile_id NOT IN ({_LOST}))"
_REPORT = f"""{_labels_sql()}, {_FOUND},
stored AS (SELECT t.profile_id AS source_id, count(DISTINCT page_no)
             + sum(CASE WHEN has_detail AND stored THEN 1 ELSE 0 END) AS pages
           FROM cards t WHERE t.profile_id <> '{UNSTORED}' GROUP BY t.profile_id),
report AS (
  SELECT l.source_id, l.source_ord, label, CAST(coalesce(s.pages, 0) AS BIGINT) AS pages,
         CAST(0 AS BIGINT) AS failed_pages, count(f.key) AS records, CAST(coalesce(count_if(f.email <> ''), 0) AS BIGINT) AS with_email,
         CASE WHEN s.pages IS NULL OR l.source_id = 'little_miami_board' THEN 'failed'
              WHEN count(f.key) > 0 THEN 'ok' ELSE 'empty' END AS status,
         CASE WHEN s.pages IS NULL THEN 'no stored page'
              WHEN l.source_id = 'little_miami_board' THEN 'No board members detected' ELSE '' END AS error
  FROM labels_of l LEFT JOIN stored s USING (source_id) LEFT JOIN found f ON f.profile_id = l.source_id
  GROUP BY l.source_id, l.source_ord, label, s.pages)"""


def _sql(ids, more, select):
    return expected_sql(ids, "").rstrip() + f",\n{more}\n{select}"


@query(
    "run_report", "L1 D14 D15 D16 F1",
    _sql(RUN_IDS, _REPORT, "SELECT source_id, source_ord, label, pages, failed_pages, records, with_email, status, "
                           "status <> 'failed' AS success, error FROM report"),
)
def run_report(spark, sf):
    return report(spark, sf)


@query(
    "run_totals", "F2",
    _sql(RUN_IDS, _REPORT, f"SELECT CAST(source_ord // {BATCH} AS INTEGER) + 1 AS batch, "
                           "CAST(count_if(status <> 'failed') AS BIGINT) AS successful, "
                           "CAST(count_if(status = 'failed') AS BIGINT) AS failed "
                           "FROM report GROUP BY 1"),
)
def run_totals(spark, sf):
    batches = report(spark, sf).withColumn("batch", (F.floor(F.col("source_ord") / BATCH) + 1).cast("int"))
    return merge.run_totals(batches, "batch")


@query(
    "run_failures", "F7",
    _sql(RUN_IDS, _REPORT, "SELECT label, error FROM report WHERE status = 'failed'"),
)
def run_failures(spark, sf):
    return merge.failures(report(spark, sf))


@query(
    "merge_run", "I1 I2 G1 L3 A13",
    _sql(RUN_IDS, _FOUND, f"SELECT {', '.join(COLUMNS)} FROM found"),
)
def merged_records(spark, sf):
    """Records of successful sources, those with an address first, otherwise in stored order."""
    sources, pages, profiles = run_inputs(spark, sf)
    return run_merge(pages, sources, shared_folder(spark), profiles).merged.select(*COLUMNS)


_RESUMED_IDS = ("pioneer_north_dallas", "clarke_schools_ny", "easterseals_ny")
_CHANGED = "clarke_schools_ny"


def _resumed_runs(spark, sf):
    """Three runs on one ledger: the first has every other listing page, the second all, the third has all and one
    profile with other rules."""
    profiles = [BY_ID[i] for i in _RESUMED_IDS]
    pages = rendered_pages(spark, sf, _RESUMED_IDS)
    changed = [replace(p, keep=("all_of", "name", "email")) if p.profile_id == _CHANGED else p for p in profiles]
    ledger = shared_folder(spark)
    runs = [run_merge(given, source_table(spark, profiles), shared_folder(spark), rules, ledger=ledger) for given, rules in (
        (pages.filter("role = 'detail' OR page_no % 2 = 1"), profiles), (pages, profiles), (pages, changed))]
    return ledger, runs


@query(
    "resumed_run", "L3 I1 A13",
    expected_sql(_RESUMED_IDS, f"""SELECT {', '.join(COLUMNS)} FROM expected WHERE profile_id <> '{_CHANGED}' OR (name <> '' AND email <> '')"""),
)
def resumed_run(spark, sf):
    """The last of several runs on one ledger gives what a single run gives."""
    return _resumed_runs(spark, sf)[1][-1].merged.select(*COLUMNS)


@query(
    "parsed_by_run", "L1 L3 F3",
    expected_sql(_RESUMED_IDS, f""", paged AS (SELECT DISTINCT profile_id, page_no FROM cards),
    asked AS (SELECT profile_id, page_no FROM cards WHERE has_detail AND stored)
    SELECT run, part, profile_id, count(*) AS parsed FROM (
        SELECT CASE WHEN page_no % 2 = 1 THEN 1 ELSE 2 END AS run, 'listing' AS part, profile_id FROM paged
        UNION ALL SELECT 3, 'listing', profile_id FROM paged WHERE profile_id = '{_CHANGED}'
        UNION ALL SELECT 0, 'details', profile_id FROM asked)
    GROUP BY ALL"""),
)
def parsed_by_run(spark, sf):
    """New pages of the second run, and pages of the changed profile in the third, are all that these two parse.

    Detail pages are counted over all runs: a few that only a later run asks for pass the key filter earlier.
    """
    ledger, _ = _resumed_runs(spark, sf)
    of = lambda part: ledger_report(spark, f"{ledger}/{part}")
    details = of("details").groupBy("profile_id").agg(F.sum("parsed").alias("parsed")).withColumns({"run": F.lit(0), "part": F.lit("details")})
    listing = of("plain").unionByName(of("linked")).withColumns({"run": F.col("run").cast("int"), "part": F.lit("listing")})
    return listing.unionByName(details).select("run", "part", "profile_id", "parsed")


_FAILING_IDS = ("pioneer_north_dallas", "clarke_schools_ny", "dallas_international")


def _raises(page):
    raise ValueError("this source is broken")


def _raises_on_page_2(page):
    if page["page_no"] == 2:
        raise RuntimeError("page two")
    return [{"name": f"Page {page['page_no']}", "email": "a@b.example"}]


@query(
    "failing_source", "L1 L2 L4",
    _sql(_FAILING_IDS, """paged AS (SELECT DISTINCT profile_id, page_no FROM cards),
        counted AS (SELECT profile_id, count(*) AS pages, count(*) FILTER (WHERE page_no <> 2) AS good FROM paged GROUP BY 1),
        ruled AS (SELECT count(*) AS n FROM expected WHERE profile_id = 'pioneer_north_dallas')""",
        """SELECT profile_id AS source_id, pages,
           CASE profile_id WHEN 'clarke_schools_ny' THEN pages WHEN 'dallas_international' THEN pages - good ELSE 0 END AS failed_pages,
           CASE profile_id WHEN 'clarke_schools_ny' THEN 0 WHEN 'dallas_international' THEN good ELSE (SELECT n FROM ruled) END AS records,
           CASE profile_id WHEN 'clarke_schools_ny' THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN profile_id = 'clarke_schools_ny' THEN 'ValueError: this source is broken'
                WHEN profile_id = 'dallas_international' AND good < pages THEN 'RuntimeError: page two' ELSE '' END AS error
           FROM counted"""),
)
def failing_source(spark, sf):
    """One source whose function always raises, one that raises on one page; the third is read by rules."""
    profiles = [BY_ID[i] for i in _FAILING_IDS]
    run = run_merge(rendered_pages(spark, sf, _FAILING_IDS), source_table(spark, profiles), shared_folder(spark), profiles,
                    {"clarke_schools_ny": _raises, "dallas_international": _raises_on_page_2})
    return run.report.select("source_id", "pages", "failed_pages", "records", "status", "error")


def _never_returns_on_page_2(page):
    while page["page_no"] == 2:
        pass
    return [{"name": f"Page {page['page_no']}", "email": "a@b.example"}]


def _ends_on_page_1(page):
    import os

    if page["page_no"] == 1:
        os._exit(3)
    return [{"name": f"Page {page['page_no']}"}]


def _takes_all_memory(page):
    return [{"name": str(len(bytearray(1 << 45)))}]


_QUARANTINED = {"pioneer_north_dallas": _takes_all_memory, "clarke_schools_ny": _ends_on_page_1, "dallas_international": _never_returns_on_page_2}


@query(
    "quarantined_sources", "L1 L2 L4",
    _sql(_FAILING_IDS, """paged AS (SELECT DISTINCT profile_id, page_no FROM cards),
        told AS (SELECT *, CASE profile_id WHEN 'pioneer_north_dallas' THEN 'MemoryError: '
            WHEN 'clarke_schools_ny' THEN CASE WHEN page_no = 1 THEN 'ChildProcessError: the function ended its process' END
            ELSE CASE WHEN page_no = 2 THEN 'TimeoutError: no result within 3 seconds' END END AS error FROM paged)""",
        """SELECT profile_id AS source_id, count(*) AS pages, count(error) AS failed_pages, count(*) - count(error) AS records,
           CASE WHEN count(error) = count(*) THEN 'failed' ELSE 'ok' END AS status, coalesce(max(error), '') AS error
           FROM told GROUP BY profile_id"""),
)
def quarantined_sources(spark, sf):
    """Functions that never return, end their process or take all memory cost the pages they do it on."""
    profiles = [BY_ID[i] for i in _FAILING_IDS]
    run = run_merge(rendered_pages(spark, sf, _FAILING_IDS), source_table(spark, profiles), shared_folder(spark), profiles,
                    _QUARANTINED, limits=Limits(seconds=3))
    return run.report.select("source_id", "pages", "failed_pages", "records", "status", "error")


@query(
    "merge_counts", "F3 F1 D17",
    _sql(RUN_IDS, _FOUND, "SELECT profile_id, count(*) AS records, CAST(count_if(email <> '') AS BIGINT) AS with_email, "
                          "CAST(count_if(email = '') AS BIGINT) AS without_email FROM found GROUP BY profile_id"),
)
def merge_counts(spark, sf):
    sources, pages, profiles = run_inputs(spark, sf)
    return merge.counts(extract(pages, sources, profiles), "profile_id")


_EXTRA_IDS = ("german_school_chicago", "hamilton_city", "miami_lakes_k8")


@query(
    "union_with_extras", "G1 C8 C10 A9",
    expected_sql(_EXTRA_IDS, """SELECT profile_id, name, job_title, email,
           CASE WHEN profile_id = 'german_school_chicago' THEN image_url END AS image_url,
           CASE WHEN profile_id = 'hamilton_city' THEN location END AS location,
           CASE WHEN profile_id = 'miami_lakes_k8' THEN profile_url END AS profile_url FROM expected"""),
)
def union_with_extras(spark, sf):
    core = ["profile_id", "name", "job_title", "email"]
    records = rendered_records(spark, sf, _EXTRA_IDS)
    of = lambda i, extra: records.filter(F.col("profile_id") == i).select(*core, extra)
    return merge.union_all(
        of("german_school_chicago", "image_url"), of("hamilton_city", "location"), of("miami_lakes_k8", "profile_url")
    )


@query(
    "ordered_positions", "I1 I2 I3",
    expected_sql(
        ("keio_ny", "d187"),
        """SELECT profile_id, page_no, name, row_number() OVER (PARTITION BY profile_id, page_no
               ORDER BY (email <> '') DESC, key) AS place FROM expected""",
    ),
)
def ordered_positions(spark, sf):
    """The place of a record within its page when addresses come first."""
    from pyspark.sql import Window

    records = rendered_records(spark, sf, ("keio_ny", "d187"))
    by_page = Window.partitionBy("source_id", "page_no").orderBy(F.desc(merge.has_email()), "card_ord")
    return records.select(
        "profile_id", "page_no", "name", F.row_number().over(by_page).cast("bigint").alias("place")
    )


_ORDER = "(email <> '') DESC, source_ord, page_no, key"


def _run_records(spark, sf):
    """Records of a run, with what orders them."""
    return rendered_records_of(spark, sf, RUN_IDS).withColumn("with_email", merge.has_email())


def rendered_records_of(spark, sf, ids):
    profiles = [BY_ID[i] for i in ids]
    return extract(rendered_pages(spark, sf, ids), source_table(spark, profiles), profiles)


@query(
    "global_positions", "H4 I1 I2 I3",
    expected_sql(RUN_IDS, f"""SELECT profile_id, page_no, name, row_number() OVER (ORDER BY {_ORDER}) AS place FROM expected"""),
)
def global_positions(spark, sf):
    """The place of every record in the whole ordered result, not in its page."""
    records = _run_records(spark, sf)
    placed = with_place(records, [F.desc("with_email"), *merge.ORDER], shared_folder(spark))
    return placed.select("profile_id", "page_no", "name", "place")


@query(
    "json_array_lines", "A5 A12 I1",
    expected_sql(RUN_IDS, f""", placed AS (
        SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS place, count(*) OVER () AS total FROM expected)
    SELECT place, CASE WHEN place = 1 THEN '[' ELSE '' END AS opens, CASE WHEN place = total THEN ']' ELSE ',' END AS closes,
           name, job_title, email FROM placed"""),
)
def json_array_lines(spark, sf):
    """The merged result written as one JSON array in many parts, and read back line by line."""
    folder = shared_folder(spark)
    records = _run_records(spark, sf)
    core = [(c, c) for c in ("name", "job_title", "email")]
    sinks.write_json_array(records, f"{folder}/array", [F.desc("with_email"), *merge.ORDER], f"{folder}/scratch", core)
    # parts by name, and lines within a part, are in order; a line holds one object
    lines = spark.read.text(f"{folder}/array").select("value", F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("block"),
                                                      F.monotonically_increasing_id().alias("line"))
    objects = lines.filter("value NOT IN ('[', ']')").withColumns({
        "record": F.from_json(F.regexp_replace("value", ",$", ""), "name string, job_title string, email string")})
    placed = with_place(objects, ["part", "block", "line"], f"{folder}/lines")
    return placed.select(
        "place", F.when(F.col("place") == 1, "[").otherwise("").alias("opens"),
        F.when(F.col("value").endswith(","), ",").otherwise("]").alias("closes"), "record.name", "record.job_title", "record.email",
    )
