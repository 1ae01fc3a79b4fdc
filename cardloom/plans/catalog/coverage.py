"""Page plans of all paged profiles, on pages rendered with each profile's pagination markup."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom.functions.sql import case, lit, one_of
from cardloom.operators.chains import chain_report
from cardloom.operators.rules import Paging, Profile
from cardloom.plans import coverage
from cardloom.plans.catalog.base import query
from cardloom.plans.profiles import BY_ID, PROFILES
from cardloom.sources.layout import shared_folder
from cardloom.sources.tables import spread, table
from cardloom.plans.early import FIRST_BLOCK, GROWTH, read_until_empty
from cardloom.plans.rendered import CARDS_PER_PAGE, assigned_people, expected_sql, listing_pages

PAGED = tuple(p for p in PROFILES if p.paging)
IDS = tuple(p.profile_id for p in PAGED)


def _navigation() -> str:
    """Pagination markup of a page, from its ``page_no`` and its directory's ``total`` and ``last_page``."""
    sized = case(
        *[(f"profile_id = {lit(p.profile_id)}", f"(last_page - 1) * {p.paging.size} + 1")
          for p in PAGED if p.paging.kind == "label_div" and isinstance(p.paging.size, int)],
        otherwise="total",
    )
    # an elided pager: 1 2 3 ... last
    numbers = case(
        (f"{one_of('profile_id', [p.profile_id for p in PAGED if p.paging.kind == 'hrefs'])} AND page_no = 1",
         "array_distinct(array(1, least(2, last_page), least(3, last_page), last_page))"),
        otherwise="array(1, last_page)",
    )
    return f"""concat('<nav class="cms-pagination"><ul>',
        array_join(transform({numbers}, n -> concat('<li><a href="/staff?page_no=', n, '">', n, '</a></li>')), ''),
        '<li class="next"><a', if(page_no < last_page, '', ' class="disabled"'), '>Next</a></li></ul></nav>',
        if(page_no < last_page, '<a class="fsPaginationNext">Next</a>', ''),
        '<div class="fsElementPagination"><a data-page="1">1</a><a data-page="', last_page, '">last</a></div>',
        '<a class="fsLastPageLink" data-page="', last_page, '">Last</a>',
        '<div class="fsPaginationLabel">showing 1 - {CARDS_PER_PAGE} of&nbsp;', {sized}, ' people</div>',
        '<span class="page-count">Page 1 of ', last_page, '</span>')"""


def paged_pages(spark, sf):
    persons = assigned_people(spark, sf, IDS)
    totals = persons.groupBy("profile_id").agg(
        F.count(F.lit(1)).alias("total"),
        (F.floor(F.max("n") / CARDS_PER_PAGE) + 1).cast("int").alias("last_page"),
    )
    pages = listing_pages(spark, sf, IDS).join(totals, "profile_id")
    return pages.withColumn(
        "html", F.expr(f"replace(html, '<body>', concat('<body>', {_navigation()}))")
    ).withColumn("url", F.expr(coverage.page_address(PAGED))).drop("total", "last_page")


def _plan_sql(select: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ",\n    ".join(
        f"({n}, {quote(i)}, {quote(BY_ID[i].url)}, {quote(BY_ID[i].paging.query)}, {quote(BY_ID[i].paging.suffix)}, "
        f"{BY_ID[i].paging.bare_first}, {BY_ID[i].paging.kind == 'next_link'}, {BY_ID[i].paging.kind == 'hrefs'})"
        for n, i in enumerate(IDS)
    )
    return f"""WITH paged(n, profile_id, base_url, query, suffix, bare_first, linked, elided) AS (VALUES
    {rows}),
    sized AS (SELECT p.*, max(c_custkey // {len(IDS)}) // {CARDS_PER_PAGE} + 1 AS last_page
              FROM paged p JOIN customer ON c_custkey % {len(IDS)} = p.n GROUP BY ALL),
    numbers AS (SELECT *, unnest(range(1, last_page + 1)) AS page_no FROM sized),
    pages AS (SELECT * FROM numbers WHERE NOT elided OR page_no <= 3 OR page_no = last_page),
    plan AS (SELECT *, base_url || CASE WHEN bare_first AND page_no = 1 THEN '' ELSE query || page_no || suffix END AS page_url,
                    page_no > 1 AND (page_no + n) % 3 = 0 AS lost FROM pages)
    {select}"""


@query(
    "announced_pages", "K1 K2 K3 K4 K5 K6 K7 K9 J26 A3",
    _plan_sql("SELECT profile_id, page_no, page_url FROM plan WHERE NOT linked"),
)
def announced_pages(spark, sf):
    return coverage.announced_pages(paged_pages(spark, sf)).select("profile_id", "page_no", "page_url")


@query(
    "directory_gaps", "K8 K11",
    _plan_sql("""SELECT profile_id, page_no, page_url FROM plan WHERE lost AND (NOT linked
        OR NOT EXISTS (SELECT 1 FROM plan q WHERE q.profile_id = plan.profile_id AND q.page_no = plan.page_no - 1 AND q.lost))"""),
)
def directory_gaps(spark, sf):
    """Some later pages were never stored; a linked page shows as missing only if the page before it is there."""
    order = case(*[(f"profile_id = {lit(i)}", str(n)) for n, i in enumerate(IDS)])
    stored = paged_pages(spark, sf).filter(F.expr(f"page_no = 1 OR (page_no + {order}) % 3 <> 0"))
    return coverage.missing_pages(stored).select("profile_id", "page_no", "page_url")


_CHAINED = Profile("chained", "chained", "https://chained.example.org/staff",
                   paging=Paging("next_link", "li.next a:not(.disabled)", query="?page_no="))
_CHAIN_SOURCES = 7
_CHAIN_SQL = f"""WITH RECURSIVE places AS (
        SELECT c_custkey % {_CHAIN_SOURCES} AS s, c_custkey // {_CHAIN_SOURCES} + 1 AS p FROM customer),
    last AS (SELECT s, max(p) AS last FROM places GROUP BY s),
    pages AS (SELECT 'chain_' || s AS source_id, s, p AS page_no,
                     CASE WHEN s = 1 AND p = last THEN 1 WHEN s = 2 AND p = last // 2 THEN last // 3
                          WHEN s = 3 AND p % 5 = 0 THEN p + 2 WHEN s = 4 AND p = last THEN p - 1
                          WHEN s = 4 AND p = 3 THEN NULL WHEN p = last THEN NULL ELSE p + 1 END AS next_page
              FROM places JOIN last USING (s) WHERE NOT (s = 5 AND p % 11 = 9) AND NOT (s = 6 AND p = 1)),
    walk(source_id, page_no, steps) AS (
        SELECT source_id, page_no, 0 FROM pages WHERE page_no = 1
        UNION SELECT walk.source_id, q.page_no, walk.steps + 1
        FROM walk JOIN pages p ON p.source_id = walk.source_id AND p.page_no = walk.page_no
        JOIN pages q ON q.source_id = p.source_id AND q.page_no = p.next_page
        WHERE walk.steps < (SELECT count(*) FROM pages)),
    first AS (SELECT source_id, page_no, min(steps) AS steps FROM walk GROUP BY ALL),
    back AS (SELECT source_id, page_no, next_page FROM pages WHERE next_page <= page_no),
    ring(source_id, page_no, target, head) AS (
        SELECT b.source_id, q.page_no, b.page_no, b.page_no FROM back b JOIN pages q ON q.source_id = b.source_id AND q.page_no = b.next_page
        UNION SELECT r.source_id, q.page_no, r.target, r.head FROM ring r JOIN pages p ON p.source_id = r.source_id AND p.page_no = r.page_no
        JOIN pages q ON q.source_id = p.source_id AND q.page_no = p.next_page WHERE r.page_no <> r.target),
    closed AS (SELECT source_id, target FROM ring WHERE page_no = target),
    circles AS (SELECT r.source_id, r.page_no, min(r.page_no) OVER (PARTITION BY r.source_id, r.target) AS cycle
                FROM ring r JOIN closed USING (source_id, target))"""


def _chained_pages(spark, sf):
    """Sources by how their links go: 0 to the end, 1 and 2 back (2 leaves pages behind), 3 skips pages, 4 stops early
    and turns at the end, 5 has gaps, 6 lacks its first page."""
    people = spread(table(spark, sf, "customer")).selectExpr(
        f"c_custkey % {_CHAIN_SOURCES} AS s", f"c_custkey DIV {_CHAIN_SOURCES} + 1 AS p")
    last = people.groupBy("s").agg(F.max("p").alias("last"))
    link = ("CASE WHEN s = 1 AND p = last THEN 1 WHEN s = 2 AND p = last DIV 2 THEN last DIV 3 WHEN s = 3 AND p % 5 = 0 THEN p + 2 "
            "WHEN s = 4 AND p = last THEN p - 1 WHEN s = 4 AND p = 3 THEN NULL WHEN p = last THEN NULL ELSE p + 1 END")
    # half of the links give the number of the page, where it is the following one it can be left out
    markup = ("concat('<ul><li class=\"next\"><a', CASE WHEN next IS NULL THEN ' class=\"disabled\"' WHEN next = p + 1 AND p % 2 = 0 THEN '' "
              "ELSE concat(' href=\"/staff?page_no=', next, '\"') END, '>Next</a></li></ul>')")
    return people.join(last, "s").filter("NOT (s = 5 AND p % 11 = 9) AND NOT (s = 6 AND p = 1)").withColumn("next", F.expr(link)).select(
        F.concat(F.lit("chain_"), "s").alias("source_id"), F.lit("chained").alias("profile_id"), F.lit("listing").alias("role"),
        F.col("p").cast("int").alias("page_no"), F.expr(markup).alias("html"))


@query(
    "link_chains", "K8 K11",
    f"""{_CHAIN_SQL}
    SELECT source_id, page_no, coalesce(next_page, -1) AS next_page, EXISTS (
               SELECT 1 FROM pages q WHERE q.source_id = p.source_id AND q.page_no = p.next_page) AS stored_next,
           CAST(coalesce(steps, -1) AS BIGINT) AS steps, steps IS NOT NULL AS reached, coalesce(cycle, -1) AS cycle
    FROM pages p LEFT JOIN first USING (source_id, page_no) LEFT JOIN circles USING (source_id, page_no)""",
)
def link_chains(spark, sf):
    """Next links followed to their ends by doubling."""
    chains = coverage.link_chains(_chained_pages(spark, sf), shared_folder(spark), [_CHAINED]).drop("profile_id")
    return chains.na.fill(-1).na.fill(False)  # no next page, not reached, on no circle


@query(
    "chain_report", "K8 K11",
    f"""{_CHAIN_SQL}
    SELECT source_id, count(*) AS stored, count(steps) AS reached, count(*) - count(steps) AS unreached, count(cycle) AS on_circles,
           CAST(coalesce(count_if(cycle = page_no), 0) AS BIGINT) AS circles,
           CAST(coalesce(count_if(steps IS NOT NULL AND next_page IS NOT NULL AND NOT EXISTS (
               SELECT 1 FROM pages q WHERE q.source_id = p.source_id AND q.page_no = p.next_page)), 0) AS BIGINT) AS open_ends
    FROM pages p LEFT JOIN first USING (source_id, page_no) LEFT JOIN circles USING (source_id, page_no) GROUP BY source_id""",
)
def chain_reports(spark, sf):
    return chain_report(coverage.link_chains(_chained_pages(spark, sf), shared_folder(spark), [_CHAINED]))


# profile -> its first page without cards
_ENDS = {"pioneer_north_dallas": 6, "clarke_schools_ny": 20, "dallas_international": None, "keio_ny": 1}


def _ending(spark, sf):
    """Directories stored beyond their ends: one page has no cards, those behind it do."""
    blank = " OR ".join(f"(profile_id = {lit(i)} AND page_no = {n})" for i, n in _ENDS.items() if n)
    pages = listing_pages(spark, sf, tuple(_ENDS)).withColumn("html", F.expr(f"if({blank}, '<html><body>none</body></html>', html)"))
    return read_until_empty(pages, [BY_ID[i] for i in _ENDS], shared_folder(spark))


_ENDS_SQL = ", ".join(f"('{i}', {n or 'NULL'})" for i, n in _ENDS.items())


@query(
    "records_until_empty", "K10 L3",
    expected_sql(tuple(_ENDS), f""", ends(profile_id, stop) AS (VALUES {_ENDS_SQL})
    SELECT profile_id, page_no, name, job_title, email FROM expected JOIN ends USING (profile_id) WHERE stop IS NULL OR page_no < stop"""),
)
def records_until_empty(spark, sf):
    return _ending(spark, sf)[0].select("profile_id", "page_no", "name", "job_title", "email")


@query(
    "pages_read_until_empty", "K10 F4",
    expected_sql(tuple(_ENDS), f""", ends(profile_id, stop) AS (VALUES {_ENDS_SQL}),
    stored AS (SELECT profile_id, page_no, count(*) AS people FROM cards GROUP BY ALL),
    upto AS (SELECT profile_id, stop, CASE WHEN stop IS NULL THEN NULL
                 ELSE CAST({FIRST_BLOCK} * pow({GROWTH}, greatest(ceil(ln(stop / {FIRST_BLOCK}.0) / ln({GROWTH}) - 1e-9), 0)) AS BIGINT) END AS last_read
             FROM ends)
    SELECT profile_id AS source_id, count(*) AS parsed, max(page_no) AS last FROM stored JOIN upto USING (profile_id)
    WHERE last_read IS NULL OR page_no <= last_read GROUP BY profile_id"""),
)
def pages_read_until_empty(spark, sf):
    """Only the block in which a directory ends is parsed behind its end."""
    read = _ending(spark, sf)[1]
    return read.groupBy("source_id").agg(F.count("*").alias("parsed"), F.max("page_no").alias("last"))
