"""One directory page form that holds every construct the selection and paging operators read.

25 sources, ``CARDS`` people per page, rendered from ``customer``; ``SQL`` holds the same people,
sources and page numbers for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardloom.functions.sql import lit
from cardloom.operators.markup import parse_pages
from cardloom.plans.rendered import LINK, PEOPLE_SQL, _values, fill, people
from cardloom.sources.tables import parse_parts

SOURCES = 25
CARDS = 8
BASE = "https://www.dir{source}.example.org/staff"

CARD = (
    '<div class="staff-card card full" data-testid="staff-card" id="card-{key}" style="color:red;font-weight:bold">'
    '<h3 class="staff-name">{name}<span class="badge">{nation}</span></h3>'
    '<h4 class="office">Room {key}<br>Floor&nbsp;2</h4>'
    '<h5 class="note" title="a&quot;b">Caf&eacute; &#8211; R&D<BR /><span>x</h5>'
    '<p class="line">{title}, <em>{nation}</em>, extra</p><p class="blank"> &nbsp; </p>'
    '<ul class="facts"><li>fact a{key}</li><li class="hot">fact b{key}</li></ul>'
    f"[[{LINK}]]"
    '<a class="profile" href="/staff/{key}">Profile</a>'
    "<button onclick=\"open('id={key}')\">Show</button>"
    '<script>var t = "</div>" + {key};</script></div>'
    '<div class="next-info"><h6>Next to {key}</h6></div>'
)

SQL = f"""{PEOPLE_SQL},
dir AS (
  SELECT *, CAST(key % {SOURCES} AS INTEGER) AS source_id, CAST(key // {SOURCES} // {CARDS} AS INTEGER) + 1 AS page_no
  FROM people),
totals AS (SELECT source_id, count(*) AS total, max(page_no) AS last_page FROM dir GROUP BY source_id)"""


def base_url(source: str = "source_id") -> str:
    head, tail = BASE.split("{source}")
    return f"concat({lit(head)}, CAST({source} AS STRING), {lit(tail)})"


def directory_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = F.floor(F.col("key") / SOURCES)
    return people(spark, sf_dir).select(
        "*", (F.col("key") % SOURCES).cast("int").alias("source_id"),
        (F.floor(index / CARDS) + 1).cast("int").alias("page_no"),
    )


def directory_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = _values() | {"nation": "n_name"}
    persons = directory_people(spark, sf_dir)
    totals = persons.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("total"), F.max("page_no").alias("last_page")
    )
    cards = persons.select("source_id", "page_no", "key", F.expr(fill(CARD, values)).alias("card"))
    spread = cards.repartition(parse_parts(spark), "source_id", "page_no")
    pages = spread.groupBy("source_id", "page_no").agg(
        F.array_sort(F.collect_list(F.struct("key", "card"))).alias("cards")
    )
    links = (
        "concat("
        "'<nav class=\"cms-pagination\"><ul><li><a href=\"/staff?page_no=1\">1</a></li>',"
        "'<li><a href=\"/staff?page_no=', last_page, '\">', last_page, '</a></li>',"
        "'<li><a href=\"/staff?page_no=', last_page, '\">last</a></li>',"
        "if(page_no < last_page, concat('<li class=\"next\"><a href=\"/staff?page_no=', page_no + 1, '\">Next</a></li>'),"
        " '<li class=\"next\"><a class=\"disabled\">Next</a></li>'), '</ul></nav>',"
        "'<div class=\"fsElementPagination\"><a data-page=\"1\">1</a><a data-page=\"', last_page, '\">', last_page,"
        " '</a><a data-page=\"next\">Next</a><a class=\"fsLastPageLink\" data-page=\"', last_page, '\">Last</a></div>',"
        f"'<div class=\"fsPaginationLabel\">showing 1 - {CARDS} of ', total, ' constituents</div>',"
        "'<span class=\"page-count\">Page ', page_no, ' of ', last_page, '</span>')"
    )
    joined = pages.join(totals, "source_id")
    base = base_url()
    return joined.select(
        "source_id", "page_no",
        F.expr(f"if(page_no = 1, {base}, concat({base}, '?page_no=', page_no))").alias("url"),
        F.expr(
            "concat('<!DOCTYPE html><html><head><title>Staff</title><style>.a{}</style></head><body>', "
            f"{links}, '<div id=\"staff\">', array_join(cards.card, ''), '</div></body></html>')"
        ).alias("html"),
    )


def parsed_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_pages(directory_pages(spark, sf_dir))
