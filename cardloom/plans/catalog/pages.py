"""Queries over the stored ``pages`` table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from cardloom.functions import text as tx, urls
from cardloom.functions.sql import filter_, lit, struct, transform
from cardloom.operators import merge, select as sel
from cardloom.operators.custom import apply_extractor
from cardloom.operators.fields import field_value
from cardloom.operators.markup import explode_nodes, parse_pages
from cardloom.operators.rules import Pick
from cardloom.plans.catalog.base import query, sql_clean
from cardloom.sources.layout import shared_folder, write_nodes
from cardloom.sources.tables import stored_pages



def _decoded(x: str) -> str:
    """Character references of a text run in SQL; in text they count without their semicolon too."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name};?', '{char}', 'g')"
    return x


_DECODED = _decoded("regexp_extract(html, '<article><h1>([^<]*)</h1>', 1)")
_HOST_ID = r"split_part(regexp_replace(lower(regexp_extract(url, '(?i)^https?://([^/?#:@\s%]+)', 1)), 'www\.', ''), '.', 1)"


@query(
    "page_titles", "A1 A2 B1 B2 B8 B14 J1 J25 J34 D1 D17 C1 C3",
    f"""SELECT page_id, url, {_HOST_ID} AS source_id, {sql_clean(_DECODED)} AS title,
               regexp_matches(html, '{tx.EMAIL}') AS has_email
        FROM pages WHERE {sql_clean(_DECODED)} <> ''""",
)
def page_titles(spark, sf):
    """Flagship: the title of every article, its source, and whether the page names an address."""
    pages = stored_pages(spark, sf).withColumn("has_email", F.expr(f"{tx.find_email('html')} <> ''"))
    title = field_value("nodes", None, (Pick("article h1", "first", scope="page"),))
    titled = parse_pages(pages).select(
        "page_id", "url", F.expr(urls.source_id("url")).alias("source_id"), F.expr(title).alias("title"),
        "has_email",
    )
    return titled.filter(F.expr(tx.not_blank("title")))


#: Elements with a start tag of their own.
_STATED = "filter(nodes, n -> n.kind = 'el' AND n.inner_start > n.outer_start)"


@query(
    "nodes_by_tag", "B1 B2",
    "SELECT tag, count(*) AS n, count(DISTINCT page_id) AS pages FROM (SELECT page_id, "
    "unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pages) GROUP BY tag",
)
def nodes_by_tag(spark, sf):
    """Elements by tag, as they stand in the markup: those the parser opened again or implied are not counted."""
    # counted per page first: one small row per page and tag leaves the parse stage
    tags = parse_pages(stored_pages(spark, sf)).select("page_id", F.explode(F.expr(f"{_STATED}.tag")).alias("tag"))
    per_page = tags.groupBy("page_id", "tag").count()
    return per_page.groupBy("tag").agg(
        F.sum("count").cast("bigint").alias("n"), F.count(F.lit(1)).alias("pages")
    )


@query(
    "nav_links", "B1 B8 B22 J32 H4",
    rf"""WITH l AS (SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS hrefs,
                         regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS texts FROM pages),
        r AS (SELECT page_id, url, unnest(hrefs) AS href, unnest(texts) AS text,
                     CAST(unnest(range(1, len(hrefs) + 1)) AS INTEGER) AS link_no FROM l)
        SELECT page_id, link_no, {_decoded('text')} AS text,
               regexp_extract(url, '^(https?://[^/?#]+)', 1) || replace(replace(href, '&quot;', '"'), '&amp;', '&') AS link
        FROM r""",
)
def nav_links(spark, sf):
    links = transform(
        sel.find("nodes", None, "nav li > a[href]"),
        lambda a: struct(text=sel.element_text("nodes", a), link=urls.resolve(sel.attribute(a, "href"), "url")),
    )
    listed = parse_pages(stored_pages(spark, sf)).select("page_id", F.expr(links).alias("links"))
    return listed.select("page_id", F.posexplode("links").alias("pos", "l")).select(
        "page_id", (F.col("pos") + 1).alias("link_no"), "l.text", "l.link"
    )


@query(
    "distinct_links", "G3 I3",
    r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) AS href FROM pages)
        SELECT replace(replace(href, '&quot;', '"'), '&amp;', '&') AS link, min(page_id) AS first_page FROM l GROUP BY 1""",
)
def distinct_links(spark, sf):
    hrefs = f"array_distinct({transform(sel.find('nodes', None, 'nav li > a[href]'), lambda a: sel.attribute(a, 'href'))})"
    links = parse_pages(stored_pages(spark, sf)).select(
        F.col("page_id").alias("first_page"), F.explode(F.expr(hrefs)).alias("link")
    )
    return merge.distinct_links(links, [], "link", "first_page").select("link", "first_page")


@query(
    "unclosed_paragraphs", "B1 B9 B16 F6",
    r"""WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM pages)
        SELECT page_id, CAST(len(regexp_extract_all(body, '<p>')) AS INTEGER) AS paragraphs,
               md5(""" + _decoded("regexp_replace(body, '<[^>]+>', '', 'g')") + """) AS text
        FROM a""",
)
def unclosed_paragraphs(spark, sf):
    article = field_value("nodes", None, (Pick("article", "first", scope="page", steps=()),))
    return parse_pages(stored_pages(spark, sf)).select(
        "page_id",
        F.expr(f"size({sel.find('nodes', None, 'article > p')})").alias("paragraphs"),
        F.md5(F.expr(article)).alias("text"),
    )


@query(
    "footers_and_scripts", "J34 B21 B29",
    r"""SELECT page_id,
               """ + _decoded("regexp_extract(html, '<footer>([^<]*)', 1)") + r""" AS footer,
               regexp_extract(html, '(?s)<script>(.*?)</script>', 1) AS script,
               regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang
        FROM pages""",
)
def footers_and_scripts(spark, sf):
    pick = lambda css, **kw: F.expr(field_value("nodes", None, (Pick(css, "first", scope="page", steps=(), **kw),)))
    return parse_pages(stored_pages(spark, sf)).select(
        "page_id", pick("footer", take="visible").alias("footer"), pick("script").alias("script"),
        pick("html", take="attr:lang").alias("lang"),
    )


_LISTED = ("nav li > a[href]", "article > p", "li", "h1:not(.none), footer")


@query(
    "selector_postings", "B2 B8 B10 B12",
    r"""WITH a AS (SELECT page_id, html, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
        n AS (SELECT page_id, unnest(['nav li > a[href]', 'article > p', 'li', 'h1:not(.none), footer']) AS css,
                     unnest([len(regexp_extract_all(html, '<li><a href="')), len(regexp_extract_all(body, '<p>')),
                             len(regexp_extract_all(html, '<li>')),
                             len(regexp_extract_all(html, '<h1[ >]')) + len(regexp_extract_all(html, '<footer[ >]'))]) AS matches FROM a)
        SELECT page_id, css, CAST(matches AS INTEGER) AS matches, CAST(matches AS INTEGER) AS marked FROM n WHERE matches > 0""",
)
def selector_postings(spark, sf):
    """Matches by the posting list of a selector, and by the marks of the nodes."""
    with sel.marked() as used:
        counts = [struct(css=lit(css), matches=f"size({sel.find('nodes', None, css)})",
                         marked=f"size({filter_('nodes', lambda n: sel.matcher(css)(n, 'nodes'))})") for css in _LISTED]
    parsed = parse_pages(stored_pages(spark, sf).select("page_id", "html"), selectors={None: used})
    return parsed.select("page_id", F.expr(f"inline(array({', '.join(counts)}))")).filter("matches > 0")


def _headings(pages: pd.DataFrame) -> pd.DataFrame:
    titles = pages["html"].str.extract(r"<h1>([^<]*)</h1>", expand=False).fillna("")
    return pd.DataFrame({"page_id": pages["page_id"], "raw_title": titles, "words": titles.str.split().str.len()})


@query(
    "custom_extractor", "L4 L5",
    r"""SELECT page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS raw_title,
               CAST(len(string_split_regex(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), '\s+')) AS BIGINT) AS words
        FROM pages""",
)
def custom_extractor(spark, sf):
    return apply_extractor(
        stored_pages(spark, sf).select("page_id", "html"), _headings,
        "page_id bigint, raw_title string, words bigint",
    )


@query(
    "nodes_written_once", "B1",
    "SELECT CAST(sum(len(regexp_extract_all(html, '<[a-zA-Z]'))) AS BIGINT) AS elements, count(*) AS pages FROM pages",
)
def nodes_written_once(spark, sf):
    folder = shared_folder(spark)
    write_nodes(parse_pages(stored_pages(spark, sf)), folder)
    nodes = spark.read.parquet(folder)
    return nodes.agg(
        F.sum(F.expr(f"size({_STATED})")).cast("bigint").alias("elements"),
        F.count(F.lit(1)).alias("pages"),
    )


@query(
    "element_rows", "B1 E6 E8",
    r"""WITH l AS (SELECT page_id, len(regexp_extract_all(html, '<li>')) AS n FROM pages)
        SELECT page_id, CAST(n AS BIGINT) AS in_nav FROM l WHERE n > 0""",
)
def element_rows(spark, sf):
    """Containment on the row form: list items inside the page's ``nav``, from nodes stored once."""
    folder = shared_folder(spark)
    write_nodes(parse_pages(stored_pages(spark, sf)), folder)
    rows = explode_nodes(spark.read.parquet(folder), "page_id").select("page_id", "pos", "stop", "tag")
    nav = rows.filter("tag = 'nav'").select("page_id", F.col("pos").alias("nav_pos"), F.col("stop").alias("nav_stop"))
    inside = rows.filter("tag = 'li'").join(nav, "page_id").filter("pos > nav_pos AND pos <= nav_stop")
    return inside.groupBy("page_id").agg(F.count(F.lit(1)).alias("in_nav"))
