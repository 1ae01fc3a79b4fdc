"""Selectors and picks over rendered directory pages, one row per card."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom.functions import text as tx
from cardloom.functions.sql import struct, transform, with_value
from cardloom.operators import paging as pg, select as sel
from cardloom.operators.fields import field_value, holds
from cardloom.operators.markup import parse_pages
from cardloom.operators.rules import Paging, Pick
from cardloom.plans.catalog.base import query
from cardloom.plans.directory import CARDS, SQL, base_url, directory_pages, parsed_directory
from cardloom.plans.rendered import fill
from cardloom.sources.tables import spread, table

N, C = "nodes", "c"


def _cards(parsed, values):
    """Cards -> rows (B30), each with the given values."""

    def row(c):
        return struct(key=f"CAST(substring({c}.id, 6) AS BIGINT)", **{k: fn(c) for k, fn in values.items()})

    rows = transform(sel.find(N, None, ".staff-card"), row)
    return parsed.select(F.expr(f"inline_outer({rows})")).filter("key IS NOT NULL")


def _card_query(name, covers, **columns):
    """``columns``: name -> (value of a card, the same as SQL over ``dir``)."""
    sql = f"WITH {SQL} SELECT key, " + ", ".join(f"{v} AS {k}" for k, (_, v) in columns.items()) + " FROM dir"

    @query(name, covers, sql)
    def run(spark, sf):
        parsed = parsed_directory(spark, sf)
        return _cards(parsed, {k: fn for k, (fn, _) in columns.items()})


def _pick(*args, **kw):
    return lambda c: field_value(N, c, (Pick(*args, **kw),))


def _size(css):
    return lambda c: f"size({sel.find(N, c, css)})"


def _exists(css):
    return lambda c: f"size({sel.find(N, c, css)}) > 0"


_MAIL = "a[href^='mailto:']"
_EMAIL_SQL = "CASE WHEN has_email THEN email ELSE '' END"

_card_query("select_by_tag", "B2 B30", n_p=(_size("p"), "2"), button=(_pick("button"), "'Show'"))
_card_query("select_by_class", "B3 B8", badge=(_pick("h3.staff-name .badge"), "n_name"), none=(_size(".staff-name.badge"), "0"))
_card_query("select_by_attribute", "B5 B6 B7 B22",
            email=(_pick(_MAIL, "first", "attr:href", steps=("strip_mailto",)), _EMAIL_SQL),
            mail_text=(_pick(_MAIL), _EMAIL_SQL),
            handler=(_pick("[onclick*='id=']", "first", "attr:onclick", steps=()), "'open(''id=' || key || ''')'"),
            profile=(_pick("[class=profile]", "first", "attr:href", steps=()), "'/staff/' || key"))
_card_query("child_and_descendant", "B8 B9 E6",
            items=(_size(".facts > li"), "2"), below=(_size("ul li"), "2"), direct=(_size("#staff > li"), "0"),
            children=(lambda c: f"size({sel.children(N, c)})", "CASE WHEN has_email THEN 10 ELSE 9 END"))
_card_query("selector_lists", "B10 B14", first=(_pick("h4, h3, h6", "first", "own"), "name"),
            n=(_size("h3, li, h4"), "4"))
_card_query("has_and_not", "B11 B12 B13 E8",
            mail=(_exists(_MAIL), "has_email"),
            cold=(_pick("li:not(.hot)"), "'fact a' || key"),
            second=(_pick("li:nth-of-type(2)"), "'fact b' || key"),
            listed=(_exists("ul:has(li.hot)"), "true"))
_card_query("nth_and_all", "B15 B16 B17",
            second=(_pick("li", 1), "'fact b' || key"), absent=(_pick("li", 7), "''"),
            all=(_pick("li", "all"), "'fact a' || key || 'fact b' || key"),
            filled=(_pick(".blank, .line", "first_text"), "title || ' , ' || n_name || ', extra'"))
_card_query("own_and_partial_text", "B18 B19 B20 B21",
            own=(_pick("h3", "all", "own"), "name"),
            without=(_pick(".line", "all", "without:em"), "title || ' , , extra'"),
            first_node=(_pick(".office", "first_value", "first_node"), "'Room ' || key"),
            runs=(_pick(".office", "all", "own", steps=("trim", "drop_nbsp")), "'Room ' || key || 'Floor2'"))
_card_query("element_source", "B23 B24",
            inner=(_pick(".office", "first", "inner_html", steps=()), "'Room ' || key || '<br>Floor&nbsp;2'"),
            note=(_pick(".note", "first", "outer_html", steps=()),
                  "'<h5 class=\"note\" title=\"a&quot;b\">Caf\u00e9 \u2013 R&amp;D<br><span>x</span></h5>'"),
            outer=(_pick("ul", "first", "outer_html", steps=()),
                   "'<ul class=\"facts\"><li>fact a' || key || '</li><li class=\"hot\">fact b' || key || '</li></ul>'"))
_card_query("relatives", "B25 B26",
            next=(_pick("h6", "all", scope="next:.next-info"), "'Next to ' || key"),
            wrong_next=(_pick("h6", "all", scope="next:.other"), "''"),
            siblings=(lambda c: f"size(flatten({transform(sel.parent(N, c), lambda p: sel.find(N, p, '.staff-card'))}))",
                      "CAST(count(*) OVER (PARTITION BY source_id, page_no) AS INTEGER)"))
_card_query("class_and_visible_text", "B28 B29 J34",
            full=(lambda c: sel.has_class(c, "full"), "true"), half=(lambda c: sel.has_class(c, "half"), "false"),
            office=(_pick(".office", "first", "visible"), "'Room ' || key || ' Floor 2'"),
            script=(lambda c: f"contains({sel.visible_text(N, c)}, 'var t')", "false"),
            raw=(lambda c: f"contains({sel.element_text(N, c)}, concat('</div>\" + ', substring({c}.id, 6)))", "true"))
_card_query("card_conditions", "D8 D9 D11",
            comma=(lambda c: holds(N, c, ("text_has", ",")), "true"),
            items=(lambda c: holds(N, c, ("at_least", "li", 2)), "true"),
            plain=(lambda c: f"size({sel.filter_(sel.find(N, c, 'h4, p, ul'), lambda e: holds(N, e, ('plain_text', 100)))})",
                   "3"))


_PARTLY_HIDDEN = (
    '<style>/* .name { display: none } */ .off, li.away { display: none } .off.on { display: block } @media print { b { display: none } }'
    ' i { visibility: hidden } a:hover { display: none }</style>'
    '<div class="card" id="c{key}"><b class="name">{name}</b><span hidden>h{key}</span><p style="color:red; display:none">s{key}<b>in</b></p>'
    '<p class="off">o{key}</p><p class="off on">shown {key}</p><p class="off" style="display:inline">also {key}</p>'
    '<ul><li class="away">w{key}</li><li>li {key}</li></ul><i>v{key}<u style="visibility:visible">seen {key}</u></i><em hidden style="display:inline">e{key}</em></div>')


@query(
    "visible_cards", "B29 J34",
    """SELECT c_custkey AS key, c_name || ' shown ' || c_custkey || ' also ' || c_custkey || ' li ' || c_custkey
              || 'seen ' || c_custkey || 'e' || c_custkey AS shown, 'h' || c_custkey AS not_displayed FROM customer""",
)
def visible_cards(spark, sf):
    """Cards with parts that attributes, inline styles and style rules hide, and show again."""
    pages = spread(table(spark, sf, "customer")).select(
        F.col("c_custkey").alias("key"),
        F.expr(fill(_PARTLY_HIDDEN, {"key": "CAST(c_custkey AS STRING)", "name": "c_name"})).alias("html"))
    card = f"get({sel.find(N, None, '.card')}, 0)"
    return parse_pages(pages).select("key", F.expr(with_value(card, lambda c: struct(
        shown=tx.clean(sel.visible_text(N, c)),
        not_displayed=with_value(f"get({sel.find(N, c, 'span')}, 0)", lambda e: sel.visible_text(N, e))))).alias("v")).select("key", "v.*")


@query(
    "cards_without_mail", "E8 B11 B12",
    f"WITH {SQL} SELECT key FROM dir WHERE NOT has_email",
)
def cards_without_mail(spark, sf):
    rows = transform(
        sel.filter_(sel.find(N, None, ".staff-card"), lambda c: f"NOT {holds(N, c, ('has', _MAIL))}"),
        lambda c: struct(key=f"CAST(substring({c}.id, 6) AS BIGINT)"),
    )
    return parsed_directory(spark, sf).select(F.expr(f"inline({rows})"))


@query(
    "cards_per_page", "F5 B4 A3",
    f"""WITH {SQL} SELECT source_id, page_no, CAST(count(*) AS INTEGER) AS by_id, CAST(count(*) AS INTEGER) AS by_attribute
        FROM dir GROUP BY source_id, page_no""",
)
def cards_per_page(spark, sf):
    return parsed_directory(spark, sf).select(
        "source_id", "page_no",
        F.expr(f"size({sel.find(N, None, '#staff .card')})").alias("by_id"),
        F.expr(f"size({sel.find(N, None, '''[data-testid='staff-card'][style*='font-weight:bold']''')})").alias("by_attribute"),
    )


@query(
    "card_ordinals", "H4 F6",
    f"""WITH {SQL} SELECT key, CAST(row_number() OVER (PARTITION BY source_id, page_no ORDER BY key) AS INTEGER) AS card_no,
               CAST(count(*) OVER (PARTITION BY source_id, page_no) AS INTEGER) AS cards
        FROM dir""",
)
def card_ordinals(spark, sf):
    keys = transform(sel.find(N, None, ".staff-card"), lambda c: f"CAST(substring({c}.id, 6) AS BIGINT)")
    numbered = parsed_directory(spark, sf).select(F.expr(keys).alias("keys"))
    return numbered.select(F.size("keys").alias("cards"), F.posexplode("keys").alias("pos", "key")).select(
        "key", (F.col("pos") + 1).alias("card_no"), "cards"
    )


# --- pages of a directory --------------------------------------------------------------------------
_PAGINGS = {
    "k1": Paging("max_attr", "div.fsElementPagination a[data-page]"),
    "k2": Paging("label_div", ".fsPaginationLabel", size=CARDS),
    "k2_label": Paging("label_div", ".fsPaginationLabel", size="label"),
    "k3": Paging("label_of", "span.page-count"),
    "k4": Paging("last_attr", ".fsLastPageLink"),
    "k5": Paging("max_href", ".cms-pagination a"),
    "k6": Paging("max_text", "nav.cms-pagination a"),
    "absent": Paging("max_attr", ".no-such-links a"),
}


@query(
    "page_counts", "K1 K2 K3 K4 K5 K6 F4 D13",
    f"""WITH {SQL} SELECT source_id, """
    + ", ".join(f"CAST(last_page AS BIGINT) AS {k}" for k in _PAGINGS if k != "absent")
    + ", CAST(1 AS BIGINT) AS absent FROM totals",
)
def page_counts(spark, sf):
    first = directory_pages(spark, sf).filter("page_no = 1")


    return parse_pages(first).select(
        "source_id", *[F.expr(pg.page_count(p)).alias(k) for k, p in _PAGINGS.items()]
    )


@query(
    "page_counts_by_cards", "K2 F5",
    f"""WITH {SQL} SELECT source_id, CAST(ceil(total * 1.0 / least(total, {CARDS})) AS BIGINT) AS pages FROM totals""",
)
def page_counts_by_cards(spark, sf):

    first = directory_pages(spark, sf).filter("page_no = 1")
    by_cards = Paging("label_div", ".fsPaginationLabel", size="cards")
    return parse_pages(first).select(
        "source_id", F.expr(pg.page_count(by_cards, card=".staff-card")).alias("pages")
    )


_LINKS = Paging("hrefs", ".cms-pagination a[href*='page_no']", query="?page_no=")


@query(
    "page_links", "K7 G3",
    f"""WITH {SQL},
        l AS (SELECT source_id, 1 AS page UNION ALL SELECT source_id, last_page FROM totals
              UNION ALL SELECT source_id, 2 FROM totals WHERE last_page > 1 UNION ALL SELECT source_id, 1 FROM totals)
        SELECT DISTINCT source_id, '/staff?page_no=' || page AS link FROM l
        WHERE source_id IN (SELECT source_id FROM totals)""".replace(
        "SELECT source_id, 1 AS page UNION", "SELECT source_id, 1 AS page FROM totals UNION"
    ),
)
def page_links(spark, sf):

    first = directory_pages(spark, sf).filter("page_no = 1")
    return parse_pages(first).select(
        "source_id", F.explode(F.expr(pg.page_links(_LINKS))).alias("link")
    )


@query(
    "last_pages", "K8",
    f"""WITH {SQL} SELECT source_id, CAST(last_page AS INTEGER) AS page_no FROM totals""",
)
def last_pages(spark, sf):
    # a disabled link does not lead to another page
    link = Paging("next_link", "li.next a:not(.disabled)")
    return parsed_directory(spark, sf).filter(F.expr(f"NOT ({pg.has_next(link)})")).select("source_id", "page_no")


def _plan(spark, sf):

    paging = Paging("label_of", "span.page-count", query="?page_no=", bare_first=True)
    first = parse_pages(directory_pages(spark, sf).filter("page_no = 1"))
    announced = first.select(
        "source_id", F.expr(base_url()).alias("base_url"), F.expr(pg.page_count(paging)).alias("page_count")
    )
    return pg.page_plan(announced, paging)


_PLAN_SQL = f"""{SQL}, plan AS (
  SELECT source_id, CAST(p AS BIGINT) AS page_no,
         'https://www.dir' || source_id || '.example.org/staff' || CASE WHEN p = 1 THEN '' ELSE '?page_no=' || p END AS page_url
  FROM (SELECT source_id, unnest(range(1, last_page + 1)) AS p FROM totals))"""


@query("page_plan", "K9 J26", f"WITH {_PLAN_SQL} SELECT source_id, page_no, page_url FROM plan")
def page_plan(spark, sf):
    return _plan(spark, sf).select("source_id", "page_no", "page_url")


@query(
    "missing_pages", "K11",
    f"WITH {_PLAN_SQL} SELECT source_id, page_no, page_url FROM plan WHERE (page_no + source_id) % 4 = 0 AND page_no > 1",
)
def missing_pages(spark, sf):
    # every fourth later page was never stored
    stored = directory_pages(spark, sf).filter("page_no = 1 OR (page_no + source_id) % 4 <> 0")
    return pg.missing_pages(_plan(spark, sf), stored).select("source_id", "page_no", "page_url")


@query(
    "pages_before_first_empty", "K10",
    f"""WITH {SQL}, c AS (SELECT source_id, page_no, CASE WHEN page_no % 4 = 3 AND source_id % 2 = 0 THEN 0
            ELSE count(*) END AS cards FROM dir GROUP BY source_id, page_no),
        e AS (SELECT source_id, min(page_no) FILTER (WHERE cards = 0) AS first_empty FROM c GROUP BY source_id)
        SELECT source_id, page_no, CAST(cards AS INTEGER) AS cards FROM c JOIN e USING (source_id)
        WHERE first_empty IS NULL OR page_no < first_empty""",
)
def pages_before_first_empty(spark, sf):
    # some stored pages lost their cards
    pages = directory_pages(spark, sf).withColumn(
        "html", F.expr("if(page_no % 4 = 3 AND source_id % 2 = 0, '<html><body></body></html>', html)")
    )


    counted = parse_pages(pages).select(
        "source_id", "page_no", F.expr(f"size({sel.find(N, None, '.staff-card')})").alias("cards")
    )
    return pg.before_first_empty(counted)


