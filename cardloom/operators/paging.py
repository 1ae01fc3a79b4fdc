"""Pages of a directory: how many there are, their URLs, and which are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardloom.functions import text as tx, urls
from cardloom.functions.sql import concat, filter_, lit, transform, with_value
from cardloom.operators import select as sel
from cardloom.operators.rules import Paging


_BLOCK = 1 << 20  # pages of a block when a plan is written out


def page_count(paging: Paging, nodes: str = "nodes", card: str = "", base: str = "url") -> str:
    """K1-K7: the number of pages a directory's first page announces, 1 if it announces none.

    NULL if what stands there is a number that 64 bits cannot hold: unreadable is not one page.
    """
    links = sel.find(nodes, None, paging.css)
    label = f"array_join({transform(links, lambda el: sel.element_text(nodes, el))}, '')"
    of_links = lambda written: transform(links, written)
    if paging.kind == "max_attr":
        written = of_links(lambda a: tx.int_text(sel.attribute(a, paging.attr)))
    elif paging.kind == "last_attr":
        written = f"array({tx.int_text(f'get({links}, 0).attrs[{lit(paging.attr)}]')})"
    elif paging.kind == "max_href":
        written = of_links(lambda a: urls.page_no_text(sel.attribute(a, "href"), "page_no"))
    elif paging.kind == "max_text":
        written = of_links(lambda a: _whole_number(sel.element_text(nodes, a)))
    elif paging.kind in ("label_of", "label_div"):
        written = f"array({tx.label_total_text(label)})"
    elif paging.kind == "hrefs":
        return f"greatest(CAST(size({page_links(paging, nodes, base)}) AS BIGINT), 1)"
    else:
        raise ValueError(f"{paging.kind!r} announces no number of pages")
    total = "{}"
    if paging.kind == "label_div":
        size = {
            "cards": f"size({sel.find(nodes, None, card)})" if card else "",
            "label": tx.label_page_size(label),
        }.get(paging.size, str(paging.size))
        total = tx.ceil_div("{}", size)
    # only what is read as the number decides whether it can be read: other digits of a link do not
    stated = filter_(written, lambda w: f"{w} <> ''")
    numbers = lambda ws: transform(ws, lambda w: f"try_cast({w} AS BIGINT)")
    count = lambda ws: total.replace("{}", f"array_max({numbers(ws)})")
    return with_value(stated, lambda ws: (
        f"if(exists({numbers(ws)}, n -> n IS NULL), NULL, greatest(coalesce({count(ws)}, 1), 1))"))


def _whole_number(x: str) -> str:
    """The text if all of it is a number, else ''."""
    return f"regexp_extract({tx.trim(x)}, {lit(r'^\d+$')}, 0)"


def page_links(paging: Paging, nodes: str = "nodes", base: str = "url") -> str:
    """Distinct page links in first-seen order behind the link of page 1."""
    first = concat(f"regexp_replace({base}, {lit(r'^https?://[^/]+|[?#].*$')}, '')", lit(f"{paging.query}1"))
    links = transform(sel.find(nodes, None, paging.css), lambda a: sel.attribute(a, "href"))
    return f"array_distinct(concat(array({first}), {links}))"


def has_next(paging: Paging, nodes: str = "nodes") -> str:
    """K8."""
    return f"size({sel.find(nodes, None, paging.css)}) > 0"


def next_number(paging: Paging, nodes: str = "nodes", page_no: str = "page_no") -> str:
    """K8: the page behind this one: the number in the address of the first next link, else the following
    number; NULL without such a link."""
    link = f"get({sel.find(nodes, None, paging.css)}, 0)"
    return with_value(link, lambda a: (
        f"if({a} IS NULL, NULL, coalesce({urls.page_no(sel.attribute(a, 'href'), paging.query.strip('?&='))}, CAST({page_no} AS BIGINT) + 1))"))


def linked_numbers(paging: Paging, nodes: str = "nodes", base: str = "url") -> str:
    """K7: the numbers of exactly the linked pages, the first page among them."""
    numbers = transform(page_links(paging, nodes, base), lambda link: urls.page_no(link, paging.query.strip("?&=")))
    return f"array_compact(array_distinct({numbers}))"


def ranges(first: str, last: str, size: int) -> str:
    """Pieces (lo, hi) of at most ``size`` numbers."""
    starts = f"sequence({first}, {last}, {size}L)"
    return transform(starts, lambda lo: f"named_struct('lo', {lo}, 'hi', least({lo} + {size - 1}L, {last}))")


def numbered(directories: DataFrame, pieces: str) -> DataFrame:
    """One row per number of an array of (lo, hi), as ``page_no``, without ever holding all of them:
    pieces are cut into blocks of blocks, these into blocks, and blocks into numbers."""
    keys = [c for c in directories.columns]
    out = directories.select(*keys, F.explode(F.expr(pieces)).alias("_piece"))
    for size in (_BLOCK * _BLOCK, _BLOCK):
        out = out.select(*keys, F.explode(F.expr(ranges("_piece.lo", "_piece.hi", size))).alias("_piece"))
    return out.select(*keys, F.explode(F.expr("sequence(_piece.lo, _piece.hi)")).alias("page_no"))


def whole_range(count: str) -> str:
    """One piece from 1 to ``count``; none if it is NULL."""
    return f"if({count} IS NULL, array(), array(named_struct('lo', 1L, 'hi', CAST({count} AS BIGINT))))"


def page_plan(directories: DataFrame, paging: Paging, base: str = "base_url", count: str = "page_count") -> DataFrame:
    """One row per announced page."""
    url = urls.page_url(base, "page_no", paging.query, paging.suffix, paging.bare_first)
    return numbered(directories, whole_range(count)).withColumn("page_url", F.expr(url))


def missing_pages(plan: DataFrame, pages: DataFrame) -> DataFrame:
    """Announced pages that are not stored."""
    stored = pages.select(F.col("url").alias("page_url"))
    return plan.join(stored, "page_url", "left_anti")


def before_first_empty(page_counts: DataFrame, source: str = "source_id") -> DataFrame:
    """Pages before a directory's first page without cards.

    The bound is one row per source, found by a partial aggregate. Small, it is broadcast; large,
    the key built behind the aggregate keeps the join splittable when one source has very many pages.
    """
    key = F.concat(F.lit("\n"), F.col(source))
    bound = page_counts.groupBy(source).agg(
        F.min(F.when(F.col("cards") == 0, F.col("page_no"))).alias("first_empty")
    ).select(key.alias("_key"), "first_empty")
    joined = page_counts.withColumn("_key", key).join(bound, "_key")
    return joined.filter(
        F.col("first_empty").isNull() | (F.col("page_no") < F.col("first_empty"))
    ).drop("_key", "first_empty")
