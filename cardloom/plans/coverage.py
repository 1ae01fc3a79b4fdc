"""Which pages of each directory should be stored, and which are missing (K1-K11 for all profiles).

Only first pages are parsed for the announced number; directories that merely link to the next page are
followed page by page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cardloom.functions import urls
from cardloom.functions.sql import case, lit, transform
from cardloom.operators.markup import parse_pages
from cardloom.operators.chains import follow_links
from cardloom.operators.paging import has_next, linked_numbers, next_number, numbered, page_count, whole_range
from cardloom.operators.rules import Profile
from cardloom.plans.profiles import PROFILES


def _by_profile(profiles: Sequence[Profile], value) -> str:
    return case(*[(f"profile_id = {lit(p.profile_id)}", value(p)) for p in profiles])


def page_address(profiles: Sequence[Profile]) -> str:
    """URL of page ``page_no`` under each profile's pattern."""
    return _by_profile(
        profiles,
        lambda p: urls.page_url(
            lit(p.url), "page_no", p.paging.query, p.paging.suffix, p.paging.bare_first
        ),
    )


def _listing(pages: DataFrame, profiles: Sequence[Profile]) -> DataFrame:
    return pages.filter(
        (F.col("role") == "listing") & F.col("profile_id").isin([p.profile_id for p in profiles])
    )


def _announcements(pages: DataFrame, profiles: Sequence[Profile]) -> DataFrame:
    """The first page of each directory with ``page_count`` (K1-K6), or the numbers it links to (K7)."""
    counted = [p for p in profiles if p.paging and p.paging.kind not in ("next_link", "hrefs")]
    linking = [p for p in profiles if p.paging and p.paging.kind == "hrefs"]
    first = _listing(pages, counted + linking).filter("page_no = 1").select("source_id", "profile_id", "url", "html")
    count = _by_profile(counted, lambda p: page_count(p.paging, "nodes", p.card)) if counted else "CAST(NULL AS BIGINT)"
    links = _by_profile(linking, lambda p: linked_numbers(p.paging)) if linking else "CAST(NULL AS ARRAY<BIGINT>)"
    return parse_pages(first).select(
        "source_id", "profile_id", F.expr(count).alias("page_count"), F.expr(links).alias("page_nos"))


def announced_pages(pages: DataFrame, profiles: Sequence[Profile] = PROFILES) -> DataFrame:
    """K1-K7, K9: one row per page a directory announces on its first page, or links to from there."""
    paged = [p for p in profiles if p.paging and p.paging.kind != "next_link"]
    single = transform("page_nos", lambda n: f"named_struct('lo', {n}, 'hi', {n})")
    pieces = f"if(page_nos IS NULL, {whole_range('page_count')}, {single})"
    return numbered(_announcements(pages, profiles), pieces).select(
        "source_id", "profile_id", "page_no").withColumn("page_url", F.expr(page_address(paged)))


def unreadable_announcements(pages: DataFrame, profiles: Sequence[Profile] = PROFILES) -> DataFrame:
    """Directories whose first page announces a number of pages that cannot be read."""
    return _announcements(pages, profiles).filter("page_count IS NULL AND page_nos IS NULL").select("source_id", "profile_id")


def linked_pages(pages: DataFrame, profiles: Sequence[Profile] = PROFILES) -> DataFrame:
    """K8: the page behind every page with a link to the next one."""
    linked = [p for p in profiles if p.paging and p.paging.kind == "next_link"]
    stored = _listing(pages, linked).select("source_id", "profile_id", "page_no", "html")
    test = _by_profile(linked, lambda p: has_next(p.paging))
    following = parse_pages(stored).filter(F.expr(test)).withColumn("page_no", F.col("page_no").cast("bigint") + 1)
    return following.select("source_id", "profile_id", "page_no").withColumn(
        "page_url", F.expr(page_address(linked))
    )


def next_links(pages: DataFrame, profiles: Sequence[Profile] = PROFILES) -> DataFrame:
    """K8: (source_id, profile_id, page_no, next_page) of every stored page of directories with next links."""
    linked = [p for p in profiles if p.paging and p.paging.kind == "next_link"]
    stored = _listing(pages, linked).select("source_id", "profile_id", "page_no", "html")
    following = _by_profile(linked, lambda p: next_number(p.paging))
    return parse_pages(stored).select("source_id", "profile_id", "page_no", F.expr(following).alias("next_page"))


def link_chains(pages: DataFrame, folder: str, profiles: Sequence[Profile] = PROFILES) -> DataFrame:
    """The pages that next links lead to from page 1, those they do not, and circles (``follow_links``)."""
    return follow_links(next_links(pages, profiles), folder, ("source_id", "profile_id"))


def missing_pages(pages: DataFrame, profiles: Sequence[Profile] = PROFILES) -> DataFrame:
    """Expected pages that are not stored."""
    expected = announced_pages(pages, profiles).unionByName(linked_pages(pages, profiles))
    stored = pages.filter("role = 'listing'").select("source_id", "page_no")
    return expected.join(stored, ["source_id", "page_no"], "left_anti")
