"""Stored pages -> records, for any set of profiles.

Input columns: ``source_id, profile_id, role ('listing' | 'detail'), page_no, url, html``.
Extraction is map-only; only records of profiles with a lookup are shuffled, to meet their detail
pages.  Stored with ``partitionBy('role', 'profile_id')`` (see ``sources.layout``) the three
branches below prune to disjoint partitions, so each page's markup is read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cardloom.functions.sql import case, one_of
from cardloom.functions.steps import apply_steps
from cardloom.operators import merge
from cardloom.operators.keyfilter import keep_wanted
from cardloom.operators.lookup import join_details
from cardloom.operators.markup import parse_pages
from cardloom.operators.rules import RECORD_FIELDS, Profile
from cardloom.operators.select import marked
from cardloom.operators.shapes import detail_record, page_records
from cardloom.plans.ledger import recorded
from cardloom.plans.profiles import PROFILES

PAGE_KEYS = ("source_id", "profile_id", "page_no", "url")


def rule_branches(profiles: Sequence[Profile], signature, value) -> tuple[str, dict[str, set[str]]]:
    """One CASE branch per distinct rule set, of which only that of a page's profile is evaluated, and the selectors
    the pages of each profile are to be parsed with."""
    groups: dict[tuple, list[Profile]] = {}
    for p in profiles:
        groups.setdefault(signature(p), []).append(p)
    branches, selectors = [], {}
    for same in groups.values():
        ids = [p.profile_id for p in same]
        with marked() as used:
            branches.append((one_of("profile_id", ids), value(same[0])))
        selectors |= dict.fromkeys(ids, used)
    return case(*branches), selectors


@dataclass(frozen=True)
class Stores:
    """Folders shared by all executors. ``folder`` takes what one run stores; ``ledger`` keeps what runs extracted, so that
    the next one parses only new pages and changed rules."""

    folder: str
    ledger: str | None = None


def _explode(pages: DataFrame, profiles: Sequence[Profile], signature, value, stores: Stores | None = None, part: str = "") -> DataFrame:
    branches, selectors = rule_branches(profiles, signature, value)
    if stores and stores.ledger:
        records = recorded(
            pages, PAGE_KEYS, profiles, signature, branches, selectors, f"{stores.ledger}/{part}", f"{stores.folder}/{part}")
    else:
        ids = [p.profile_id for p in profiles]
        # the filter comes before parsing, where it still reaches the scan
        parsed = parse_pages(pages.filter(F.col("profile_id").isin(ids)).select(*PAGE_KEYS, "html"), selectors=selectors, by="profile_id")
        records = parsed.select(*PAGE_KEYS, F.expr(branches).alias("records"))
    # the outer form: the plain one makes the optimizer test size(records) first, by computing it twice
    return records.select(*PAGE_KEYS, F.inline_outer("records")).filter(F.col("card_ord").isNotNull())


def listing_records(pages: DataFrame, profiles: Sequence[Profile], stores: Stores | None = None, part: str = "plain") -> DataFrame:
    return _explode(
        pages.filter(F.col("role") == "listing"), profiles, Profile.signature,
        lambda p: page_records(p, "nodes"), stores, part,
    )


def wanted_details(pages: DataFrame, profiles: Sequence[Profile], listing: DataFrame) -> DataFrame:
    """Stored detail pages that some listing row may ask for. Their key comes from their address, so the others
    are dropped at the scan, before their markup is moved or parsed."""
    own = pages.filter((F.col("role") == "detail") & F.col("profile_id").isin([p.profile_id for p in profiles]))
    key = F.expr(rule_branches(profiles, lambda p: repr(p.lookup.key), lambda p: apply_steps("url", p.lookup.key))[0])
    asked = listing.select("source_id", "lookup_key").filter("lookup_key <> ''")
    return keep_wanted(own, (F.col("source_id"), key), asked, ("source_id", "lookup_key"))


def detail_records(pages: DataFrame, profiles: Sequence[Profile], listing: DataFrame | None = None,
                   stores: Stores | None = None) -> DataFrame:
    """Records of detail pages, of those only that the stored rows ``listing`` ask for, if given."""
    details = pages.filter(F.col("role") == "detail") if listing is None else wanted_details(pages, profiles, listing)
    return _explode(details, profiles, lambda p: repr(p.lookup), lambda p: detail_record(p, "nodes", "url"), stores, "details")


def raw_records(pages: DataFrame, profiles: Sequence[Profile] = PROFILES, stores: Stores | None = None) -> DataFrame:
    """Records with the fields of their pages, before source constants are attached.

    With ``stores`` listing rows that ask for detail pages are stored first, and only the pages they ask for are parsed;
    with a ledger among them, only pages that no earlier run has seen. Without any nothing runs before the result
    is asked for.
    """
    plain = [p for p in profiles if not p.lookup]
    linked = [p for p in profiles if p.lookup]
    parts = [listing_records(pages, plain, stores)] if plain else []
    if linked:
        looked_up: dict[str, list[str]] = {}
        for p in linked:
            for f in p.lookup.fields:
                looked_up.setdefault(f, []).append(p.profile_id)
        inner_ids = [p.profile_id for p in linked if p.lookup.how == "inner"]
        listing, asked = listing_records(pages, linked, stores, "linked"), None
        if stores:
            listing.write.mode("overwrite").parquet(f"{stores.folder}/listing")
            listing = asked = pages.sparkSession.read.schema(listing.schema).parquet(f"{stores.folder}/listing")
        joined = join_details(listing, detail_records(pages, linked, asked, stores), inner_ids, looked_up)
        if inner_ids:
            joined = joined.filter(~F.col("profile_id").isin(inner_ids) | (F.col("name") != ""))
        parts.append(joined)
    return merge.union_all(*parts)


def extract(pages: DataFrame, sources: DataFrame, profiles: Sequence[Profile] = PROFILES,
            stores: Stores | None = None) -> DataFrame:
    """Records in the common schema, with the constants of their source."""
    return with_sources(raw_records(pages, profiles, stores), sources)


def with_sources(records: DataFrame, sources: DataFrame) -> DataFrame:
    """C1-C3 for records however they were found."""
    records = records.drop("profile_id", "lookup_key")
    joined = merge.attach_sources(records.withColumnRenamed("url", "page_url"), sources)
    return joined.select(
        "source_id", "source_ord", "profile_id", "page_no", "card_ord", "school_name",
        F.when(F.col("url_per_page"), F.col("page_url")).otherwise(F.col("base_url")).alias("url"),
        *[f for f in RECORD_FIELDS if f != "lookup_key"],
    )
