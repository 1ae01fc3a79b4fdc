"""Round trips: directories rendered from the base tables, extracted by their profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom.operators import merge
from cardloom.operators.markup import parse_pages
from cardloom.operators.rules import RECORD_FIELDS
from cardloom.operators.scans import block_rows, records_of_blocks
from cardloom.operators.shapes import kept
from cardloom.plans.catalog.base import query
from cardloom.plans.extract import Stores, extract
from cardloom.plans.profiles import BY_ID, MERGE_RUN
from cardloom.plans.rendered import ALL_IDS, MARKUP, detail_pages, expected_sql, listing_pages
from cardloom.sources.layout import shared_folder
from cardloom.sources.registry import source_table

COLUMNS = ("profile_id", "page_no", "school_name", "url", "name", "job_title", "email")
EXTRAS = ("image_url", "department", "phone", "location", "category", "profile_url", "official_website")


def rendered_pages(spark, sf, ids):
    pages = listing_pages(spark, sf, ids)
    if any(MARKUP[i].detail for i in ids):
        pages = pages.unionByName(detail_pages(spark, sf, ids))
    return pages


def rendered_records(spark, sf, ids):
    profiles = [BY_ID[i] for i in ids]
    return extract(rendered_pages(spark, sf, ids), source_table(spark, profiles), profiles)


def _round_trip(name, covers, ids, columns=COLUMNS):
    @query(name, covers, expected_sql(ids, f"SELECT {', '.join(columns)} FROM expected"))
    def run(spark, sf):
        return rendered_records(spark, sf, ids).select(*columns)


_round_trip("card_profiles", "B3 B6 B8 C1 C2 D1", ("pioneer_north_dallas", "clarke_schools_ny", "dallas_international"))
_round_trip("blank_rows_kept", "D4 C7", ("cps", "miami_springs_middle", "muasda", "tamim_miami"))
_round_trip("required_fields", "D2 D3 D5", ("cristo_rey_ny", "efac_chicago", "brightmont_seattle", "seattle_german_american"))
_round_trip("labelled_fields", "J6 C5 C8",
            ("keio_ny", "hamilton_city", "chicagojewishdayschool", "white_settlement", "marymount_ny"),
            COLUMNS + ("location",))
_round_trip("table_cells", "B15 B17 D9 C9", ("sd170", "settles_bridge"))
_round_trip("split_names", "J8 J9 J10 J11 C6",
            ("grace_academy_dallas", "new_york_avenue", "little_miami_board", "dallas_school_district"),
            COLUMNS + ("image_url",))
_round_trip("zipped_lists", "E5 F6", ("chicagocollegiate", "chicagocommons"))
_round_trip("heading_paragraph_pairs", "H1", ("association_house",))
_round_trip("heading_list_runs", "H2", ("toddlertown",))
_round_trip("slot_accumulator", "H3 D7 B9", ("harbor_school_ny",))
_round_trip("text_then_link", "E7 H5 B21", ("miami_r1",))
_round_trip("nested_groups", "B27", ("mater_miami_beach",), COLUMNS + ("category", "profile_url"))
_round_trip("sibling_titles", "B25 B26", ("seattle_academy", "miami_jr_high"))
_round_trip("section_emails", "B24 J12 J16 J17 B19 D6 G2", ("chicagochristian",))
_round_trip("script_addresses", "J19 B7 J20", ("dallas_christian_academy", "montessoriacademychicago"))
_round_trip("profile_page_lookup", "E2 L2 J32 D10 D12",
            ("easterseals_ny", "greater_ny_academy", "dallas_christian_school", "cristo_rey_seattle"))
_round_trip("lookup_by_id", "E3 J18", ("new_york_mills",))
_round_trip("organisation_websites", "E4 E2", ("school_finder",),
            ("profile_id", "page_no", "name", "profile_url", "official_website"))
_round_trip("detail_replaces_listing", "E9 H6 D11", ("lyceechicago",), COLUMNS + ("department", "image_url"))
_round_trip("names_in_parts", "J5 J22 J4", ("seattle_girls", "german_school_chicago", "bridges_seattle", "northwest_montessori"),
            COLUMNS + ("image_url",))
_round_trip("page_urls_kept", "C3 A3", ("d187", "jesuit_dallas", "texans_can_dallas_north"))
_round_trip("phones_and_buttons", "C8 J21 B29", ("melcher_dallas_high", "texans_can_pleasant_grove", "melcher_dallas_high_buttons"),
            COLUMNS + ("phone",))
_round_trip("all_profiles", "A3 C1 C2 L4", ALL_IDS, COLUMNS + EXTRAS)

_ASKED_IDS = ("easterseals_ny", "greater_ny_academy", "new_york_mills", "school_finder", "lyceechicago")
_ASKED_COLUMNS = ("profile_id", "page_no", "name", "email", "profile_url", "official_website")


@query(
    "asked_detail_pages", "E2 E3 E4 E9 L2",
    expected_sql(_ASKED_IDS, f"SELECT {', '.join(_ASKED_COLUMNS)} FROM expected WHERE page_no % 3 = 1"),
)
def asked_detail_pages(spark, sf):
    """Detail pages of everybody are stored, listings of a third: the others are dropped before they are parsed."""
    pages = rendered_pages(spark, sf, _ASKED_IDS).filter("role = 'detail' OR page_no % 3 = 1")
    profiles = [BY_ID[i] for i in _ASKED_IDS]
    return extract(pages, source_table(spark, profiles), profiles, Stores(shared_folder(spark))).select(*_ASKED_COLUMNS)


_SEQUENCE_IDS = ("association_house", "toddlertown", "harbor_school_ny")


@query(
    "sequences_over_rows", "H1 H2 H3",
    expected_sql(_SEQUENCE_IDS, "SELECT profile_id, page_no, name, job_title, email FROM expected"),
)
def sequences_over_rows(spark, sf):
    """Pages dealt over rows of a few blocks each, with state passed from row to row."""
    parts = []
    for i in _SEQUENCE_IDS:
        profile = BY_ID[i]
        parsed = parse_pages(listing_pages(spark, sf, _SEQUENCE_IDS).filter(F.col("profile_id") == i))
        found = records_of_blocks(block_rows(parsed, profile, "profile_id", "page_no"), profile.shape, ("profile_id", "page_no"), 7)
        parts.append(found.select("profile_id", "page_no", F.struct(*RECORD_FIELDS).alias("r")).filter(
            F.expr(kept("r", profile.keep) if profile.keep else "true")).select("profile_id", "page_no", "r.*"))
    return merge.union_all(*parts).select("profile_id", "page_no", "name", "job_title", "email")


_SHARED_IDS = ("seattle_christian", "seattle_prep", "texans_can_dallas_north", "texans_can_pleasant_grove", "harrow_ny")


@query(
    "shared_addresses", "L1",
    expected_sql(_SHARED_IDS, """, stored AS (SELECT DISTINCT base_url || CASE WHEN page_no > 1
            THEN '?page=' || CAST(page_no AS VARCHAR) ELSE '' END AS url, profile_id FROM cards)
, three AS (SELECT * FROM stored UNION SELECT url, 'third_' || profile_id FROM stored WHERE profile_id = 'seattle_prep')
        SELECT url, profile_id AS source_id, sources FROM three
        JOIN (SELECT url, count(*) AS sources FROM three GROUP BY url HAVING count(*) > 1) USING (url)"""),
)
def shared_addresses(spark, sf):
    """Two directories share their addresses, and a third source holds the pages of one of them again."""
    pages = listing_pages(spark, sf, _SHARED_IDS)
    again = pages.filter("profile_id = 'seattle_prep'").withColumn("source_id", F.concat(F.lit("third_"), "source_id"))
    return merge.shared_addresses(pages.unionByName(again))


MERGE_IDS = tuple(i for i, _ in MERGE_RUN)
