"""Directories read page by page until the first empty one (K10), without reading on behind it.

Stored pages are parsed in blocks of page numbers that grow by a factor. After each block a frontier of directories that
showed no empty page yet and have further pages goes on; the others are dropped at the scan of the next block, before
their markup is moved. A directory of n pages takes about log(n) blocks, and no more than the block its end lies in is
parsed behind it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cardloom.functions.sql import struct
from cardloom.operators import select as sel
from cardloom.operators.keyfilter import keep_wanted
from cardloom.operators.markup import parse_pages
from cardloom.operators.rules import Profile
from cardloom.operators.shapes import page_records
from cardloom.plans.extract import PAGE_KEYS, rule_branches

FIRST_BLOCK, GROWTH = 4, 4


def _cards_and_records(p: Profile) -> str:
    records = page_records(p, "nodes")
    cards = f"size({sel.find('nodes', None, p.card)})" if p.card else f"size({records})"
    return struct(cards=cards, records=records)


def read_until_empty(pages: DataFrame, profiles: Sequence[Profile], folder: str, first: int = FIRST_BLOCK,
                     growth: int = GROWTH) -> tuple[DataFrame, DataFrame]:
    """Records of the pages before each source's first page without cards, and (source_id, page_no, cards) of all pages
    that were parsed.

    ``folder``, shared by all executors, takes the blocks, so a lost executor costs a re-read. Pages without a number
    have no place in a directory and are not read. If copies of a page are stored, one without cards ends it.
    """
    spark = pages.sparkSession
    branches, selectors = rule_branches(profiles, Profile.signature, _cards_and_records)
    listing = pages.filter((F.col("role") == "listing") & F.col("profile_id").isin([p.profile_id for p in profiles]))

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    # page numbers alone, no markup
    going = written(listing.filter("page_no IS NOT NULL").groupBy("source_id").agg(F.max("page_no").alias("last")), "going_0")
    before, upto, blocks, parts = None, first, [], []
    while not going.isEmpty():
        inside = F.col("page_no") <= upto
        if before is not None:
            inside = inside & (F.col("page_no") > before)
        asked = keep_wanted(listing.filter(inside), (F.col("source_id"),), going, ("source_id",))
        parsed = parse_pages(asked.select(*PAGE_KEYS, "html"), selectors=selectors, by="profile_id")
        found = parsed.select(*PAGE_KEYS, F.expr(branches).alias("found")).select(*PAGE_KEYS, "found.*")
        block = written(found, f"block_{len(blocks)}")
        blocks.append(block.select("source_id", "page_no", "cards"))
        ends = block.filter("cards = 0").groupBy("source_id").agg(F.min("page_no").alias("stop"))
        kept = block.join(going.select("source_id"), "source_id", "left_semi").join(ends, "source_id", "left").filter(
            "stop IS NULL OR page_no < stop")
        parts.append(kept.select(*PAGE_KEYS, F.inline_outer("records")).filter("card_ord IS NOT NULL"))
        going = written(going.filter(F.col("last") > upto).join(ends, "source_id", "left_anti"), f"going_{len(blocks)}")
        before, upto = upto, upto * growth
    if not parts:
        empty = parse_pages(listing.filter("false").select(*PAGE_KEYS, "html"), selectors=selectors, by="profile_id")
        none = empty.select(*PAGE_KEYS, F.expr(branches).alias("found")).select(*PAGE_KEYS, "found.*")
        return none.select(*PAGE_KEYS, F.inline("records")), none.select("source_id", "page_no", "cards")
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    return union(parts), union(blocks)
