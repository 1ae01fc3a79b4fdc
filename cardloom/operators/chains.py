"""Chains of next links (K8): which pages a directory's first page leads to, which not, and where links run in circles.

Every page links to one next page at most. Following links one by one would take a job per page of the longest directory, so
jumps are doubled: from where ``span`` links lead, ``2 * span`` links lead by one join of the jumps with themselves.
The joins are on (directory, page), so a directory that holds most pages is spread like any other, and sorted on both
sides: written rows look small enough to be broadcast in every round, which would pass them through the driver. Each round is
written to the shared folder and read back: a lost executor costs a re-read, and plans do not grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _written(frame: DataFrame, folder: str, name: str) -> DataFrame:
    frame.write.mode("overwrite").parquet(f"{folder}/{name}")
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{folder}/{name}").hint("merge")


def follow_links(links: DataFrame, folder: str, keys: tuple[str, ...] = ("source_id",), page: str = "page_no",
                 following: str = "next_page", first: int = 1) -> DataFrame:
    """One row per directory and stored page: ``keys``, page, next page, ``stored_next``, ``steps``, ``reached``, ``cycle``.

    ``links`` has a row per stored page; ``following`` is NULL where the links end. Of several copies of a page the
    least next page counts. ``steps`` is the number of links from page ``first``, NULL if it is not ``reached``;
    ``cycle`` is the least page of the circle a page is on, NULL if it is on none; ``stored_next`` tells whether the next
    page is stored (NULL without one). Rows without a page are left out, as nothing can lead to them. An empty table
    gives an empty table.
    """
    on = [*keys, "page"]
    pages = _written(
        links.filter(F.col(page).isNotNull()).groupBy(*keys, F.col(page).cast("bigint").alias("page"))
        .agg(F.min(F.col(following).cast("bigint")).alias("next")), folder, "chain_pages")
    there = pages.select(*keys, F.col("page").alias("next"), F.lit(True).alias("stored_next"))
    jumps = _written(
        pages.filter("next IS NOT NULL").join(there, [*keys, "next"], "left_semi")
        .select(*on, F.col("next").alias("to"), F.least("page", "next").alias("low")), folder, "jumps_0")
    reached = pages.filter(F.col("page") == first).select(*on, F.lit(0).cast("bigint").alias("steps"))
    longest = pages.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    span, turn = 1, 0
    while span < 2 * longest and not jumps.isEmpty():  # what is left behind the longest chain runs in circles
        turn += 1
        ahead = reached.join(jumps, on).select(*keys, F.col("to").alias("page"), (F.col("steps") + span).alias("steps"))
        reached = _written(reached.unionByName(ahead).groupBy(*on).agg(F.min("steps").alias("steps")), folder, f"reached_{turn}")
        second = jumps.select(*keys, F.col("page").alias("to"), F.col("to").alias("further"), F.col("low").alias("lower"))
        jumps = _written(
            jumps.join(second, [*keys, "to"]).select(*on, F.col("further").alias("to"), F.least("low", "lower").alias("low")),
            folder, f"jumps_{turn}")
        span *= 2
    # after that many links everyone is on a circle, and everyone on a circle is somebody's target
    on_circle = jumps.select(*keys, F.col("to").alias("page")).distinct()
    circles = jumps.join(on_circle, on, "left_semi").select(*on, F.col("low").alias("cycle")).hint("merge")
    found = pages.join(there, [*keys, "next"], "left").join(reached, on, "left").join(circles, on, "left")
    return found.select(
        *keys, F.col("page").alias(page), F.col("next").alias(following),
        F.when(F.col("next").isNotNull(), F.coalesce("stored_next", F.lit(False))).alias("stored_next"),
        "steps", F.col("steps").isNotNull().alias("reached"), "cycle")


def chain_report(chains: DataFrame, keys: tuple[str, ...] = ("source_id",)) -> DataFrame:
    """Per directory: stored pages, those its first page leads to and not, pages on circles, circles, and links from
    reached pages to pages that are not stored."""
    return chains.groupBy(*keys).agg(
        F.count("*").alias("stored"), F.count_if("reached").alias("reached"), F.count_if(~F.col("reached")).alias("unreached"),
        F.count("cycle").alias("on_circles"), F.count_if(F.col("cycle") == F.col("page_no")).alias("circles"),
        F.count_if(F.col("reached") & ~F.coalesce("stored_next", F.lit(True))).alias("open_ends"))
