"""Second pages per record (E2-E4, E9): listing rows joined to what their detail pages say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.operators.rules import RECORD_FIELDS


def one_per_key(details: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first stored copy of each detail page.

    ``min_by`` aggregates before the shuffle, so many copies of one page meet as one row per task.
    """
    values = [c for c in details.columns if c not in keys and c not in order]
    first = F.min_by(F.struct(*values), F.struct(*order)).alias("first")
    return details.groupBy(*keys).agg(first).select(*keys, *[f"first.{v}" for v in values])


def never_matching(key: Column, *row_id: Column) -> Column:
    """Rows without a key get one of their own that matches nothing.

    As NULLs they would all hash to one partition of the join.
    """
    own = F.concat(F.lit("\u0000"), F.concat_ws("/", *[c.cast("string") for c in row_id]))
    return F.coalesce(F.nullif(key, F.lit("")), own)


def _pair(source: str, key: Column | str) -> Column:
    return F.concat(F.col(source), F.lit("\n"), key)


def join_details(listing: DataFrame, details: DataFrame, inner_ids: list[str],
                 looked_up: dict[str, list[str]]) -> DataFrame:
    """Left join on (source, key); detail values fill the fields their profile names.

    ``looked_up`` maps a field to the profiles that take it from the detail page. A record whose
    page is missing keeps '' (L2). Profiles in ``inner_ids`` drop such records: there the detail
    page replaces the listing row.
    """
    wanted = [f for f in RECORD_FIELDS if f in looked_up]
    keyed = details.filter(F.col("lookup_key") != "")
    # A key built after the aggregate makes Spark exchange both sides for the join. Only joins
    # right above their exchanges are split at run time when many rows ask for one page.
    right = one_per_key(
        keyed.select("source_id", "lookup_key", "page_no", "url", *wanted),
        ["source_id", "lookup_key"], ["page_no", "url"],
    ).select(
        _pair("source_id", "lookup_key").alias("join_key"), F.lit(True).alias("found"),
        *[F.col(f).alias(f"detail_{f}") for f in wanted],
    )
    own_key = never_matching(F.col("lookup_key"), F.col("page_no"), F.col("card_ord"), F.col("url"))
    left = listing.withColumn("join_key", _pair("source_id", own_key))
    joined = left.join(right, "join_key", "left")
    if inner_ids:
        joined = joined.filter(~F.col("profile_id").isin(inner_ids) | F.col("found").isNotNull())
    filled = {
        f: F.when(F.col("profile_id").isin(looked_up[f]), F.coalesce(f"detail_{f}", F.lit("")))
        .otherwise(F.col(f))
        for f in wanted
    }
    return joined.select(*[filled.get(c, F.col(c)).alias(c) for c in listing.columns])
