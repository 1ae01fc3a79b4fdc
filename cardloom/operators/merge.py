"""Records of all sources -> one ordered, counted result with a run report (C, D14-D17, F, G, I, L)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.functions import text as tx

ORDER = ("source_ord", "page_no", "card_ord")


def has_email(email: str = "email") -> Column:
    """D17."""
    return F.expr(tx.not_blank(email))


def attach_sources(records: DataFrame, sources: DataFrame) -> DataFrame:
    """Constants of the source. No hint: Spark broadcasts the registry if its size allows."""
    return records.join(sources, "source_id")


def union_all(*parts: DataFrame) -> DataFrame:
    """Missing extras become NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def first_of_each(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first record per key in the given order.

    An aggregate, not a window: each task reduces its rows first, so a key that holds a third of all
    rows is no hot spot.
    """
    rest = [c for c in records.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    return (
        records.groupBy(*keys).agg(first).select(*keys, *[f"first.{c}" for c in rest])
        .select(*records.columns)
    )


def distinct_links(links: DataFrame, keys: list[str], link: str, order: str) -> DataFrame:
    """Distinct links with the position where each was first seen."""
    return links.groupBy(*keys, link).agg(F.min(order).alias(order))


def email_first(records: DataFrame) -> DataFrame:
    """Records with an address first, otherwise source, page and card order."""
    return records.orderBy(F.desc(has_email()), *ORDER)


def in_order(records: DataFrame) -> DataFrame:
    """I2."""
    return records.orderBy(*ORDER)


def counts(records: DataFrame, *by: str) -> DataFrame:
    """rows, with and without an address."""
    with_email = F.count_if(has_email())
    return records.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"),
        with_email.alias("with_email"),
        (F.count(F.lit(1)) - with_email).alias("without_email"),
    )


def page_errors(errors: DataFrame) -> DataFrame:
    """L1: failed pages and the first message of each source, from (source_id, page_no, error)."""
    return errors.filter("error IS NOT NULL").groupBy("source_id").agg(
        F.count("*").alias("failed_pages"), F.min(F.struct("page_no", "error"))["error"].alias("page_error"))


def run_report(sources: DataFrame, pages: DataFrame, records: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One row per source, whatever happened to it.

    A source fails if none of its pages is stored, if pages failed and none gave a record, or if it has no
    records and its profile says so. ``errors``: (source_id, page_no, error) of pages that failed.
    """
    stored = pages.groupBy("source_id").agg(F.count(F.lit(1)).alias("pages"))
    found = counts(records, "source_id")
    joined = sources.join(stored, "source_id", "left").join(found, "source_id", "left")
    if errors is None:
        joined = joined.withColumns({"failed_pages": F.lit(0).cast("bigint"), "page_error": F.lit(None).cast("string")})
    else:
        joined = joined.join(page_errors(errors), "source_id", "left")
    n, n_pages, n_failed = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("records", "pages", "failed_pages"))
    status = (
        F.when(n_pages == 0, "failed").when(n > 0, "ok").when(n_failed > 0, "failed").otherwise(F.col("when_empty"))
    )
    error = (
        F.when(n_pages == 0, "no stored page")
        .when(n_failed > 0, F.col("page_error"))
        .when((n == 0) & (F.col("when_empty") == "failed"), F.col("empty_message"))
        .otherwise("")
    )
    return joined.select(
        "source_id", "source_ord", "label", n_pages.alias("pages"), n_failed.alias("failed_pages"), n.alias("records"),
        F.coalesce("with_email", F.lit(0)).alias("with_email"),
        status.alias("status"), (status != "failed").alias("success"), error.alias("error"),
    )


def shared_addresses(pages: DataFrame) -> DataFrame:
    """L1: page addresses stored under more than one source, one row per address and source.

    Pairs are counted after each task has made its own distinct, so an address that many pages share
    is no hot spot.
    """
    held = pages.select("url", "source_id").distinct()
    shared = held.groupBy("url").agg(F.count("*").alias("sources")).filter("sources > 1")
    return held.join(shared, "url").select("url", "source_id", "sources")


def run_totals(report: DataFrame, *by: str) -> DataFrame:
    """successes and failures, overall or per batch."""
    return report.groupBy(*by).agg(
        F.count_if("success").alias("successful"), F.count_if(~F.col("success")).alias("failed")
    )


def failures(report: DataFrame) -> DataFrame:
    """F7."""
    return report.filter(~F.col("success")).select("label", "error")


def of_successful(records: DataFrame, report: DataFrame) -> DataFrame:
    """L3: only successful sources feed the merge."""
    return records.join(report.filter("success").select("source_id"), "source_id", "left_semi")
