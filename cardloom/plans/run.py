"""A whole merge run: pages of many sources -> stored records, report, ordered result, output files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cardloom.operators import merge
from cardloom.operators.custom import Limits, records_of_extractors
from cardloom.operators.rules import CORE, Profile
from cardloom.plans.extract import Stores, extract, with_sources
from cardloom.plans.profiles import PROFILES
from cardloom.sources import sinks


@dataclass(frozen=True)
class MergeRun:
    records: DataFrame  # all records, unordered
    report: DataFrame  # one row per source
    merged: DataFrame  # records of successful sources, those with an address first


def merge_run(pages: DataFrame, sources: DataFrame, folder: str, profiles: Sequence[Profile] = PROFILES,
              extractors: dict[str, Callable[[dict], list[dict]]] | None = None, ledger: str | None = None,
              limits: Limits = Limits()) -> MergeRun:
    """Extract once into ``folder`` (shared by all executors) and derive the rest from there.

    Report, counts and the global sort (which samples its input before it sorts) would each parse
    all pages again; from the stored records, about a hundredth of the markup, they are cheap, and a
    lost executor costs a re-read, not a re-parse.  The rebalance turns one small file per parse
    task into files of the advisory partition size.

    Sources named in ``extractors`` are read by their function instead of rules (L4), within ``limits``; pages on which
    it fails are counted in the report and cost nobody else anything.

    With a ``ledger`` (a folder that stays between runs) pages are parsed only where no earlier run has read the same
    content by the same rules; ``folder`` is still this run's own. Functions are always called.
    """
    stores = Stores(folder, ledger)
    errors = None
    if extractors:
        by_rules = pages.filter(~F.col("source_id").isin(list(extractors)))
        records_of_extractors(pages, extractors, limits).write.mode("overwrite").parquet(f"{folder}/extracted")
        own = pages.sparkSession.read.parquet(f"{folder}/extracted")
        errors = own.select("source_id", "page_no", "error")
        found = own.filter("error IS NULL").drop("error")
        records = merge.union_all(extract(by_rules, sources, profiles, stores), with_sources(found, sources))
    else:
        records = extract(pages, sources, profiles, stores)
    records.hint("rebalance").write.mode("overwrite").parquet(f"{folder}/records")
    stored = pages.sparkSession.read.parquet(f"{folder}/records")
    merge.run_report(sources, pages.select("source_id"), stored, errors).write.mode("overwrite").parquet(
        f"{folder}/report"
    )
    # read back, the report has a known size, by which Spark may broadcast it
    report = pages.sparkSession.read.parquet(f"{folder}/report")
    return MergeRun(stored, report, merge.email_first(merge.of_successful(stored, report)))


def write_run(run: MergeRun, folder: str) -> None:
    """The merged result as JSON and CSV with the core fields, and the report."""
    core = [(c, c) for c in CORE]
    sinks.write_json(run.merged, f"{folder}/merged_json", core)
    sinks.write_json_array(run.merged, f"{folder}/merged_array", [F.desc(merge.has_email()), *merge.ORDER], f"{folder}/scratch", core)
    sinks.write_csv(run.merged, f"{folder}/merged_csv", core)
    sinks.write_per_source(run.records, f"{folder}/per_source", "json")
    sinks.write_csv(run.report, f"{folder}/report_csv")
