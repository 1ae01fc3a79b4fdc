"""Time the headline queries at ``$BENCH_SF_DIR``; prints one JSON line.

Every query is forced to completion with Spark's ``noop`` writer, planning included.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from cardloom.plans.catalog import CATALOG

QUERIES = (
    "page_titles", "nodes_by_tag", "nav_links", "distinct_links", "clean_text", "find_emails",
    "first_of_each_key", "select_by_attribute", "relatives", "page_counts", "missing_pages",
    "card_profiles", "section_emails", "slot_accumulator", "profile_page_lookup", "csv_core_fields",
    "run_report", "merge_run", "all_profiles", "announced_pages", "directory_gaps", "labelled_fields",
    "element_source", "element_rows", "copies_of_one_page", "output_per_source",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).mapInPandas(lambda parts: parts, "id long").count()  # start the Python workers
    CATALOG["page_titles"].run(spark, folder).write.format("noop").mode("overwrite").save()  # not counted
    seconds = {}
    for name in QUERIES:
        start = time.perf_counter()
        CATALOG[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
