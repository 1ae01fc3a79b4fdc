"""Readers for stored tables (A1-A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of a table of pages, and of one with a small page a row, that one task parses.
PAGES_PER_TASK, CARDS_PER_TASK = 1_000, 10_000


def spread(rows: DataFrame, per_task: int = CARDS_PER_TASK) -> DataFrame:
    """Deal a table over tasks of about ``per_task`` rows each, at least one per core, before markup is made or parsed.

    Splits of a file say nothing about rows: a file with one row group is read by one task however many splits it has.
    Rows are dealt by their place, as keys may be null or repeat; moving them costs far less than parsing. The count
    reads no columns.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-rows.count() // per_task)), F.monotonically_increasing_id())


def parse_parts(spark: SparkSession) -> int:
    """Number of partitions for pages that come out of a shuffle.

    Given explicitly, because the adaptive plan would merge partitions by their bytes, and parsing
    costs far more per byte than what it usually merges.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A1, A2: the ``pages`` table."""
    return spread(table(spark, folder, "pages"), PAGES_PER_TASK)
