"""Stored forms of pages, parsed pages and records."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder every executor can reach.

    The place is the one the session names in ``spark.checkpoint.dir``, or else the checkpoint folder
    set on its context. Without either a temporary folder is right only where driver and executors are
    one process; on a cluster that is an error, since each executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _context_folder(spark)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local") or "cluster" in spark.conf.get("spark.master", ""):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="cardloom-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/cardloom-{uuid4().hex}"


def _context_folder(spark: SparkSession) -> str | None:
    context = getattr(spark, "sparkContext", None)
    return context.getCheckpointDir() if context is not None else None


def write_pages(pages: DataFrame, folder: str) -> None:
    """Stored pages by role and profile, so that each branch of an extraction reads only its own.

    The rebalance brings the pages of a profile together and, at run time, splits a profile that is
    larger than the advisory partition size: one huge directory becomes many files.
    """
    keyed = pages.hint("rebalance", F.col("role"), F.col("profile_id"))
    keyed.write.mode("overwrite").partitionBy("role", "profile_id").parquet(folder)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def write_nodes(parsed: DataFrame, folder: str) -> None:
    """B1 written once, for several passes over the same elements."""
    parsed.write.mode("overwrite").parquet(folder)
