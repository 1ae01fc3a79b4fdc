"""The source registry (A4): which profile reads which directory, and under which name."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cardloom.operators.rules import Profile


def source_table(spark: SparkSession, profiles: Iterable[Profile],
                 labels: dict[str, str] | None = None) -> DataFrame:
    """One row per source.

    Built from an Arrow table, so Spark plans it as a local relation of known size and decides by
    that size whether a join may broadcast it.
    """
    labels = labels or {}
    rows = [
        (p.profile_id, n, labels.get(p.profile_id, p.school_name), p.school_name, p.url, p.profile_id,
         p.url_per_page, p.when_empty, p.empty_message)
        for n, p in enumerate(profiles)
    ]
    names = ["source_id", "source_ord", "label", "school_name", "base_url", "profile_id",
             "url_per_page", "when_empty", "empty_message"]
    types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(),
             pa.string(), pa.string()]
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    return spark.createDataFrame(pa.table(columns, names=names))
