"""How tables are dealt over tasks."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cardloom.sources.tables import PAGES_PER_TASK, spread, stored_pages


def _largest(frame):
    held = frame.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()
    return held[0], held[1]


@pytest.mark.parametrize("key", [None, 1])
def test_a_file_with_one_row_group_is_dealt_by_rows(spark, tmp_path, key):
    n = 12 * PAGES_PER_TASK
    pages = pa.table({"page_id": pa.array([key] * n, pa.int64()), "url": [f"u{i}" for i in range(n)], "html": ["<p>x</p>"] * n})
    pq.write_table(pages, tmp_path / "pages.parquet", row_group_size=n)
    dealt = stored_pages(spark, str(tmp_path))
    assert dealt.columns == ["page_id", "url", "html"] and dealt.count() == n
    tasks, most = _largest(dealt)
    assert tasks == 12 and most < 2 * PAGES_PER_TASK


def test_an_empty_table_is_dealt(spark):
    assert spread(spark.createDataFrame([], "a int")).count() == 0
