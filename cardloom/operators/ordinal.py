"""The place of every row in one global order (H4, I1-I3), without a task that sees all rows.

A sort deals ranges of rows over partitions; stored with the number of its partition and its row there, every row's
place is the rows of the partitions before it plus its own. Only one count per partition is looked at as a whole.
"""

from __future__ import annotations

from itertools import accumulate
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

_ROW_BITS = 33  # of monotonically_increasing_id, below the number of the partition


def with_place(frame: DataFrame, order: list[Column | str], folder: str, name: str = "place") -> DataFrame:
    """``frame`` with a column ``name``: 1 for the first row in ``order``, and so on without gaps.

    Rows that are equal in ``order`` stand in some order, the same whenever the result is read, as the sorted rows are
    stored in ``folder`` (shared by all executors). Nulls go first, as Spark sorts them. An empty table stays empty.
    """
    spark = frame.sparkSession
    own = uuid4().hex  # no column of the frame has these names
    at, part, before = f"_at_{own}", f"_part_{own}", f"_before_{own}"
    marked = frame.orderBy(*order).withColumn(at, F.monotonically_increasing_id())
    marked.write.mode("overwrite").parquet(f"{folder}/sorted")
    rows = spark.read.schema(marked.schema).parquet(f"{folder}/sorted")
    partition = F.shiftright(at, _ROW_BITS)
    counts = sorted(map(tuple, rows.groupBy(partition.alias(part)).count().collect()))  # a row per partition
    starts = [0, *accumulate(n for _, n in counts)]
    # a local relation: Spark knows its size
    ahead = spark.createDataFrame(pa.table({
        part: pa.array([p for p, _ in counts], pa.int64()), before: pa.array(starts[:len(counts)], pa.int64())}))
    place = F.col(before) + F.col(at) - F.shiftleft(part, _ROW_BITS) + 1
    return rows.join(ahead, partition == F.col(part)).select(*frame.columns, place.alias(name))
