"""Record sinks (A5-A13). Every writer works in parallel and writes a folder of part files."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardloom.functions import text as tx
from cardloom.operators.ordinal import with_place
from cardloom.operators.rules import CORE, Profile

CSV_OPTIONS = dict(header=True, quoteAll=True, escape='"', emptyValue="", nullValue="",
                   ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def blank_filled(records: DataFrame) -> DataFrame:
    """C4: NULL leaves as ''."""
    return records.na.fill("")


def with_fields(records: DataFrame, fields: list[tuple[str, str]] | None) -> DataFrame:
    """The declared fields only, in their order and under their own names; None keeps all."""
    if fields is None:
        return records
    return records.select(*[F.col(column).alias(name) for name, column in fields])


def write_csv(records: DataFrame, folder: str, fields: list[tuple[str, str]] | None = None) -> None:
    """All fields quoted, quotes doubled; a header also without rows."""
    blank_filled(with_fields(records, fields)).write.mode("overwrite").options(**CSV_OPTIONS).csv(folder)


def write_json(records: DataFrame, folder: str, fields: list[tuple[str, str]] | None = None) -> None:
    """One JSON object per line, blanks kept."""
    blank_filled(with_fields(records, fields)).write.mode("overwrite").json(folder)


def write_json_array(records: DataFrame, folder: str, order: list[Column | str], scratch: str,
                     fields: list[tuple[str, str]] | None = None) -> None:
    """A5: the records in ``order`` as one JSON array, an object a line, in parts that joined by name are valid JSON.

    Every row knows its place (``with_place``, which stores the rows in ``scratch``), so the first one opens the array, the
    last one closes it, and all parts are written in parallel. Blanks are kept. No records give ``[]``.
    """
    spark = records.sparkSession
    declared = fields or [(c, c) for c in records.columns]
    lines = records.select(F.to_json(
        F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) if dict(records.dtypes)[c] == "string" else F.col(c).alias(name)
                   for name, c in declared]), {"ignoreNullFields": "false"}).alias("line"), *[F.col(c) for c in records.columns])
    placed = with_place(lines, order, scratch)
    total = spark.read.parquet(f"{scratch}/sorted").count()
    if total == 0:
        spark.range(1, numPartitions=1).select(F.lit("[]").alias("value")).write.mode("overwrite").text(folder)
        return
    # stored rows keep their order within a file, and files are read in parts; a range sort puts them back
    framed = F.concat(F.when(F.col("place") == 1, "[\n").otherwise(""), "line", F.when(F.col("place") == total, "\n]").otherwise(","))
    placed.select("place", framed.alias("value")).orderBy("place").select("value").write.mode("overwrite").text(folder)


_COPY_BYTES = 8 << 20


def merge_parts(spark: SparkSession, folder: str, target: str) -> None:
    """The part files of ``folder`` joined by name into the file ``target``, copied in parallel.

    Every part knows where it begins in the whole, and tasks write there. Both must be on a file system that the
    driver and all workers have mounted (a path or a ``file:`` address). The file appears under its name when it is whole.
    """
    import os
    from pathlib import Path
    from uuid import uuid4

    plain = lambda address: Path(address.removeprefix("file://").removeprefix("file:"))
    parts = sorted(plain(folder).glob("part-*"))
    sizes = [p.stat().st_size for p in parts]
    unfinished = plain(target).with_name(f".{plain(target).name}-{uuid4().hex}")
    with open(unfinished, "wb") as out:
        out.truncate(sum(sizes))
    rows = [(str(p), at, n) for p, at, n in zip(parts, accumulate([0, *sizes]), sizes) if n]

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(unfinished, "r+b") as out:
            for batch in batches:
                for part, at, size in zip(*(c.to_pylist() for c in batch.columns)):
                    out.seek(at)
                    with open(part, "rb") as given:
                        while block := given.read(_COPY_BYTES):
                            out.write(block)
                    yield pa.RecordBatch.from_arrays([pa.array([size])], names=["copied"])

    if rows:
        dealt = spark.createDataFrame(rows, "part string, at long, size long").repartition(len(rows), "part")
        copied = dealt.mapInArrow(copy, "copied long").agg(F.sum("copied")).first()[0]
        if copied != sum(sizes):
            raise OSError(f"{folder}: {copied} of {sum(sizes)} bytes were copied")
    os.replace(unfinished, plain(target))


def write_per_source(records: DataFrame, folder: str, form: str = "csv",
                     key: str = "source_id") -> None:
    """One output folder per source, in one pass; a source too large for one file gets several."""
    writer = blank_filled(records).hint("rebalance", F.col(key)).write.mode("overwrite").partitionBy(key)
    if form == "csv":
        writer.options(**CSV_OPTIONS).csv(folder)
    else:
        writer.json(folder)


def write_profile(records: DataFrame, profile: Profile, folder: str) -> None:
    """A single directory under its own field names."""
    own = records.filter(F.col("profile_id") == profile.profile_id)
    write_csv(own, f"{folder}/csv", list(profile.columns))
    write_json(own, f"{folder}/json", list(profile.columns))


def csv_lines(records: DataFrame, fields: tuple[str, ...] = CORE) -> DataFrame:
    """A record as one CSV line, correctly quoted."""
    return records.select(*_keys(records, fields), F.expr(
        "concat_ws(',', " + ", ".join(tx.csv_field(f) for f in fields) + ")").alias("line"))


def _keys(records: DataFrame, fields: tuple[str, ...]) -> list[str]:
    return [c for c in records.columns if c not in fields]


def masked(records: DataFrame) -> DataFrame:
    """Hide the user part of addresses before records leave the cluster."""
    return records.withColumn("email", F.expr(tx.mask_email("email")))
