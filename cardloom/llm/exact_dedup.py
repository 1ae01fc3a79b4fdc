"""Exact dedup by skew-safe combining (DataFrame functions only).

Equal texts are combined in three stages, and each groups by the full text next to its digest:

1. every task combines the rows it reads (the map side of the first aggregation),
2. digest groups are merged per salt, so that a text held by a third of all rows is spread,
3. the winners of the salts, at most ``salts`` per text, are combined globally.

Rows find their group through the digest alone, without moving texts again. That is right only if a
digest belongs to one text, which the third stage knows: it has one row per digest *and* text. Should
two texts ever share a digest, the rows are joined by digest and full text instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.llm.common import ascii_lower, shared_folder, stored, text_of

SALTS = 16


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z; null counts as empty. The largest id of a
    group stays. Ids are compared as they are; a null id is smaller than any other, and a group of
    null ids keeps null. Rows that repeat an id and a text are the same document: they share one
    decision and count in ``group_size``. Other columns of ``docs`` are ignored, whatever their names.
    An empty table gives an empty table.
    """
    norm = ascii_lower(text_of(text_col))
    rows = docs.select(F.col(id_col).alias("id"), norm.alias("norm")).withColumn("digest", F.unhex(F.sha2("norm", 256)))
    salted = rows.groupBy("digest", "norm", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")).agg(
        F.max("id").alias("id"), F.count("*").alias("n")
    )
    merged = salted.groupBy("digest", "norm").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
    folder = shared_folder(docs.sparkSession)
    groups = stored(merged.select("digest", "keep_id", "group_size"), folder, "groups")
    on = ["digest"]
    if not groups.groupBy("digest").count().filter("count > 1").isEmpty():
        groups, on = merged, ["digest", "norm"]
    return rows.select("id", *on).join(groups, on).select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat an id and a text, one."""
    folder = shared_folder(docs.sparkSession)
    judged = stored(exact_groups(docs, id_col, text_col).select("id", "kept", F.col("text_sha256").alias("sha")), folder, "judged")
    gone = judged.filter("not kept").distinct()
    sha = F.sha2(ascii_lower(text_of(text_col)), 256)
    left = docs.join(gone, F.col(f"`{id_col}`").eqNullSafe(gone["id"]) & (sha == gone["sha"]), "left_anti")
    return one_of_repeated(left, judged.filter("kept"), F.col(f"`{id_col}`"), sha, id_col)


def one_of_repeated(rows: DataFrame, judged: DataFrame, id_of: Column, name_of: Column, id_col: str) -> DataFrame:
    """``rows`` with one of those that share an id and the name of their text. ``judged`` has (id, sha) of all of them, so that
    only repeated rows, if there are any, are moved."""
    repeated = judged.groupBy(F.col("id").alias("_id"), F.col("sha").alias("_sha")).count().filter("count > 1").drop("count")
    if repeated.isEmpty():
        return rows
    on = id_of.eqNullSafe(F.col("_id")) & (name_of == F.col("_sha"))
    own = [c for c in rows.columns if c != id_col]
    again = rows.join(repeated, on).groupBy("_id", "_sha").agg(F.first(F.struct(*[F.col(f"`{c}`") for c in own])).alias("_row"))
    again = again.select(*[F.col("_id").alias(c) if c == id_col else F.col("_row")[c].alias(c) for c in rows.columns])
    return rows.join(repeated, on, "left_anti").unionByName(again)
