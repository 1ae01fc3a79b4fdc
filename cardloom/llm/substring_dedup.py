"""Substring dedup by compaction of a de Bruijn graph of token k-mers.

Edges of the graph are k-mers of words. Of the k-mers inside a window of ``SPAN`` words the one with the
smallest hash stands for the window, so equal windows have the same edge at the same offset. Consecutive
windows with one edge form a *piece* of a document: the path through that edge from one branching point
to the next, named by the hash of its words.

* A piece that occurs in several documents is a repeated path without a branch: it is one record, not one
  per window. A join with the first document that has it gives its source coordinates, and neighbouring
  pieces with the same source and shift are compacted into one long span.
* An edge with different pieces branches. Only the first document of each of its pieces is cut into
  windows; these are matched by 128 bits of SHA-256.
* Long spans are verified by their source coordinates: 128 bits of SHA-256 of the words there must equal
  those of the words to be removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardloom.llm.common import WordCodes, discard, join_rows, keyed, mixed, shared_folder, stored

SPAN = 50
KMER = 16
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ROWS = 1 << 16  # rows of an output batch


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 to base^n modulo 2^64."""
    factors = np.full(n + 1, base)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Hasher:
    """Hashes of any stretch of a list of words, from sums over its prefixes."""

    def __init__(self):
        self.codes = WordCodes()
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def prefixes(self, words: list[bytes]) -> np.ndarray:
        n = len(words)
        if len(self.up) <= n:
            self.up, self.down = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.codes(words) * self.up[:n], dtype=np.uint64, out=sums[1:])
        return sums

    def stretch(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.down[start])


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value, the first of equal ones, in every window of ``width`` values."""
    low, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        right, here = low[step:], slice(0, len(low) - step)
        better = right < low[here]
        at = np.where(better, at[step:], at[here])
        low = np.where(better, right, low[here])
        have += step
    return at


def pieces(words: list[bytes], hasher: Hasher, span: int = SPAN, kmer: int = KMER) -> tuple[np.ndarray, ...]:
    """(edge, name, start, windows) of each piece; a piece with s windows has s + span - 1 words."""
    n = len(words)
    if n < span:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    sums = hasher.prefixes(words)
    begin = np.arange(n - kmer + 1)
    grams = hasher.stretch(sums, begin, begin + kmer)
    at = _first_least(grams, span - kmer + 1)
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    end = np.concatenate([start[1:], [len(at)]])
    return grams[at[start]], hasher.stretch(sums, start, end + span - 1), start, end - start


def _split(text: str) -> list[bytes]:
    return text.encode().split()  # at \x20 and \x09-\x0D


def _digest(words: list[bytes]) -> bytes:
    """Half of a SHA-256: 128 bits tell stretches of words apart."""
    return sha256(b" ".join(words)).digest()[:16]


def _all_pieces(rows: DataFrame, span: int, kmer: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            done, count = [], 0
            for i in range(batch.num_rows):
                found = pieces(_split(batch.column(2)[i].as_py()), hasher, span, kmer)
                done.append((i, *found))
                count += len(found[0])
                if count >= _ROWS or i == batch.num_rows - 1:
                    which = pa.array(np.repeat([d[0] for d in done], [len(d[1]) for d in done]).astype(np.int64))
                    edge, name, start, windows = (np.concatenate([d[j] for d in done]) for j in range(1, 5))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(which), batch.column(1).take(which), pa.array(edge.view(np.int64)),
                         pa.array(name.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32))],
                        ["id", "key", "edge", "name", "start", "windows"])
                    done, count = [], 0

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"id {kind}, key long, edge long, name long, start int, windows int")


def _read_stretches(rows: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """Digests of stretches of documents. ``wanted``: (of_id, of_key, wants array<(start, size, cut)>); if cut, each
    window of the stretch is read, else all of it. Gives (id, key, start, size, digest, cut)."""
    kind = rows.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["which", "start", "size", "digest", "cut"]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for i, (text, wants) in enumerate(zip(batch.column(2), batch.column(3))):
                words = _split(text.as_py())
                for want in wants.as_py():
                    start, size, cut = want["start"], want["size"], want["cut"]
                    starts = range(start, start + size - span + 1) if cut else (start,)
                    length = span if cut else size
                    for s in starts:
                        for column, x in zip(out, (i, s, length, _digest(words[s:s + length]), cut)):
                            column.append(x)
                if len(out[0]) >= _ROWS or i == batch.num_rows - 1:
                    which = pa.array(out[0], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(which), batch.column(1).take(which), pa.array(out[1], pa.int32()),
                         pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary()), pa.array(out[4], pa.bool_())],
                        ["id", "key", *names[1:]])
                    out = [[] for _ in names]

    return join_rows(rows, wanted, "inner").mapInArrow(
        read, f"id {kind}, key long, start int, size int, digest binary, cut boolean")


def _later(first: Column) -> Column:
    return F.col("id") > first["id"]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, kmer: int = KMER) -> DataFrame:
    """(id, key, start, size, digest, source_id, source_start): stretches of words that also stand in a document with a
    smaller id, with the digest that the words must have; together they cover every repeated window."""
    folder = shared_folder(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    every = stored(_all_pieces(rows.filter(F.col("id").isNotNull()), span, kmer), folder, "pieces")
    paths = every.groupBy("edge", "name").agg(F.min(F.struct("id", "key", "start")).alias("first"), F.max("id").alias("last"))
    branching = paths.groupBy("edge").agg(
        F.count("*").alias("ways"), F.min(F.col("first")["id"]).alias("low"), F.max("last").alias("high"),
    ).filter("ways > 1 AND low < high").select("edge", F.lit(True).alias("branches"))
    wanted = paths.join(branching, "edge", "left").filter(F.col("branches") | (F.col("first")["id"] < F.col("last")))
    met = stored(every.join(wanted, ["edge", "name"]).drop("edge", "name", "last"), folder, "met")
    discard(docs.sparkSession, folder, "pieces")

    # repeated paths: neighbours with one source and shift become one span
    along = Window.partitionBy("id", "key", "source_id", "source_key", "shift").orderBy("start")
    before = F.max(F.col("start") + F.col("windows")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        met.filter(_later(F.col("first")))
        .select("id", "key", "start", "windows", F.col("first")["id"].alias("source_id"), F.col("first")["key"].alias("source_key"),
                (F.col("first")["start"] - F.col("start")).alias("shift"))
        .withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1))
        .withColumn("run", F.sum("new").over(along))
        .groupBy("id", "key", "source_id", "source_key", "shift", "run")
        .agg(F.min("start").alias("start"), (F.max(F.col("start") + F.col("windows")) - F.min("start") + span - 1).alias("size"))
    )
    runs = stored(runs.select("id", "key", "start", "size", "source_id", "source_key",
                              (F.col("start") + F.col("shift")).alias("source_start")), folder, "runs")

    # one reading of the documents that are sources of spans or have branches to be cut into windows
    sources = runs.select(F.col("source_id").alias("of_id"), F.col("source_key").alias("of_key"), F.col("source_start").alias("start"),
                          "size", F.lit(False).alias("cut")).distinct()
    cuts = met.filter(F.col("branches") & (F.col("id") == F.col("first")["id"])).select(
        F.col("id").alias("of_id"), F.col("key").alias("of_key"), "start", (F.col("windows") + span - 1).alias("size"), F.lit(True).alias("cut"))
    wants = sources.unionByName(cuts).groupBy("of_id", "of_key").agg(F.collect_list(F.struct("start", "size", "cut")).alias("wants"))
    read = stored(_read_stretches(rows, wants, span), folder, "read")
    discard(docs.sparkSession, folder, "met")

    proof = read.filter("not cut").select(F.col("id").alias("source_id"), F.col("key").alias("source_key"),
                                          F.col("start").alias("source_start"), "size", "digest").distinct()
    long = runs.join(proof, ["source_id", "source_key", "source_start", "size"])
    windows = read.filter("cut").select("id", "key", "start", "size", "digest")
    earliest = windows.groupBy("digest").agg(F.min(F.struct("id", "start")).alias("first"), F.max("id").alias("last"))
    earliest = earliest.filter(F.col("first")["id"] < F.col("last")).drop("last")
    single = windows.join(earliest, "digest").filter(_later(F.col("first"))).select(
        "id", "key", "start", "size", "digest", F.col("first")["id"].alias("source_id"), F.col("first")["start"].alias("source_start"))
    return long.select(single.columns).unionByName(single)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, kmer: int = KMER) -> DataFrame:
    """(id, n_words, n_removed, kept) of every row; ``kept`` holds the words that stay, joined by one space.

    A word goes if it lies in a window of ``span`` words whose words also start somewhere in a document
    with a smaller id; windows are judged on the input. Null and empty texts have no words; rows without
    an id lose nothing and take nothing from others; of rows that share an id none counts as earlier.
    Repeated rows are repeated. Other columns are ignored. An empty table gives an empty table.
    """
    rows = keyed(docs, id_col, text_col)
    spans = repeated_spans(docs, id_col, text_col, span, kmer).groupBy(F.col("id").alias("of_id"), F.col("key").alias("of_key")).agg(
        F.collect_list(F.struct("start", "size", "digest")).alias("spans"))
    kind = rows.schema["id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, spans in zip(batch.column(2), batch.column(3)):
                words = _split(text.as_py())
                stays = np.ones(len(words), bool)
                for s in spans.as_py() or ():
                    start, end = s["start"], s["start"] + s["size"]
                    if stays[start:end].any() and _digest(words[start:end]) == s["digest"]:
                        stays[start:end] = False
                kept = words if stays.all() else [words[i] for i in np.flatnonzero(stays)]
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
            n, gone, kept = ([x[j] for x in out] for j in range(3))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                             ["id", "n_words", "n_removed", "kept"])

    return join_rows(rows, spans, "left").mapInArrow(remove, f"id {kind}, n_words long, n_removed long, kept string")
