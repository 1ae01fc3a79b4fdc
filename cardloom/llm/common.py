"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardloom.sources.layout import shared_folder

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Largest number of bytes that is ever broadcast by hint; larger sides are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
_CUT_BYTES = 4 << 20  # text cut into words at a time


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    only_ascii = F.length(text) == F.octet_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def text_of(name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stored(frame: DataFrame, folder: str, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read again: later jobs start from the files."""
    spark: SparkSession = frame.sparkSession
    path = f"{folder}/{name}"
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete tables that ``stored`` wrote, once everything made of them is stored itself."""
    context = spark.sparkContext
    for name in names:
        path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def small(frame: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table with a broadcast hint if its counted rows fit ``BROADCAST_BYTES``, else without."""
    return F.broadcast(frame) if frame.count() * row_bytes <= BROADCAST_BYTES else frame


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id``, ``key``, ``text``) of each row.

    ``key`` tells rows apart that repeat an id with another text; joins back to rows use both and
    are null-safe, so that rows without an id are kept and equal rows share one decision.
    """
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def cut(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """(texts, where the words of each begin and end, all words) of a bounded amount of text at a time, A-Z in lower case.

    Workers lower texts here: in the plan every letter of a text with others than ASCII ones is looked up by itself.
    """
    step = max(1, _CUT_BYTES // (texts.nbytes // max(len(texts), 1) + 1))
    for start in range(0, len(texts), step):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(start, step)))
        words, ends = lists.values, lists.offsets.to_numpy().astype(np.int64)
        filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # beside white space at the ends of a text
        yield len(lists), np.concatenate([[0], np.cumsum(filled)])[ends], words.filter(pa.array(filled))


def kinds_of(words: pa.Array) -> tuple[list[str], np.ndarray]:
    """Different words, and the number of each word among them."""
    named = words.dictionary_encode()
    return named.dictionary.to_numpy(zero_copy_only=False).tolist(), named.indices.to_numpy()


class WordCodes:
    """64-bit codes of words; each worker remembers those of the words it met last."""

    KNOWN = 1 << 18

    def __init__(self):
        self.words: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        if len(self.words) > self.KNOWN:
            self.words.clear()
        known = self.words
        for w in set(words).difference(known):
            known[w] = xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a code spread over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def join_rows(rows: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """``rows`` (id, key, ...) with ``side`` (of_id, of_key, ...)."""
    return rows.join(side, (F.col("key") == F.col("of_key")) & F.col("id").eqNullSafe(F.col("of_id")), how).drop("of_id", "of_key")


__all__ = ["BROADCAST_BYTES", "WordCodes", "ascii_lower", "cut", "discard", "join_rows", "keyed", "kinds_of", "mixed", "shared_folder", "small", "stored", "text_of"]
