"""Rows whose key may be among given ones, found before anything costly is done with them.

The keys become a Bloom filter: an aggregate sets bits in an array of 64-bit words, a scalar subquery hands that one
row to the scan, and every row tests a few bits of it. No key is missed; a row that passes by chance is left to the join
that follows. The array has at most ``MAX_BITS``; key sets too large for it are joined by a shuffle instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MAX_BITS = 1 << 26
_BITS_PER_KEY = 12
_LEAST_BITS_PER_KEY = 4  # with fewer, most rows would pass
_PROBES = 4


def _places(key: tuple[Column, ...], bits: int) -> list[Column]:
    """Bits of a key."""
    return [F.pmod(F.xxhash64(*key, F.lit(i)), F.lit(bits)) for i in range(_PROBES)]


def bit_table(keys: DataFrame, key: tuple[Column, ...], bits: int) -> DataFrame:
    """One row with ``words``: an array of ``bits / 64`` numbers, whatever the number of keys."""
    places = keys.select(F.explode(F.array(*_places(key, bits))).alias("place"))
    marked = places.selectExpr("place DIV 64 AS word", "shiftleft(1L, CAST(place % 64 AS INT)) AS bits")
    blank = keys.sparkSession.range(bits // 64).selectExpr("id AS word", "0L AS bits")
    words = marked.unionAll(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return words.agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("words"))


def may_hold(table: DataFrame, key: tuple[Column, ...], bits: int) -> Column:
    """Whether all bits of a key are set."""
    words = table.scalar()
    tests = [F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), (place % 64).cast("int")) == 1
             for place in _places(key, bits)]
    held = tests[0]
    for test in tests[1:]:
        held = held & test
    return held


def keep_wanted(rows: DataFrame, key: tuple[Column, ...], keys: DataFrame, wanted: tuple[str, ...]) -> DataFrame:
    """``rows`` that may have one of the keys in the columns ``wanted`` of ``keys``, and no row twice.

    ``keys`` is counted, so it should be stored. Null keys match nothing.
    """
    n = keys.count()
    if n * _LEAST_BITS_PER_KEY > MAX_BITS:
        named = rows.withColumns({f"_{c}": k for c, k in zip(wanted, key)})
        return named.join(keys.select(*[F.col(c).alias(f"_{c}") for c in wanted]), [f"_{c}" for c in wanted], "left_semi").select(*rows.columns)
    bits = min(1 << max(n * _BITS_PER_KEY, 1 << 10).bit_length(), MAX_BITS)
    present = keys.na.drop(subset=list(wanted))
    table = bit_table(present, tuple(F.col(c) for c in wanted), bits)
    known = key[0].isNotNull()
    for k in key[1:]:
        known = known & k.isNotNull()
    return rows.filter(known & may_hold(table, key, bits))
