"""Benchmark decontamination by winnowing (DataFrame functions only).

A window is ``span`` consecutive words of an item; an item with fewer words is one window. Of the k-gram
hashes of a text, the smallest of every ``w`` consecutive ones is its fingerprint. With ``k + w - 1 = span``
a window that occurs in a document has a fingerprint there and in its item, namely the smallest hash
inside it, so joining fingerprints loses nothing. Hits are then extended: the windows around a
fingerprint that matched are compared with the item's windows word for word.

Shorter items have windows of their own length; for them ``k`` is that length and ``w`` is 1.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.llm.common import ascii_lower, keyed, shared_folder, small, stored, text_of

SPAN = 10
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what is not in [^\x00-\x2F\x3A-\x60\x7B-\x7F]


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), _BREAKS), "")


def _kgrams(k: int) -> Column:
    """Hash of the k-gram at every position of ``words``; empty if there are fewer words."""
    at = F.sequence(F.lit(0), F.greatest(F.size("words") - k, F.lit(0)))
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(k)]))
    return F.when(F.size("words") >= k, hashes).otherwise(F.lit([]).cast("array<bigint>"))


def _minima(grams: Column, w: int) -> Column:
    """Smallest of each w consecutive hashes, without repeats."""
    if w == 1:
        return F.array_distinct(grams)
    at = F.sequence(F.lit(0), F.greatest(F.size(grams) - w, F.lit(0)))
    low = F.transform(at, lambda i: F.least(*[F.get(grams, i + j) for j in range(w)]))
    return F.when(F.size(grams) >= w, F.array_distinct(low)).otherwise(F.lit([]).cast("array<bigint>"))


def _shape(span: int) -> tuple[int, int]:
    """(k, w) for windows of ``span`` words."""
    return (span, 1) if span < SPAN else (span // 2, span - span // 2 + 1)


def _window(start: Column, span: int) -> Column:
    return F.array_join(F.slice("words", start + 1, F.lit(span)), " ")


def _dealt(codes: Column) -> Column:
    """Codes dealt by remainder over as many lists as each then has members, about, so that one is found in a short list."""
    lists = F.ceil(F.sqrt(F.size(codes))).cast("bigint")
    return F.transform(F.sequence(F.lit(0).cast("bigint"), lists - 1), lambda b: F.filter(codes, lambda c: F.pmod(c, lists) == b))


def _dealt_has(dealt: Column, code: Column) -> Column:
    return F.array_contains(F.get(dealt, F.pmod(code, F.size(dealt).cast("bigint")).cast("int")), code)


def _occurrences(docs: DataFrame, items: DataFrame, prints: DataFrame, span: int, folder: str) -> DataFrame:
    """(id, key, start, span, window) of every item window of ``span`` words in the documents."""
    k, w = _shape(span)
    windows = stored(_item_windows(items, span).select("window").distinct(), folder, f"windows{span}")
    lows = items.withColumn("grams", _kgrams(k)).select(F.explode(_minima(F.col("grams"), w)).alias("low")).distinct()
    item_prints = small(stored(lows, folder, f"prints{span}"), 16)
    hits = (
        prints.select(F.col("id").alias("of_id"), F.col("key").alias("of_key"), F.explode(f"low{span}").alias("low"))
        .join(item_prints, "low").groupBy("of_id", "of_key").agg(F.collect_set("low").alias("lows"))
        .select("of_id", "of_key", _dealt(F.col("lows")).alias("lows"))
    )
    # a hit's windows: those that start at most span - k words before it and lie inside the document
    first = F.when(F.size("words") >= k, F.sequence(F.lit(0), F.greatest(F.size("words") - k, F.lit(0))))
    places = F.filter(first, lambda i: _dealt_has(F.col("lows"), F.xxhash64(*[F.get("words", i + j) for j in range(k)])))
    starts = F.array_distinct(F.flatten(F.transform(places, lambda i: F.sequence(
        F.greatest(i - (span - k), F.lit(0)), F.least(i, F.size("words") - span)))))
    near = (
        docs.join(hits, (F.col("key") == F.col("of_key")) & F.col("id").eqNullSafe(F.col("of_id")))
        .select("id", "key", words(F.col("text")).alias("words"), "lows")
        # windows leave the row, not the words with each of them
        .select("id", "key", F.explode(F.transform(starts, lambda s: F.struct(s.alias("start"), _window(s, span).alias("window")))).alias("w"))
        .select("id", "key", "w.start", F.lit(span).alias("span"), "w.window")
    )
    return near.join(small(windows, 16 + 16 * span), "window", "left_semi").distinct()


def _item_windows(items: DataFrame, span: int) -> DataFrame:
    at = F.sequence(F.lit(0), F.size("words") - span)
    return items.select("item", F.explode(F.transform(at, lambda s: _window(s, span))).alias("window"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, key, n_words, n_hit, items) of every row; ``items`` lists the ids, as strings and sorted.

    A word is hit if it lies in an occurrence of an item window. Null texts have no words; items without
    words have no window; a null item id counts as an empty string; items that repeat an id are one item
    with the windows of all. Rows of ``docs`` that repeat an id with another text are judged apart, rows
    that repeat both alike. Other columns are ignored. Empty tables on either side give no hits.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    rows = keyed(docs, id_col, text_col)
    tests = stored(items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words(text_of(item_text_col)).alias("words")
    ).filter(F.size("words") > 0), folder, "items")
    spans = sorted(r[0] for r in tests.select(F.least(F.size("words"), F.lit(SPAN))).distinct().collect())  # at most SPAN values
    counted = rows.select("id", "key", words(F.col("text")).alias("words")).select("id", "key", "words", F.size("words").cast("long").alias("n_words"))
    for span in spans:
        k, w = _shape(span)
        counted = counted.withColumn("grams", _kgrams(k)).withColumn(f"low{span}", _minima(F.col("grams"), w)).drop("grams")
    prints = stored(counted.drop("words"), folder, "fingerprints")
    plain = prints.select("id", "key", "n_words")
    if not spans:
        return plain.select("*", F.lit(0).cast("long").alias("n_hit"), F.lit([]).cast("array<string>").alias("items"))
    of_span = {s: tests.filter(F.size("words") >= SPAN if s == SPAN else F.size("words") == s) for s in spans}
    found = stored(reduce(DataFrame.unionAll, [_occurrences(rows, of_span[s], prints, s, folder) for s in spans]), folder, "found")
    names = reduce(DataFrame.unionAll, [_item_windows(of_span[s], s) for s in spans]).distinct()
    covered = found.groupBy("id", "key").agg(F.array_sort(F.collect_set(F.struct("start", "span"))).alias("spots"))
    n_hit = F.aggregate(
        "spots", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["start"] + x["span"]).alias("end"),
            (s["n"] + F.greatest(x["start"] + x["span"] - F.greatest(s["end"], x["start"]), F.lit(0))).alias("n")),
    )["n"]
    named = found.select(F.col("id").alias("of_id"), F.col("key").alias("of_key"), "window").distinct().join(names, "window").groupBy(
        "of_id", "of_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    judged = covered.select("id", "key", n_hit.alias("n_hit")).join(
        named, (F.col("key") == F.col("of_key")) & F.col("id").eqNullSafe(F.col("of_id"))).select(
        F.col("id").alias("of_id"), F.col("key").alias("of_key"), "n_hit", "items")
    here = (F.col("key") == F.col("of_key")) & F.col("id").eqNullSafe(F.col("of_id"))
    return plain.join(judged, here, "left").select(
        "id", "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.lit([]).cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, share: float = 0.0) -> DataFrame:
    """Rows of ``docs`` of whose words at most ``share`` are hit, with all their columns."""
    bad = contamination(docs, items).filter(F.col("n_hit") > share * F.col("n_words")).select("id", "key").distinct()
    here = (F.xxhash64(text_of("text")) == bad["key"]) & F.col("doc_id").eqNullSafe(bad["id"])
    return docs.join(bad, here, "left_anti")
