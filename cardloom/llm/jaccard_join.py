"""N-gram Jaccard join as a blocked product of the sparse document by n-gram matrix with its transpose.

Documents with the same set of n-grams are one row of the matrix. Its columns are ordered from rare to
frequent by a count sketch of fixed size over all documents. Two sets that are similar enough share a column
among the first few of either (how many follows from the size), so only those entries are multiplied,
column by column: a column is a block. A product is dropped at once if the sizes of the two sets and the
places of the shared column leave too little overlap.

A block is not expanded into all its pairs. First each of its rows meets one row, the one with most copies;
what is verified joins components. Where a block keeps several, its rows are dealt by a hash to cells of a few rows,
and each row outside the largest component is compared with the nearest row by parities in any of its cells, in turns
with cells twice as large, until a turn links few rows.
Then only rows outside the block's largest component meet the rows of other components, and only if the
parities of both sets allow enough overlap, and not again in a block if they share
one of the three before it. No pair that could join two components is left out, so the components are exact, while
a group of copies costs one pair a row, and one of near copies one pair a row and turn, beside the few rows that no
turn links. Overlaps of the pairs that remain are counted on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardloom.llm.common import WordCodes, ascii_lower, cut, discard, join_rows, keyed, kinds_of, mixed, shared_folder, small, stored, text_of
from cardloom.llm.exact_dedup import one_of_repeated

SHINGLE = 3
PERCENT = 90
_COUNTERS = 1 << 17
_PARITIES = 256  # a multiple of 64
_CELL = 4  # rows of a block that meet in the first turn
_LEAD = 3  # columns next before one, by which a pair that was met before is known
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                     0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xD6E8FEB86659FD93], np.uint64)


def _gram_codes(codes: np.ndarray, size: int) -> np.ndarray:
    """The code of each ``size`` consecutive words."""
    n = max(0, len(codes) - size + 1)
    total = np.full(n, size, np.uint64)
    for j in range(size):
        total = mixed(total + codes[j:j + n] * _FACTORS[j % len(_FACTORS)])
    return total


class Shingles:
    """Sets of n-grams of words, as sorted 64-bit codes; a text with fewer words has one, the whole sequence."""

    def __init__(self, size: int):
        self.size, self.codes = size, WordCodes()

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().split()  # at \x20 and \x09-\x0D
        if not words:
            return np.zeros(0, np.uint64)
        return np.unique(_gram_codes(self.codes(words), min(self.size, len(words))))


def _grams(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, codes) of a bounded amount of text: the n-grams of text i, repeated ones too, are
    ``codes[places[i]:places[i + 1]]``. Each different word is hashed once; the codes are those of ``Shingles``."""
    from xxhash import xxh3_64_intdigest

    for n, ends, words in cut(texts):
        kinds, index = kinds_of(words)
        codes = np.fromiter(map(xxh3_64_intdigest, kinds), np.uint64, len(kinds))[index]
        held = np.diff(ends)
        grams = _gram_codes(codes, size)
        inside = np.ones(len(grams), bool)
        last = ends[1:, None] - np.arange(1, size)  # no n-gram begins at the last words of a text
        inside[last[(last >= ends[:-1, None]) & (last < len(grams))]] = False
        grams = grams[inside]
        few = np.flatnonzero((held > 0) & (held < size))
        if len(few):
            before = np.concatenate([[0], np.cumsum(np.maximum(held - size + 1, 0))])
            whole = [_gram_codes(codes[ends[i]:ends[i + 1]], int(held[i]))[0] for i in few]
            grams = np.insert(grams, before[few], np.array(whole, np.uint64))
        yield np.concatenate([[0], np.cumsum(np.where(held < size, held > 0, held - size + 1))]), grams


def _frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Count sketch of the n-grams of all documents: ``_COUNTERS`` numbers, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(_COUNTERS, np.int64)
        for batch in batches:
            for _, codes in _grams(batch.column(0), size):
                seen += np.bincount((codes % np.uint64(_COUNTERS)).astype(np.int64), minlength=_COUNTERS)
        yield pa.RecordBatch.from_arrays([pa.array([seen], pa.list_(pa.int64()))], ["seen"])

    counted = (
        rows.select("text").mapInArrow(count, "seen array<long>").select(F.posexplode("seen").alias("place", "n"))
        .groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    )
    total = np.zeros(_COUNTERS, np.int64)
    total[counted.column("place").to_numpy()] = counted.column("n").to_numpy()
    return total


def _heads(rows: DataFrame, size: int, percent: int, counters: np.ndarray) -> DataFrame:
    """(id, key, n, a, b, prefix, bits): size and 128-bit name of each set, the columns that must be multiplied, and
    whether the number of its n-grams in each of ``_PARITIES`` buckets is odd."""
    shared = rows.sparkSession.sparkContext.broadcast(counters)
    kind = rows.schema["id"].dataType.simpleString()

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        seen = shared.value
        for batch in batches:
            sizes, names, prefixes, bits = [], [], [], []
            for codes in (np.sort(c[a:b]) for places, c in _grams(batch.column(2), size) for a, b in zip(places, places[1:])):
                first = np.ones(len(codes), bool)
                np.not_equal(codes[1:], codes[:-1], out=first[1:])
                codes = codes[first]
                n = len(codes)
                keep = n - -(-percent * n // 100) + 1 if n else 0
                order = np.argsort(seen[(codes % np.uint64(_COUNTERS)).astype(np.int64)], kind="stable")[:keep]
                sizes.append(n)
                names.append(xxh3_128_digest(codes.tobytes()))
                prefixes.append((codes[order] >> np.uint64(16)).astype(np.int64))  # 48 bits tell columns apart well enough here
                odd = np.bincount((codes >> np.uint64(20)).astype(np.int64) % _PARITIES, minlength=_PARITIES) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            name = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            ends = pa.array(np.cumsum([0, *map(len, prefixes)]).astype(np.int32))
            flat = pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(np.ascontiguousarray(name[:, 0])),
                 pa.array(np.ascontiguousarray(name[:, 1])), pa.ListArray.from_arrays(ends, flat), pa.array(bits, pa.list_(pa.int64()))],
                ["id", "key", "n", "a", "b", "prefix", "bits"])

    return rows.mapInArrow(head, f"id {kind}, key long, n int, a long, b long, prefix array<long>, bits array<long>")


def _enough(overlap: Column, sizes: Column, percent: int) -> Column:
    """100 * overlap >= percent * union, with union = sizes - overlap."""
    return (100 + percent) * overlap >= percent * sizes


def _differ(x_bits: str, y_bits: str) -> Column:
    """The number of buckets of which the parities of two sets differ: each n-gram that only one of them has changes one bit at most."""
    return sum((F.bit_count(F.col(x_bits)[i].bitwiseXOR(F.col(y_bits)[i])) for i in range(_PARITIES // 64)), F.lit(0))


def _alike(x_bits: str, y_bits: str, sizes: Column, percent: int) -> Column:
    """Whether the parities of two sets allow enough overlap."""
    return (100 + percent) * (sizes - _differ(x_bits, y_bits)) >= 2 * percent * sizes


def _opened(labelled: DataFrame) -> DataFrame:
    """Rows of the blocks that have several components, with the root of the largest of them and the number of rows."""
    main = labelled.groupBy("gram", "root").agg(F.count("*").alias("rows")).groupBy("gram").agg(
        F.max(F.struct("rows", "root")).alias("main"), F.sum("rows").alias("height"), F.count("*").alias("parts")).filter("parts > 1").select(
            "gram", F.col("main")["root"].alias("main"), "height")
    return labelled.join(main, "gram")


def _with_earlier(rows: DataFrame) -> DataFrame:
    """``before1``, ``before2`` ...: the open blocks that a row stands in next before each.

    Rows that share one of them have met there with better bounds, so they need not meet again; nothing follows from
    two rows that share none.
    """
    places = Window.partitionBy("cid").orderBy("pos")
    return rows.withColumns({f"before{i}": F.lag("gram", i).over(places) for i in range(1, _LEAD + 1)})


def _crossing(open_blocks: DataFrame, by: list[str], also: Column, percent: int) -> DataFrame:
    """Rows outside their block's largest component (x) beside those of other components (y) that agree in ``by``, where
    the bounds of the block and ``also`` let them pass."""
    x, y = (s.select(*by, *[F.col(c).alias(f"{side}_{c}") for c in s.columns if c not in by])
            for s, side in ((open_blocks.filter("root <> main"), "x"), (open_blocks, "y")))
    sizes = F.col("x_n") + F.col("y_n")
    enough = _enough(F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos")), sizes, percent)
    on = (F.col("x_root") != F.col("y_root")) & enough & _alike("x_bits", "y_bits", sizes, percent) & also
    for c in by:
        on = (x[c] == y[c]) & on
    return x.join(y, on)


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("u"), F.greatest(x, y).alias("v")]


def _nearest(open_blocks: DataFrame, turn: int, percent: int) -> DataFrame:
    """A pair (u, v) at most for each row outside its block's largest component: with the row of another component that is
    nearest by parities among those it is dealt to a cell with, by a hash, in any of its blocks."""
    cells = F.ceil(F.col("height") / (_CELL << turn))
    dealt = open_blocks.withColumn("cell", F.pmod(F.xxhash64("gram", "cid", F.lit(turn)), cells)).drop("height")
    alike = -_differ("x_bits", "y_bits") / (F.col("x_n") + F.col("y_n"))
    return _crossing(dealt, ["gram", "cell"], F.lit(True), percent).groupBy("x_cid").agg(
        F.max(F.struct(alike.alias("alike"), "y_cid")).alias("best")).select(*_pair("x_cid", F.col("best")["y_cid"]))


def _met_once(open_blocks: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of rows outside their block's largest component with rows of other components."""
    one_way = (F.col("y_root") == F.col("y_main")) | (F.col("x_cid") < F.col("y_cid"))
    steps = range(1, _LEAD + 1)
    met = F.coalesce(*[F.when(F.col(f"x_before{i}") == F.col(f"y_before{j}"), True) for i in steps for j in steps], F.lit(False))
    return _crossing(open_blocks.drop("height"), ["gram"], one_way & ~met, percent).select(*_pair("x_cid", "y_cid"))


def _labelled(rows: DataFrame, merged: DataFrame) -> DataFrame:
    return rows.join(merged, "cid", "left").withColumn("root", F.coalesce("root", "cid"))


def _verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, size: int, percent: int, folder: str, name: str) -> DataFrame:
    """The pairs (u, v) of classes whose full sets are similar enough."""
    pairs = stored(pairs, folder, f"{name}-pairs")
    sides = pairs.select(F.col("u").alias("cid")).union(pairs.select(F.col("v").alias("cid"))).distinct()
    chosen = stored(classes.join(sides, "cid", "left_semi").select("cid", F.col("first")["id"].alias("of_id"), F.col("first")["key"].alias("of_key")),
                    folder, f"{name}-sides")
    texts = stored(join_rows(rows, small(chosen, 32), "inner").dropDuplicates(["cid"]).select("cid", ascii_lower(F.col("text")).alias("text")), folder, f"{name}-texts")
    pairs = _possible(pairs, texts, size, percent, folder, name)
    both = (
        pairs.join(texts.withColumnsRenamed({"cid": "u", "text": "u_text"}), "u")
        .join(texts.withColumnsRenamed({"cid": "v", "text": "v_text"}), "v").select("u", "v", "u_text", "v_text")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grams(text: str) -> set:
            words = text.encode().split()
            return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}

        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = grams(a.as_py()), grams(b.as_py())
                common = len(x & y)
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(good, pa.bool_()))

    links = stored(both.mapInArrow(verify, "u long, v long"), folder, f"{name}-links")
    discard(rows.sparkSession, folder, *[f"{name}-{part}" for part in ("pairs", "sides", "texts", "held", "possible")])
    return links


def _possible(pairs: DataFrame, texts: DataFrame, size: int, percent: int, folder: str, name: str) -> DataFrame:
    """The pairs whose overlap may be enough by the numbers of n-grams in buckets of codes.

    Two sets share at most the smaller number in each bucket. There are at least as many buckets as a set has
    n-grams, so the bound is close, and a row of numbers is far smaller than a text to bring to every pair.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                codes = shingles(text.as_py())
                buckets = 1 << max(len(codes) - 1, 1).bit_length()
                held = np.bincount((codes % np.uint64(buckets)).astype(np.int64), minlength=buckets)
                rows.append((len(codes), held.astype(np.uint8 if held.max() < 256 else np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())],
                                             ["cid", "n", "held"])

    held = stored(texts.mapInArrow(count, "cid long, n int, held binary"), folder, f"{name}-held")
    sides = pairs.join(held.withColumnsRenamed({"cid": "u", "n": "u_n", "held": "u_held"}), "u").join(
        held.withColumnsRenamed({"cid": "v", "n": "v_n", "held": "v_held"}), "v").select("u", "v", "u_n", "v_n", "u_held", "v_held")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def numbers(n: int, data: bytes) -> np.ndarray:
            wide = len(data) > 1 << max(n - 1, 1).bit_length()
            return np.frombuffer(data, np.uint32 if wide else np.uint8).astype(np.int64)

        for batch in batches:
            good = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                x, y = numbers(a, x), numbers(b, y)
                if len(x) != len(y):  # the finer one is folded: its buckets are those of the other, by residue
                    few = min(len(x), len(y))
                    x, y = x.reshape(-1, few).sum(axis=0), y.reshape(-1, few).sum(axis=0)
                good.append((100 + percent) * int(np.minimum(x, y).sum()) >= percent * (a + b))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(good, pa.bool_()))

    return stored(sides.mapInArrow(bound, "u long, v long"), folder, f"{name}-possible")


def components(links: DataFrame, folder: str) -> DataFrame:
    """(cid, root) of every node of the links (u, v) but the roots, the smallest node of each component.

    Large-star and small-star steps in turn; every step is written to the shared folder. A node's
    neighbours are never gathered: their minimum is an aggregate and the links are joined with it. The steps end
    when no node has two links to smaller ones, or one and a link from a larger one: one job, where a step is many.
    """
    links = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    step = 0
    while True:
        ways = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small_star = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        links = stored(small_star, folder, f"star{step}")
        if step:
            discard(links.sparkSession, folder, f"star{step - 1}")
        ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")),
                                              F.struct(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))).alias("e")).select("e.*")
        if ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down + up > 1 AND down > 0").isEmpty():
            return links.withColumnsRenamed({"u": "cid", "v": "root"})
        step += 1


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(id, key, n_shingles, component_id) of every row; ``component_id`` is the smallest id that links lead to.

    Two texts link if 100 * intersection >= percent * union of their sets of ``shingle``-word n-grams, A-Z in
    lower case. Null and empty texts and those without words have no set and link with nothing: their
    component is their own id. Rows without an id take part; a component of such rows only has a null
    ``component_id``. Repeated rows are repeated. Other columns are ignored. An empty table gives an empty table.
    """
    folder = shared_folder(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    heads = stored(_heads(rows, shingle, percent, _frequencies(rows, shingle)), folder, "heads")
    grouped = heads.filter("n > 0").groupBy("a", "b", "n").agg(
        F.min("id").alias("low_id"), F.min(F.struct("id", "key")).alias("first"), F.count("*").alias("copies"),
        F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    wide = stored(grouped.withColumn("cid", F.monotonically_increasing_id()), folder, "wide")
    # prefixes are most of a row: once they are entries of blocks, neither rows nor classes need them
    known = stored(heads.select("id", "key", "n", "a", "b"), folder, "known")
    discard(docs.sparkSession, folder, "heads")

    entries = wide.select(F.posexplode("prefix").alias("pos", "gram"), "cid", "n", "copies")
    pivots = entries.groupBy("gram").agg(
        F.max(F.struct("copies", (-F.col("cid")).alias("order"), "n", "pos")).alias("pivot"), F.count("*").alias("height")).select(
            "gram", "height", F.struct((-F.col("pivot")["order"]).alias("cid"), F.col("pivot")["n"].alias("n"), F.col("pivot")["pos"].alias("pos")).alias("pivot"))
    blocks = stored(entries.join(pivots.filter("height > 1"), "gram").select("gram", "pos", "cid", "n", "pivot"), folder, "blocks")
    classes = stored(wide.select("a", "b", "n", "low_id", "first", "cid", "bits"), folder, "classes")
    discard(docs.sparkSession, folder, "wide")
    least = F.least(F.col("n") - F.col("pos"), F.col("pivot")["n"] - F.col("pivot")["pos"])
    stars = blocks.filter((F.col("cid") != F.col("pivot")["cid"]) & _enough(least, F.col("n") + F.col("pivot")["n"], percent)).select(
        F.least("cid", F.col("pivot")["cid"]).alias("u"), F.greatest("cid", F.col("pivot")["cid"]).alias("v")).distinct()
    for side in ("u", "v"):
        stars = stars.join(classes.select(F.col("cid").alias(side), F.col("n").alias(f"{side}_n"), F.col("bits").alias(f"{side}_bits")), side)
    stars = stars.filter(_alike("u_bits", "v_bits", F.col("u_n") + F.col("v_n"), percent)).select("u", "v")
    merged = components(_verified(stars, classes, rows, shingle, percent, folder, "star"), f"{folder}/first")

    labelled = stored(_labelled(blocks.select("gram", "pos", "cid", "n"), merged), folder, "labelled")
    discard(docs.sparkSession, folder, "blocks")
    open_blocks = stored(_opened(labelled).join(classes.select("cid", "bits"), "cid"), folder, "open")
    discard(docs.sparkSession, folder, "labelled")
    turn = 0
    while True:
        links = _verified(_nearest(open_blocks, turn, percent).distinct(), classes, rows, shingle, percent, folder, f"turn{turn}")
        merged = components(links.union(merged), f"{folder}/turned{turn}")
        left = _labelled(open_blocks.drop("root", "main", "height"), merged)
        tallest, entered = open_blocks.agg(F.coalesce(F.max("height"), F.lit(0)), F.count("*")).first()
        # another turn pays if the rows that this one linked could have met more rows than are open
        if _CELL << turn >= tallest or links.count() * tallest <= entered:
            break
        turn += 1
        open_blocks = stored(_opened(left), folder, f"open{turn}")
        discard(docs.sparkSession, folder, "open" if turn == 1 else f"open{turn - 1}", "first" if turn == 1 else f"turned{turn - 2}")
    open_blocks = stored(_opened(_with_earlier(left)), folder, "still")
    second = _verified(_met_once(open_blocks, percent).distinct(), classes, rows, shingle, percent, folder, "cross")
    roots = components(second.union(merged), f"{folder}/second")
    discard(docs.sparkSession, folder, "open", "still", "first", *[f"{name}{i}" for name in ("open", "turned") for i in range(turn + 1)])

    named = stored(classes.select("a", "b", "n", "cid", "low_id").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid")), folder, "named")
    lowest = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    final = named.join(lowest, "root").select("a", "b", "n", "component_id")
    return known.join(final, ["a", "b", "n"], "left").select("id", "key", F.col("n").cast("long").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component stays, that of the smallest id, with all its columns; rows without an id stay,
    and of rows that repeat an id and a text one."""
    folder = shared_folder(docs.sparkSession)
    judged = stored(near_components(docs, shingle=shingle, percent=percent).select("id", F.col("key").alias("sha"), "component_id"), folder, "judged")
    gone = judged.filter("id <> component_id").select("id", "sha").distinct()
    key = F.xxhash64(text_of("text"))
    left = docs.join(gone, (key == gone["sha"]) & (F.col("doc_id") == gone["id"]), "left_anti")
    kept = judged.filter("component_id IS NULL OR id IS NULL OR id = component_id")
    return one_of_repeated(left, kept, F.col("doc_id"), key, "doc_id")
