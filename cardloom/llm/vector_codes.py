"""Vector code compression: product codes by Lloyd rounds with trees over both parts and entries.

Components become integers, vectors are cut into equal parts, and each part position has a codebook. Vectors are
stored once in blocks; a block keeps the points of each part in the order of a binary tree (``tree_order``). A round
walks that tree and a tree over the codebook's entries together (``Walk``): for a pair of nodes the least and the
greatest squared distance between their boxes are known, so entry nodes that cannot hold the nearest entry of any
point of a node are pruned. Where a single entry is left, the whole node goes to it with its cached sum and count;
leaves in doubt are decided by exact distances. All of this is integer arithmetic: 64-bit where the largest
component proves that no square overflows, Python integers beyond.

A task sends one row per part and entry; the sums meet in a shuffle, and only the codebooks (entries times
components, whatever the input) reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardloom.llm.common import discard, shared_folder, small, stored

SCALE = 1024
_LEAF = 32  # points of a leaf, at least
_BLOCK_BYTES = 2 << 20  # components of a block, as 64-bit numbers
_GROUP = 3  # leaves in doubt are decided together below nodes of this height


# --- trees ---------------------------------------------------------------------------------------
def _depth(n: int, leaf: int) -> int:
    return max(int(math.log2(n / leaf)), 0) if n else 0


def _bounds(n: int, depth: int) -> np.ndarray:
    """Where the 2**depth leaves of a tree over n points begin, and n."""
    return np.arange((1 << depth) + 1) * n >> depth


def tree_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Order of the points in a tree that halves nodes at the median of their widest side."""
    n = len(points)
    order, depth = np.arange(n), _depth(n, leaf)
    ends = _bounds(n, depth)
    for level in range(depth):
        step = 1 << (depth - level)
        for a, m, b in zip(ends[:-1:step], ends[step // 2::step], ends[step::step]):
            inside = points[order[a:b]]
            side = inside[:, np.argmax(inside.max(0) - inside.min(0))]
            order[a:b] = order[a:b][np.argsort(side, kind="stable")]
    return order


class Tree:
    """Boxes, sums and sizes of all nodes over points in tree order, by level."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.depth = points, _depth(len(points), leaf)
        self.ends = _bounds(len(points), self.depth)
        starts = self.ends[:-1]
        level = [f.reduceat(points, starts, axis=0) for f in (np.minimum, np.maximum, np.add)]
        self.levels = [level]
        for _ in range(self.depth):
            level = [f(x[0::2], x[1::2]) for f, x in zip((np.minimum, np.maximum, np.add), level)]
            self.levels.insert(0, level)

    def span(self, level: int, node: int) -> slice:
        step = 1 << (self.depth - level)
        return slice(self.ends[node * step], self.ends[(node + 1) * step])


def _box_distances(low_a, high_a, low_b, high_b) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distances between points of two boxes."""
    gap = np.maximum(np.maximum(low_b - high_a, low_a - high_b), 0)
    far = np.maximum(high_b - low_a, high_a - low_b)
    return (gap * gap).sum(1), (far * far).sum(1)


def nearest(points: np.ndarray, entries: np.ndarray, largest: int) -> np.ndarray:
    """The first of the nearest entries of each point. ``largest`` bounds all components: it tells whether products
    of floats hold integers below 2**53, and so are exact, or squares fit 64 bits."""
    width = max(points.shape[1], 1)
    if 4 * largest * largest * width < 1 << 53:
        x, c = points.astype(np.float64), entries.astype(np.float64)
        return np.argmin((c * c).sum(1) - 2 * (x @ c.T), axis=1)
    found = np.empty(len(points), np.int64)
    at_once = max((1 << 20) // max(entries.size, 1), 1)
    for i in range(0, len(points), at_once):
        apart = points[i:i + at_once, None, :] - entries[None, :, :]
        found[i:i + at_once] = np.argmin((apart * apart).sum(2), axis=1)
    return found


class Walk:
    """One part of a codebook with its tree; gives points in tree order their entries."""

    def __init__(self, entries: np.ndarray, largest: int):
        self.entries, self.largest = entries, largest
        self.order = tree_order(entries, 1)
        self.tree = Tree(entries[self.order], 1)

    def _children(self, level: int, nodes: np.ndarray, to: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``nodes``, and the nodes below them at level ``to``; behind the last level stand the entries."""
        if to <= self.tree.depth:
            n = 1 << (to - level)
            return np.repeat(np.arange(len(nodes)), n), (nodes[:, None] * n + np.arange(n)).ravel()
        step = 1 << (self.tree.depth - level)
        first, last = self.tree.ends[nodes * step], self.tree.ends[(nodes + 1) * step]
        sizes = last - first
        begin = np.cumsum(sizes) - sizes
        return np.repeat(np.arange(len(nodes)), sizes), np.arange(sizes.sum()) - np.repeat(begin - first, sizes)

    def assign(self, tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entry of each point of ``tree``, and sums and counts of the points by entry."""
        k, singles = len(self.entries), self.tree.depth + 1
        codes = np.empty(len(tree.points), np.int64)
        sums, counts = np.zeros_like(self.entries), np.zeros(k, np.int64)
        level, e_level = 0, 0
        p, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(p):
            low, high, total = tree.levels[level]
            if e_level < singles:
                e_low, e_high, _ = self.tree.levels[e_level]
            else:
                e_low = e_high = self.tree.points
            near, far = _box_distances(low[p], high[p], e_low[e], e_high[e])
            heads = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            limit = np.repeat(np.minimum.reduceat(far, heads), np.diff(np.r_[heads, len(p)]))
            keep = near <= limit  # an entry as near as the limit may tie
            p, e = p[keep], e[keep]
            if e_level == singles:
                heads = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
                alone = heads[np.diff(np.r_[heads, len(p)]) == 1]
                for node, entry in zip(p[alone].tolist(), self.order[e[alone]].tolist()):
                    span = tree.span(level, node)
                    codes[span] = entry
                    sums[entry] += total[node]
                    counts[entry] += span.stop - span.start
                rest = np.ones(len(p), bool)
                rest[alone] = False
                p, e = p[rest], e[rest]
                if level == tree.depth:
                    break
            to = min(e_level + 2, singles)
            if to > e_level:
                of, below = self._children(e_level, e, to)
                p, e, e_level = p[of], below, to
            if level < tree.depth:
                p, e, level = np.r_[p * 2, p * 2 + 1], np.r_[e, e], level + 1
                by_node = np.argsort(p, kind="stable")
                p, e = p[by_node], e[by_node]
        for group in np.split(np.arange(len(p)), np.flatnonzero(np.diff(p >> _GROUP)) + 1) if len(p) else ():
            leaves, among = np.unique(p[group]), np.unique(self.order[e[group]])
            at = np.concatenate([np.arange(s.start, s.stop) for s in (tree.span(tree.depth, leaf) for leaf in leaves.tolist())])
            found = among[nearest(tree.points[at], self.entries[among], self.largest)]
            codes[at] = found
            by_entry = np.argsort(found, kind="stable")
            heads = np.flatnonzero(np.r_[True, np.diff(found[by_entry]) != 0])
            used = found[by_entry][heads]
            sums[used] += np.add.reduceat(tree.points[at][by_entry], heads, axis=0)
            counts[used] += np.diff(np.r_[heads, len(found)])
        return codes, sums, counts


# --- blocks --------------------------------------------------------------------------------------
class Numbers:
    """How integers are stored and computed with, by the largest of them and the width of a part."""

    def __init__(self, largest: int, width: int):
        self.largest, self.width = largest, width
        fits = lambda bits: largest < 1 << (bits - 1)
        self.kept = "<i2" if fits(16) else "<i4" if fits(32) else "<i8" if fits(62) else "<f8"  # floats hold whole numbers
        self.safe = 4 * largest * largest * max(width, 1) < 1 << 62 and largest < 1 << 31

    def read(self, raw: bytes) -> np.ndarray:
        flat = np.frombuffer(raw, self.kept)
        if not self.safe:
            flat = np.array([int(x) for x in flat.tolist()], object)
        return flat.astype(np.int64 if self.safe else object).reshape(-1, self.width)


def _blocks(rows: DataFrame, parts: int, numbers: Numbers) -> DataFrame:
    """(ids, labels, first_id, points, orders): vectors as trees, one per part position."""
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    width = numbers.width
    length = width * parts
    per_block = max(_BLOCK_BYTES // max(length * 8, 1), 64)

    def whole(vectors: pa.Array) -> np.ndarray:
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        sizes = np.asarray(vectors.value_lengths())
        out = np.zeros((len(sizes), length))
        out[np.arange(length) < sizes[:, None]] = flat
        return np.floor(out * SCALE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), per_block):
                part = batch.slice(i, per_block)
                cells = whole(part.column("vector"))
                points, orders = [], []
                for x in np.split(cells, parts, axis=1):
                    order = tree_order(x, _LEAF)
                    points.append(x[order].astype(numbers.kept).tobytes())
                    orders.append(order.astype("<i4").tobytes())
                ids = part.column("id")
                known = [x for x in ids.to_pylist() if x is not None]
                one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [one(ids), one(part.column("label")), pa.array([min(known, default=None)], ids.type),
                     pa.array([points], pa.list_(pa.binary())), pa.array([orders], pa.list_(pa.binary()))],
                    names=["ids", "labels", "first_id", "points", "orders"])

    schema = f"ids array<{id_type}>, labels array<{label_type}>, first_id {id_type}, points array<binary>, orders array<binary>"
    return rows.select("id", "label", "vector").mapInArrow(run, schema)


def _first_vectors(blocks: DataFrame, k: int, numbers: Numbers) -> list[list]:
    """The k vectors with the smallest ids, equal ids by their components, as integers.

    The k blocks with the smallest first ids hold them all, so no other block is read.
    """
    by_id = F.asc_nulls_last("first_id")
    firsts = [r.first_id for r in blocks.select("first_id").orderBy(by_id).limit(k).collect()]
    if firsts and firsts[-1] is not None and len(firsts) == k:
        blocks = blocks.filter(F.col("first_id") <= F.lit(firsts[-1]))
    id_type = blocks.schema["first_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for ids, points, orders in zip(*(batch.column(c).to_pylist() for c in ("ids", "points", "orders"))):
                cells = [np.empty((len(ids), numbers.width)) for _ in points]
                for cell, raw, order in zip(cells, points, orders):
                    cell[np.frombuffer(order, "<i4")] = np.frombuffer(raw, numbers.kept).reshape(-1, numbers.width)
                rows = np.concatenate(cells, axis=1)
                keys = [(i is None, 0 if i is None else i) for i in ids]
                limit = sorted(keys)[:k][-1]
                cut = sorted((i for i, key in enumerate(keys) if key <= limit), key=lambda i: (keys[i], rows[i].tolist()))[:k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in cut], batch.schema.field("first_id").type), pa.array(rows[cut].tolist(), pa.list_(pa.float64()))],
                    names=["id", "vector"])

    rows = blocks.select("ids", "first_id", "points", "orders").mapInArrow(run, f"id {id_type}, vector array<double>")
    return [[int(x) for x in r.vector] for r in rows.orderBy(F.asc_nulls_last("id"), "vector").limit(k).collect()]


def _walks(codebooks: list[list[list[int]]], numbers: Numbers) -> list[Walk]:
    kind = np.int64 if numbers.safe else object
    return [Walk(np.array(entries, kind).reshape(len(entries), numbers.width), numbers.largest) for entries in codebooks]


def _trees(points: list[bytes], numbers: Numbers) -> list[Tree]:
    return [Tree(numbers.read(raw), _LEAF) for raw in points]


def _round(blocks: DataFrame, codebooks: list, numbers: Numbers) -> list[list[list[int]]]:
    """Assign all parts and move each used entry to the floor of the mean of its parts."""
    width, parts = numbers.width, len(codebooks)

    def run(batches):
        walks = _walks(codebooks, numbers)
        sums = [np.zeros_like(w.entries) for w in walks]
        counts = [np.zeros(len(w.entries), np.int64) for w in walks]
        for batch in batches:
            for points in batch.column("points").to_pylist():
                for i, (walk, tree) in enumerate(zip(walks, _trees(points, numbers))):
                    _, s, n = walk.assign(tree)
                    sums[i] += s
                    counts[i] += n
        for i in range(parts):
            used = np.flatnonzero(counts[i])
            totals = [[Decimal(int(x)) for x in row] for row in sums[i][used].tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), i, np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[i][used]),
                 pa.array(totals, pa.list_(pa.decimal128(38, 0)))], names=["part", "entry", "n", "sums"])

    rows = blocks.select("points").mapInArrow(run, "part int, entry int, n long, sums array<decimal(38,0)>")
    total = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)])
    moved = [[list(entry) for entry in entries] for entries in codebooks]
    for r in total.collect():  # one row per part and entry
        moved[r["part"]][r["entry"]] = [int(r[f"s{j}"]) // r["n"] for j in range(width)]
    return moved


def _coded(blocks: DataFrame, codebooks: list, numbers: Numbers) -> DataFrame:
    """(id, label, codes, error) of each vector."""
    id_type, label_type = (blocks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels"))

    def run(batches):
        walks = None
        for batch in batches:
            walks = walks or _walks(codebooks, numbers)  # no vectors, no entries
            for row, (points, orders) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("points", "orders")))):
                codes, errors = [], []
                for walk, tree, order in zip(walks, _trees(points, numbers), orders):
                    found, _, _ = walk.assign(tree)
                    apart = tree.points - walk.entries[found]
                    back = np.argsort(np.frombuffer(order, "<i4"))
                    codes.append(found[back])
                    errors.append((apart * apart).sum(1)[back])
                error = reduce(np.add, errors)
                ids = batch.column("ids")[row].values
                yield pa.RecordBatch.from_arrays(
                    [ids, batch.column("labels")[row].values, pa.array(np.stack(codes, 1).tolist(), pa.list_(pa.int32())),
                     pa.array([Decimal(int(x)) for x in error.tolist()], pa.decimal128(38, 0))], names=["id", "label", "codes", "error"])

    schema = f"id {id_type}, label {label_type}, codes array<int>, error decimal(38,0)"
    return blocks.select("ids", "labels", "points", "orders").mapInArrow(run, schema)


def _finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[list[list[int]]]]:
    """(id, label, codes, error, label_error) of each vector that is whole and finite, and the codebooks by part.

    Components x become floor(1024 x). Each codebook begins with the parts of the ``entries`` vectors of least id (null
    ids come last, equal ids go by their components), or of all if there are fewer. ``codes`` are positions in the
    codebooks, ``error`` is the squared distance, ``label_error`` its sum over rows of the same label (nulls are one);
    both are null where 64 bits cannot hold them. Sums of components are exact up to 38 digits. A vector shorter than the
    longest, and all of them if the parts would be uneven, count as filled up with zeros. Repeated rows count each;
    other columns are ignored. A table without usable vectors gives no rows and empty codebooks.
    """
    spark: SparkSession = vectors.sparkSession
    folder = shared_folder(spark)
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector")).filter(_finite(F.col("vector")))
    size = rows.agg(F.max(F.size("vector")).alias("n"), F.max(F.array_max(F.transform("vector", F.abs))).alias("largest")).first()
    width = -(-(size.n or 0) // parts)
    numbers = Numbers(int(math.floor((size.largest or 0.0) * SCALE)) + 1, max(width, 1))
    blocks = stored(_blocks(rows, parts, numbers), folder, "blocks")
    start = _first_vectors(blocks, entries, numbers)
    width = numbers.width
    codebooks = [[v[i * width:(i + 1) * width] for v in start] for i in range(parts)]
    for _ in range(rounds if start else 0):
        codebooks = _round(blocks, codebooks, numbers)
    coded = stored(_coded(blocks, codebooks, numbers), folder, "coded")
    discard(spark, folder, "blocks")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(small(stored(by_label, folder, "by_label"), 64), F.col("label").eqNullSafe(F.col("of")), "left")
    long = lambda name: F.expr(f"try_cast({name} AS BIGINT)").alias(name)
    return joined.select("id", "label", "codes", long("error"), long("label_error")), codebooks
