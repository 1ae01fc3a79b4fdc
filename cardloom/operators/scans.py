"""Block sequences (H1-H3) dealt over many rows: pages with more blocks than one row should hold.

Reading a chunk of blocks turns the state before it into the state behind it and some output. Which way it goes depends only on
which slots are filled, not on what they hold; so a chunk is read once for every such pattern, with marks in place of what
came from before. Chunks are read side by side; then the patterns are passed from chunk to chunk, a few numbers each, and
marks are replaced by the blocks they stand for.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from operator import and_

from pyspark.sql import DataFrame, functions as F

from cardloom.functions.sql import aggregate, struct, transform, with_value
from cardloom.operators.rules import Profile
from cardloom.operators.shapes import SEQUENCES, Sequence, entries, run

CHUNK = 4096
_MARK = 1 << 30  # of the slot carried into a chunk; block numbers within a chunk are smaller


def block_rows(parsed: DataFrame, profile: Profile, *keys: str) -> DataFrame:
    """One row per block of a page with a sequence shape: ``keys``, its ordinal ``i``, and what is read from it."""
    blocks = SEQUENCES[profile.shape].blocks(profile, "nodes")
    rows = parsed.select(*keys, F.expr(f"inline({blocks})"))
    return rows.withColumn("i", F.col("i").cast("bigint"))


def records_of_blocks(blocks: DataFrame, shape: str, keys: tuple[str, ...], chunk: int = CHUNK) -> DataFrame:
    """``keys`` and the records of each sequence of blocks.

    ``blocks`` has ``keys``, the ordinal ``i`` of the block from 0 on, and the values that ``block_rows`` reads. A sequence may be
    of any length: a task holds ``chunk`` blocks, and of a whole sequence only a few numbers per chunk. Null keys
    are keys like others. Ordinals may have gaps, but no two blocks of a sequence the same one.
    """
    sequence = SEQUENCES[shape]
    values = [c for c in blocks.columns if c not in keys and c != "i"]
    block = F.struct((F.col("i") % chunk).cast("int").alias("i"), *values)
    dealt = blocks.groupBy(*keys, F.expr(f"i DIV {chunk}").alias("chunk")).agg(F.array_sort(F.collect_list(block)).alias("rows"))
    # blocks are found by their number in the chunk, so gaps do not shift them
    read = dealt.select(*keys, "chunk", F.expr(f"array({', '.join(_runs(sequence))})").alias("runs"))

    exits = transform("runs", lambda r: struct(**{s: f"{r}.{s}" for s in sequence.slots}))
    steps = read.select(*keys, "chunk", F.expr(exits).alias("exits")).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("chunk", "exits"))).alias("steps"))
    states = steps.select(*keys, F.expr(f"inline({_passed_on(sequence, chunk)})"))
    met = _joined(read, states, (*keys, "chunk"))
    emitted = met.select(*keys, F.expr(f"explode({_resolved(sequence, chunk)})").alias("blocks"))
    n = _width(sequence)
    found = emitted.select(*keys, *[F.col("blocks")[k].alias(f"n{k}") for k in range(n)])
    for k in range(n):
        held = blocks.select(*keys, F.col("i").alias(f"n{k}"), F.struct(*values).alias(f"b{k}"))
        found = _joined(found, held, (*keys, f"n{k}"))
    return found.select(*keys, F.expr(f"inline(array({sequence.build(lambda k: f'b{k}')}))"))


def _joined(left: DataFrame, right: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """Inner join in which null is a key like others."""
    named = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    condition = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(named, condition).drop(*[f"_right_{c}" for c in on])


def _width(sequence: Sequence) -> int:
    """Blocks of an entry."""
    asked: list[int] = []
    sequence.build(lambda k: asked.append(k) or "b")
    return max(asked) + 1


def _patterns(sequence: Sequence) -> list[tuple[bool, ...]]:
    return list(product((False, True), repeat=len(sequence.slots)))


def _runs(sequence: Sequence) -> list[str]:
    """The chunk read for every pattern of filled slots."""
    return [
        run("rows", {s: str(_MARK + k) if filled else "-1" for k, (s, filled) in enumerate(zip(sequence.slots, pattern))}, sequence.step)
        for pattern in _patterns(sequence)
    ]


def _pattern_no(sequence: Sequence, held) -> str:
    """Number of the pattern of filled slots, as in ``_patterns``."""
    last = len(sequence.slots) - 1
    return " + ".join(f"if({held(s)} >= 0, {1 << (last - k)}, 0)" for k, s in enumerate(sequence.slots))


def _actual(number: str, chunk_no: str, sequence: Sequence, held, chunk: int) -> str:
    """Ordinal of a block named by its number in a chunk, or by the mark of a slot that came from before."""
    marks = " ".join(f"WHEN {number} = {_MARK + k} THEN {held(s)}" for k, s in enumerate(sequence.slots))
    return f"CASE WHEN {number} < 0 THEN -1L {marks} ELSE {chunk_no} * {chunk}L + {number} END"


def _passed_on(sequence: Sequence, chunk: int) -> str:
    """(chunk, in_<slot>, ..): what each slot holds before each chunk."""
    names = {s: f"in_{s}" for s in sequence.slots}
    start = struct(now=struct(**{n: "-1L" for n in names.values()}), states=f"CAST(array() AS ARRAY<STRUCT<chunk: BIGINT, {', '.join(f'{n}: BIGINT' for n in names.values())}>>)")

    def step(acc: str, x: str) -> str:
        held = lambda s: f"{acc}.now.{names[s]}"
        taken = f"element_at({x}.exits, 1 + {_pattern_no(sequence, held)})"
        after = struct(**{names[s]: _actual(f"{taken}.{s}", f"{x}.chunk", sequence, held, chunk) for s in sequence.slots})
        before = struct(chunk=f"{x}.chunk", **{names[s]: held(s) for s in sequence.slots})
        return struct(now=after, states=f"array_append({acc}.states, {before})")

    return aggregate("steps", start, step, lambda acc: f"{acc}.states")


def _resolved(sequence: Sequence, chunk: int) -> str:
    """Entries of the run that was taken, as ordinals."""
    held = lambda s: f"in_{s}"
    taken = f"element_at(runs, 1 + {_pattern_no(sequence, held)})"
    return with_value(entries(f"{taken}.out"), lambda es: transform(
        es, lambda e: transform(e, lambda n: _actual(n, "chunk", sequence, held, chunk))))
