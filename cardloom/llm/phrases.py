"""Phrase collocation mining with Rabin-Karp fingerprints.

Texts, with A-Z in lower case, are cut into pieces at punctuation and line ends and these into words at blanks.
Workers hash whole batches of bytes in numpy: the hash of a word is the difference of two values of a prefix
polynomial over the bytes, the fingerprint of an n-gram that of two values of a prefix polynomial over the hashes of
the words (``fingerprints``). Then

1. for n = 1, 2, .. fingerprints of the n-grams are counted by a shuffle. An n-gram is counted only if both its
   (n-1)-grams may be frequent, which a bit table of their fingerprints tells (``_marks``, at most 16 MiB; a
   crowded table lets more n-grams through and changes nothing else),
2. fingerprints never miss an occurrence, so whatever is frequent has a frequent fingerprint. The n-grams behind
   those are read from the text: in a batch they are told apart word by word, words byte by byte, and a second
   shuffle sums the counts by the phrase itself and keeps a pointer to a document that holds it. Different phrases
   that share a fingerprint part here, and what is not frequent after all goes (``phrase_counts``),
3. cuts, scores and containment are joins between the frequent phrases (``collocations``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardloom.llm.common import discard, mixed, shared_folder, small, stored, text_of

#: Fixed values of the cut: bytes between words, and bytes between pieces.
_BLANKS = b"\x20\x09"
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"

_BASE = np.uint64(0x9E3779B97F4A7C15)  # of the polynomial over bytes; odd, so it has an inverse modulo 2**64
_WORD_BASE = np.uint64(0xD1342543DE82EF95)  # of the polynomial over words
_STRETCH = 1 << 20  # bytes that are hashed at once, up to the next end of a word
_BATCH_BYTES = 2 << 20  # documents are gathered up to this much text
_HELD = 1 << 22  # fingerprints of a task before they are counted and sent on
_HELD_PHRASES = 1 << 20  # counts of phrases of a task before they are summed and sent on
MARK_BITS = 1 << 27  # largest bit table

_KINDS = np.zeros(256, np.uint8)
_KINDS[list(_BLANKS)] = 1
_KINDS[list(_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse modulo 2**64 for i < n."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    out = []
    for b in (base, inverse):
        p = np.full(n, b, np.uint64)
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Polynomial hashes of ``values[start:end]`` from one prefix polynomial."""
    up, down = _powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values + np.uint64(1)) * up[:-1], out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * down[starts]


@dataclass
class Words:
    """The words of some documents, in order."""

    data: np.ndarray  # bytes of all texts, lower case
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # number of the document in the batch
    hashes: np.ndarray
    follows: np.ndarray  # whether the next word is in the same piece

    def grams(self, n: int) -> np.ndarray:
        """First words of all n-grams."""
        held = np.ones(max(len(self.starts) - n + 1, 0), bool)
        for t in range(n - 1):
            held &= self.follows[t:t + len(held)]
        return np.flatnonzero(held)


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """``offsets``: where the documents begin in ``data``, and the end of the last."""
    kinds = _KINDS[data]
    data = _LOWER[data]
    is_word = kinds == 0
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:]
    filled = offsets[:-1][np.diff(offsets) > 0]
    first[filled] = is_word[filled]
    last[filled[1:] - 1] = is_word[filled[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    cuts = np.flatnonzero(kinds == 2)
    piece = np.searchsorted(cuts, starts)
    follows = np.zeros(len(starts), bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # whole words of about a stretch of bytes
        to = max(int(np.searchsorted(ends, starts[at] + _STRETCH, "right")), at + 1)
        low, high = starts[at], ends[to - 1]
        hashes[at:to] = _spans_hash(data[low:high].astype(np.uint64), starts[at:to] - low, ends[at:to] - low, _BASE)
        at = to
    return Words(data, starts, ends, doc, mixed(hashes), follows)


def fingerprints(words: Words, n: int, langs: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Of the n-grams that begin at ``firsts``; ``langs`` holds a code for each document."""
    spans = _spans_hash(words.hashes, firsts, firsts + n, _WORD_BASE)
    return mixed(spans ^ mixed(langs[words.doc[firsts]] + np.uint64(n)))


def _lang_codes(langs: list[str]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    codes = {lang: xxh3_64_intdigest(lang) for lang in set(langs)}
    return np.array([codes[lang] for lang in langs], np.uint64)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, pa.RecordBatch]]:
    """Words of some documents at a time; a document is never split."""
    for batch in batches:
        texts = batch.column("text")
        sizes = np.asarray(pc.binary_length(texts).to_numpy(zero_copy_only=False), np.int64)
        at = 0
        while at < len(sizes):
            total = np.cumsum(sizes[at:])
            to = at + max(int(np.searchsorted(total, _BATCH_BYTES)), 1)
            part = batch.slice(at, to - at)
            joined = b"".join(part.column("text").cast(pa.binary()).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(sizes[at:to])])
            if joined:
                yield words_of(np.frombuffer(joined, np.uint8), offsets), part
            at = to


def _marked(marks: np.ndarray, prints: np.ndarray) -> np.ndarray:
    places = prints >> np.uint64(64 - (len(marks) * 8).bit_length() + 1)
    return (marks[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _candidates(words: Words, n: int, langs: np.ndarray, below: np.ndarray | None) -> np.ndarray:
    """First words of the n-grams whose two (n-1)-grams may be frequent."""
    firsts = words.grams(n)
    if below is None or not len(firsts):
        return firsts
    parts = words.grams(n - 1)
    good = np.zeros(len(words.starts) + 1, bool)
    good[parts] = _marked(below, fingerprints(words, n - 1, langs, parts))
    return firsts[good[firsts] & good[firsts + 1]]


def _counted(texts: DataFrame, n: int, below) -> DataFrame:
    """(print, n) of the n-grams of each task."""

    def sums(held: list[np.ndarray]) -> pa.RecordBatch:
        prints, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.array(n)], names=["print", "n"])

    def run(batches):
        held, size = [], 0
        marks = None if below is None else below.value
        for words, part in _gathered(batches):
            langs = _lang_codes(part.column("lang").to_pylist())
            firsts = _candidates(words, n, langs, marks)
            held.append(fingerprints(words, n, langs, firsts))
            size += len(firsts)
            if size >= _HELD:
                yield sums(held)
                held, size = [], 0
        if size:
            yield sums(held)

    return texts.select("lang", "text").mapInArrow(run, "print long, n long")


def _marks(spark: SparkSession, prints: DataFrame) -> np.ndarray:
    """Bit table of fingerprints; 16 bits for each, at most ``MARK_BITS`` in all. What reaches the driver is
    one row per 64 bits of the table, however many fingerprints there are."""
    bits = min(1 << max(prints.count() * 16, 1 << 10).bit_length(), MARK_BITS)
    place = F.shiftrightunsigned("print", 64 - bits.bit_length() + 1)
    filled = prints.select(F.shiftright(place, 6).cast("int").alias("at"), F.expr("1L << CAST({} & 63 AS INT)".format(
        f"shiftrightunsigned(print, {64 - bits.bit_length() + 1})")).alias("bit"))
    rows = filled.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return table.view(np.uint8)


def _same_words(words: Words, langs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal for equal words of one language only, and the first word of each number."""
    keys = mixed(words.hashes ^ langs[words.doc])
    _, heads, ids = np.unique(keys, return_index=True, return_inverse=True)
    sizes = words.ends - words.starts
    of = heads[ids]
    same = (sizes == sizes[of]) & (langs[words.doc] == langs[words.doc[of]])
    if same.all():
        at = np.flatnonzero(_KINDS[words.data] == 0)  # the bytes of all words, in order
        same = words.data[at] == words.data[at + np.repeat(words.starts[of] - words.starts, sizes)]
    if not same.all():  # two words share a hash: told apart by themselves
        raw = words.data.tobytes()
        known: dict = {}
        ids = np.array([known.setdefault((langs[d], raw[s:e]), len(known))
                        for s, e, d in zip(words.starts, words.ends, words.doc)], np.int64)
        heads = np.unique(ids, return_index=True)[1]
    return ids, heads


def _tuple_codes(ids: np.ndarray, firsts: np.ndarray, n: int, kinds: int) -> np.ndarray:
    """A number for each n-gram, equal for equal tuples of word numbers only."""
    code = ids[firsts].astype(np.int64)
    for t in range(1, n):
        if len(code) and (int(code.max()) + 1) * kinds >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * kinds + ids[firsts + t]
    return code


def _read_phrases(texts: DataFrame, marks: list) -> DataFrame:
    """(lang, size, phrase, n, first_doc) of each task for n-grams with marked fingerprints; size 0 holds the number
    of all words of a language."""
    id_type = texts.schema["id"].dataType
    columns = ["lang", "size", "phrase", "n", "first_doc"]

    def counts(langs, size, phrases, n, docs) -> pa.Table:
        return pa.table([langs, pa.array(np.full(len(n), size, np.int32)), phrases, pa.array(np.asarray(n, np.int64)), docs], names=columns)

    def of_batch(words: Words, part: pa.RecordBatch, tables: list[np.ndarray]) -> Iterator[pa.Table]:
        langs, docs = part.column("lang"), part.column("id")
        names = langs.to_pylist()
        codes = _lang_codes(names)
        known = sorted(set(names))
        per_lang = np.bincount(np.searchsorted(known, names)[words.doc], minlength=len(known))
        yield counts(pa.array(known, pa.string()), 0, pa.array([""] * len(known)), per_lang, pa.nulls(len(known), docs.type))
        ids, heads = _same_words(words, codes)
        raw = words.data.tobytes()
        spelled = pa.array([raw[s:e].decode() for s, e in zip(words.starts[heads].tolist(), words.ends[heads].tolist())], pa.string())
        for size, table in enumerate(tables, 1):
            firsts = words.grams(size)
            firsts = firsts[_marked(table, fingerprints(words, size, codes, firsts))]
            _, at, n = np.unique(_tuple_codes(ids, firsts, size, len(heads)), return_index=True, return_counts=True)
            at = firsts[at]
            if len(at):
                of = pa.array(words.doc[at])
                parts = [spelled.take(pa.array(ids[at + t])) for t in range(size)]
                yield counts(langs.take(of), size, pc.binary_join_element_wise(*parts, " "), n, docs.take(of))

    def summed(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        total = pa.concat_tables(held).group_by(columns[:3]).aggregate([("n", "sum"), ("first_doc", "min")])
        yield from total.rename_columns(columns).to_batches(1 << 16)

    def run(batches):
        tables = [m.value for m in marks]
        held, rows = [], 0
        for words, part in _gathered(batches):
            held += of_batch(words, part, tables)
            rows = sum(map(len, held))
            if rows >= _HELD_PHRASES:
                yield from summed(held)
                held = []
        if held:
            yield from summed(held)

    return texts.mapInArrow(run, f"lang string, size int, phrase string, n long, first_doc {id_type.simpleString()}")


def phrase_counts(docs: DataFrame, at_least: int, words: int = 3, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``words`` words that occur ``at_least`` times in a language, and the words of each language.

    The first table has (lang, size, phrase, n, first_doc): ``n`` occurrences, exactly, in documents of which
    ``first_doc``, the least id of the first one in each batch of texts, is one. The second has (lang, words). A null
    language is ``und``, a null text empty; a null id is no pointer; repeated rows count each; other columns are
    ignored. Empty tables give empty tables.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    texts = docs.select(F.col(id_col).alias("id"), lang.alias("lang"), text_of(text_col).alias("text"))
    marks, below = [], None
    for n in range(1, words + 1):
        counts = _counted(texts, n, below).groupBy("print").agg(F.sum("n").alias("n")).filter(F.col("n") >= at_least)
        prints = stored(counts.select("print"), folder, f"prints_{n}")
        below = spark.sparkContext.broadcast(_marks(spark, prints))
        marks.append(below)
    read = _read_phrases(texts, marks)
    # numbers only in the buffers, so that Spark sums by hashing
    summed = read.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"), F.min("first_doc").alias("first_doc"))
    kept = stored(summed.filter((F.col("n") >= at_least) | (F.col("size") == 0)), folder, "phrases")
    discard(spark, folder, *[f"prints_{n}" for n in range(1, words + 1)])
    return kept.filter("size > 0"), kept.filter("size = 0").select("lang", F.col("n").alias("words"))


_SALTS = 64
#: Exact for counts below 10**15.
_SCORE = """CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))
    div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"""


def _part(first: str, size: str) -> str:
    return f"array_join(slice(split(phrase, ' '), {first}, {size}), ' ')"


def collocations(docs: DataFrame, at_least: int = 10, words: int = 3, contained: int = 50, top: int | None = 2000,
                 id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases (None: all) of each language by score: lang, rank, phrase, a, l, r, n, score, first_doc.

    A phrase of 2 to ``words`` words that occurs ``a >= at_least`` times is cut behind each word; with ``l`` and ``r``
    occurrences of its two parts a cut scores floor(1000000 a a / (l r)), and the lowest one counts, of equal ones the
    first. A phrase goes if a longer one that holds it has at least ``contained`` percent of its occurrences. ``n``: all words of
    the language. Ties of score go by ``a``, then by the bytes of the phrase. Nulls, repeated rows and empty tables: as
    in ``phrase_counts``.
    """
    phrases, totals = phrase_counts(docs, at_least, words, id_col, text_col, lang_col)
    candidates = phrases.filter("size > 1").withColumnRenamed("n", "a")
    parts = phrases.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), "n")
    parts = small(parts, 96)  # joined by a shuffle beyond a counted size
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("k"), "size").select(
        "lang", "phrase", "a", "k", F.expr(_part("1", "k")).alias("head"), F.expr(_part("k + 1", "size - k")).alias("tail"))
    for name, count in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts, (F.col("lang") == F.col("of")) & (F.col(name) == F.col("part"))).withColumnRenamed("n", count).drop("of", "part")
    scored = cuts.withColumn("score", F.expr(_SCORE)).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("least"))
    inner = F.expr(f"transform(filter(flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1),"
                   f" i -> struct(s, i)))), x -> x.s < size), x -> {_part('x.i', 'x.s')})")
    holding = candidates.filter("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer")).groupBy(
        "lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(scored, ["lang", "phrase"]).join(holding, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("a")))
    rows = kept.select("lang", "phrase", "a", "least.l", "least.r", "least.score", "first_doc")
    best = (F.desc("score"), F.desc("a"), "phrase")
    if top is not None:  # first within salts, so that no task holds all phrases of a language
        salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).orderBy(*best)
        rows = rows.withColumn("place", F.row_number().over(salted)).filter(F.col("place") <= top).drop("place")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(small(totals, 64).select(F.col("lang").alias("of"), F.col("words").alias("n")), F.col("lang") == F.col("of")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc")
