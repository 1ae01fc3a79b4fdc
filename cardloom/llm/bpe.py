"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Words (the pieces that the tokenizer's split pattern makes) are counted over all documents. The frequent
ones are encoded once and compiled into an automaton over their bytes that shares prefixes and suffixes;
each arc carries a number, and the numbers along a word's path add up to its place in the list of ids.
Workers map the automaton's arrays from one file. Words it lacks are merged exactly, by rank.
"""

from __future__ import annotations

import json
import os
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardloom.llm.common import discard, shared_folder, stored, text_of

#: Split pattern of the byte-level vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SHIFT, _NONE = 24, np.int32(2**31 - 1)
_SHORT = 32  # bytes of a piece up to which pieces are merged together
#: A space beside white space. A space between two other characters always begins a piece, so a chunk, with the space
#: before it, can be split into pieces by itself, and chunks repeat often.
_WHITE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200F}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
_ANY_RUN = f"{_WHITE} | {_WHITE}"
#: Letters only, of the Latin blocks that have no other signs: one piece with the space before it.
_LETTERS = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{17F}]+$"
LEXICON_WORDS = 1 << 17
_COUNTED = 300_000  # words a task counts before it passes the counts on
_CHUNK = 2 << 20  # bytes of text that are coded together; working memory is about 25 times as much


class Splitter:
    """Cuts texts into pieces; needs of the vocabulary only its special strings."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        names = "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True))
        self.cut = regex.compile(f"({names})") if names else None
        self.split = regex.compile(PATTERN)
        self.tight = not any(" " in t for t in special)

    def runs(self, texts: pa.Array) -> np.ndarray:
        """Texts in which a cut at spaces could cut a piece."""
        if not self.tight:
            return np.ones(len(texts), bool)
        return pc.match_substring_regex(texts, _ANY_RUN).to_numpy(zero_copy_only=False)

    def cut_texts(self, texts: pa.Array) -> tuple[pa.ListArray, pa.Array, list[str]]:
        """Lists of chunks of the texts that can be cut at spaces, the chunks laid end to end, and the other texts."""
        slow = self.runs(texts)
        lists = pc.split_pattern(texts.filter(pa.array(~slow)), " ")
        return lists, lists.values, texts.filter(pa.array(slow)).to_pylist() if slow.any() else []

    def pieces(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of different chunks, each with the space before it, laid end to end, and how many each chunk has."""
        letters = pc.match_substring_regex(chunks, _LETTERS)
        whole = letters.to_numpy(zero_copy_only=False)
        cut = [self.words(" " + c) for c in chunks.filter(pc.invert(letters)).to_pylist()]
        sizes = np.ones(len(chunks), np.int64)
        sizes[~whole] = [len(c) for c in cut]
        alone = pc.binary_join_element_wise("", chunks.filter(letters), " ")
        others = pa.array([w for c in cut for w in c], pa.string())
        # back into the order of the chunks
        owner = np.repeat(whole, sizes)
        place = np.empty(len(owner), np.int64)
        place[owner], place[~owner] = np.arange(len(alone)), np.arange(len(others)) + len(alone)
        return pa.concat_arrays([alone, others]).take(pa.array(place)), sizes

    def words(self, text: str) -> list[str]:
        """Pieces of a text; a special string is a piece of its own."""
        if self.cut is None or not self.cut.search(text):
            return self.split.findall(text)
        return [w for i, part in enumerate(self.cut.split(text)) for w in ([part] if i % 2 else self.split.findall(part))]


class Vocabulary:
    """Merges, ids and special strings of a ``tokenizers`` file with byte-level BPE."""

    def __init__(self, source: str):
        file = json.loads(source)
        model = file["model"]
        shown = _shown_bytes()
        raw = {text: bytes(shown[c] for c in text) for text in model["vocab"]}
        self.ids = {raw[text]: i for text, i in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(raw[a], raw[b]): n for n, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        # the same as arrays: pairs of ids in order, the rank of each, and by rank the id it makes
        vocab = model["vocab"]
        keys = np.array([vocab[a] << _SHIFT | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.of_byte = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int32)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << _SHIFT | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], _NONE)

    def merged_together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Short pieces merged at once, every piece taking its next merge in the same step: the numbers of the pieces in
        the order they were done, how many ids each has, and all ids."""
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
        lengths = np.array([len(w) for w in words], np.int64)
        for width in (8, 16, _SHORT):
            rows = np.flatnonzero((lengths > (width // 2 if width > 8 else 0)) & (lengths <= width))
            for some in np.array_split(rows, -(-len(rows) // 65536)) if len(rows) else ():
                self._merge_block([words[i] for i in some.tolist()], some, width, done)
        return tuple(np.concatenate(c) for c in zip(*done))

    def _merge_block(self, words: list[bytes], names: np.ndarray, width: int, out: list) -> None:
        flat = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(-1, width)
        column = np.arange(width)
        ids = np.where(column < np.array([len(w) for w in words])[:, None], self.of_byte[flat], -1)
        ranks = np.full(ids.shape, _NONE, np.int32)
        ranks[:, :-1] = self._rank(ids[:, :-1], ids[:, 1:])
        while len(ids):
            row = np.arange(len(ids))
            at = ranks.argmin(axis=1)
            low = ranks[row, at]
            done = low == _NONE
            if done.any():
                kept = ids[done]
                out.append((names[done], (kept >= 0).sum(axis=1), kept[kept >= 0].astype(np.int32)))
                ids, ranks, names, at, low = ids[~done], ranks[~done], names[~done], at[~done], low[~done]
                row = np.arange(len(ids))
                if not len(ids):
                    return
            behind = column > at[:, None]  # moves one place to the left
            ids = np.where(behind, np.concatenate([ids[:, 1:], np.full((len(ids), 1), -1, ids.dtype)], axis=1), ids)
            ranks = np.where(behind, np.concatenate([ranks[:, 1:], np.full((len(ids), 1), _NONE, np.int32)], axis=1), ranks)
            ids[row, at] = self.made[low]
            after = np.where(at + 1 < width, ids[row, np.minimum(at + 1, width - 1)], -1)
            ranks[row, at] = self._rank(ids[row, at], after)
            inner = at > 0
            ranks[row[inner], at[inner] - 1] = self._rank(ids[row[inner], at[inner] - 1], ids[row[inner], at[inner]])

    def merged(self, word: str) -> list[int]:
        """Ids of one piece: the pair of lowest rank is merged, the leftmost first, until none is left."""
        if word in self.special:
            return [self.special[word]]
        whole = word.encode()
        if whole in self.ids and len(whole) == 1:
            return [self.ids[whole]]
        parts = [whole[i:i + 1] for i in range(len(whole))]
        ranks, none = self.ranks, len(self.ranks)
        order = [ranks.get(p, none) for p in zip(parts, parts[1:])]
        while order:
            low = min(order)
            if low == none:
                break
            at = order.index(low)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del order[at]
            if at:
                order[at - 1] = ranks.get((parts[at - 1], parts[at]), none)
            if at < len(order):
                order[at] = ranks.get((parts[at], parts[at + 1]), none)
        return [self.ids[p] for p in parts]


def _shown_bytes() -> dict[str, int]:
    """Character -> byte: printable Latin-1 stands for itself, the other bytes follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


# -- the transducer -----------------------------------------------------------------------------------------

def compile_lexicon(entries: dict[bytes, list[int]]) -> dict[str, np.ndarray]:
    """Arrays of the minimal acyclic transducer: arcs sorted by (state, byte) with target and number."""
    registry: dict[tuple, int] = {}
    arcs_of: list[dict[int, int]] = []
    final: list[bool] = []

    def settle(node: list) -> int:
        """The state equal to this node: one that exists, or a new one."""
        form = (node[1], *node[0].items())
        if form not in registry:
            registry[form] = len(arcs_of)
            arcs_of.append(node[0])
            final.append(node[1])
        return registry[form]

    path: list[list] = [[{}, False]]  # nodes of the last word, not settled yet; a node is [arcs, final]
    last = b""
    words = sorted(entries)
    for word in [*words, None]:
        shared = 0 if word is None else len(os.path.commonprefix([last, word]))
        while len(path) > shared + 1:
            done = settle(path.pop())
            path[-1][0][last[len(path) - 1]] = done
        if word is not None:
            path += [[{}, False] for _ in word[shared:]]
            path[-1][1] = True
            last = word
    root = settle(path[0])
    ends = np.zeros(len(arcs_of), np.int64)  # words that end at or below a state; targets are settled first
    for s, arcs in enumerate(arcs_of):
        ends[s] = final[s] + sum(ends[t] for t in arcs.values())
    keys, targets, numbers = [], [], []
    for s, arcs in enumerate(arcs_of):
        before = int(final[s])
        for byte, t in sorted(arcs.items()):
            keys.append(s << 8 | byte)
            targets.append(t)
            numbers.append(before)
            before += ends[t]
    ids = [entries[w] for w in words]
    return {
        "keys": np.array(keys, np.int64), "targets": np.array(targets, np.int64), "numbers": np.array(numbers, np.int64),
        "final": np.array(final, np.int64), "root": np.array([root], np.int64),
        "starts": np.cumsum([0, *map(len, ids)]).astype(np.int64), "ids": np.array([i for x in ids for i in x], np.int64),
    }


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    head = json.dumps({k: len(a) for k, a in arrays.items()}).encode()
    return len(head).to_bytes(8, "little") + head + b"".join(a.tobytes() for a in arrays.values())


class Lexicon:
    """The arrays, mapped from a file that is unlinked at once: the map lives as long as the worker."""

    def __init__(self, data: bytes):
        handle, path = tempfile.mkstemp()
        with os.fdopen(handle, "wb") as file:
            file.write(data)
        whole = np.memmap(path, np.uint8, "r")
        os.unlink(path)
        size = int.from_bytes(whole[:8].tobytes(), "little")
        at = 8 + size
        for name, n in json.loads(whole[8:at].tobytes()).items():
            setattr(self, name, np.frombuffer(whole, np.int64, n, at))
            at += 8 * n

    def find(self, words: list[bytes]) -> list[np.ndarray | None]:
        """Ids of each word, None for those the lexicon lacks."""
        return [None if n < 0 else self.ids[self.starts[n]:self.starts[n + 1]] for n in self.numbers_of(words).tolist()]

    def numbers_of(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the list of ids, -1 for those the lexicon lacks; all words take each step together."""
        found = np.full(len(words), -1, np.int64)
        if not words or not len(self.keys):
            return found
        lengths = np.array([len(w) for w in words])
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(words), np.uint8)
        live = np.arange(len(words))
        state, number = np.full(len(words), self.root[0]), np.zeros(len(words), np.int64)
        for step in range(int(lengths.max()) + 1):
            here = lengths[live] == step
            over = live[here]
            over = over[self.final[state[over]] == 1]
            found[over] = number[over]
            live = live[~here]
            if not len(live):
                break
            key = state[live] << 8 | flat[starts[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[arc] == key
            live, arc = live[known], arc[known]
            state[live], number[live] = self.targets[arc], number[live] + self.numbers[arc]
        return found


# -- the jobs -----------------------------------------------------------------------------------------------

def word_counts(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts."""
    special = Vocabulary(vocabulary).special

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Splitter(special)
        spaced: list[pa.Table] = []  # chunks that stand behind a space, and how often
        pieces: Counter = Counter()  # of the other parts of texts
        held = 0

        def summed(tables: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(tables).group_by("values").aggregate([("counts", "sum")]).rename_columns(["values", "counts"])

        def counted() -> Iterator[pa.RecordBatch]:
            words = [pa.table({"values": pa.array(list(pieces), pa.string()), "counts": pa.array(list(pieces.values()), pa.int64())})]
            if spaced:
                chunks = summed(spaced).combine_chunks()
                found, sizes = own.pieces(_flat(chunks["values"]))
                words.append(pa.table({"values": found, "counts": np.repeat(chunks["counts"].to_numpy(), sizes)}))
            pieces.clear()
            spaced.clear()
            yield from summed(words).rename_columns(["word", "n"]).to_batches(1 << 16)

        for batch in batches:
            for texts in _slices(batch.column(0)):
                lists, chunks, rest = own.cut_texts(texts)
                first = lists.offsets.to_numpy()[:-1]
                pieces.update(w for t in rest for w in own.words(t))
                pieces.update(w for head in chunks.take(pa.array(first)).to_pylist() for w in own.words(head))
                behind = np.ones(len(chunks), bool)
                behind[first] = False
                spaced.append(pa.Table.from_struct_array(chunks.filter(pa.array(behind)).value_counts()))
                held += len(spaced[-1])
                if held > _COUNTED:
                    spaced[:] = [summed(spaced)]
                    held = len(spaced[0])
                if held + len(pieces) > _COUNTED:
                    yield from counted()
                    held = 0
        yield from counted()

    return docs.select(text_of(text_col).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary: str, words: int = LEXICON_WORDS, text_col: str = "text") -> bytes:
    """The packed transducer of the most frequent words, as many as ``words`` at most: all that occur more often than some
    number of times. That number comes from how many words occur once, twice and so on, so no task orders words."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    counts = stored(word_counts(docs, vocabulary, text_col), folder, "words")
    least, kept = None, 0
    for n, alike in sorted(map(tuple, counts.filter("n > 1").groupBy("n").count().collect()), reverse=True):
        if kept + alike > words:
            break
        least, kept = n, kept + alike
    own = Vocabulary(vocabulary)
    top = counts.filter(F.col("n") >= least).select("word").toArrow()["word"].to_pylist() if least else []
    discard(spark, folder, "words")
    return packed(compile_lexicon({w.encode(): own.merged(w) for w in top}))


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Parts of about ``_CHUNK`` bytes of text."""
    step = max(1, _CHUNK // (texts.nbytes // max(len(texts), 1) + 1))
    for start in range(0, len(texts), step):
        yield texts.slice(start, step)


def _flat(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _spread(starts: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the members of lists ``index`` laid end to end, a list being ``sizes`` members from ``starts`` on, and where
    each of them ends."""
    lengths = sizes[index]
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[index] - ends + lengths, lengths), ends


class Encoder:
    """Texts are lists of chunks, chunks of pieces, pieces of ids: each different one of a batch is looked up once, and
    lists are put together by gathering numbers."""

    def __init__(self, vocabulary: str, lexicon: bytes):
        self.vocabulary = Vocabulary(vocabulary)
        self.splitter = Splitter(self.vocabulary.special)
        self.lexicon = Lexicon(lexicon)
        known = self.vocabulary.bytes
        self.bytes = pa.array([known.get(i) for i in range(max(known, default=-1) + 1)], pa.binary())

    def _coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each word begin, how many it has, and all ids."""
        vocabulary, lexicon = self.vocabulary, self.lexicon
        raw = [w.encode() for w in words]
        number = lexicon.numbers_of(raw)
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        there = number >= 0
        starts[there] = lexicon.starts[number[there]]
        sizes[there] = lexicon.starts[number[there] + 1] - starts[there]
        ids = [lexicon.ids.astype(np.int32)]
        size = len(ids[0])
        rest = np.flatnonzero(~there).tolist()
        short = [i for i in rest if len(raw[i]) <= _SHORT and words[i] not in vocabulary.special]
        names, lengths, merged = vocabulary.merged_together([raw[i] for i in short])
        at = np.array(short, np.int64)[names]
        sizes[at] = lengths
        starts[at] = size + np.cumsum(lengths) - lengths
        ids.append(merged)
        size += len(merged)
        for i in set(rest).difference(short):
            ids.append(np.array(vocabulary.merged(words[i]), np.int32))
            starts[i], sizes[i] = size, len(ids[-1])
            size += len(ids[-1])
        return starts, sizes, np.concatenate(ids)

    def encode(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Lists of ids and decoded texts."""
        own = self.splitter
        slow = own.runs(texts)
        lists, chunks, rest = own.cut_texts(texts)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        named, first = chunks.dictionary_encode(), chunks.take(pa.array(offsets[:-1])).dictionary_encode()
        behind, behind_sizes = own.pieces(named.dictionary)
        cut = [own.words(t) for t in (*first.dictionary.to_pylist(), *rest)]
        pieces = pa.concat_arrays([behind, pa.array([w for some in cut for w in some], pa.string())]).dictionary_encode()
        piece_sizes = np.concatenate([behind_sizes, np.array([len(some) for some in cut], np.int64)])
        piece_starts = np.cumsum(piece_sizes) - piece_sizes
        # texts as numbers of chunks: those behind a space, then first ones, then whole texts
        index = named.indices.to_numpy().astype(np.int64)
        index[offsets[:-1]] = first.indices.to_numpy() + len(behind_sizes)
        ends = np.empty(len(texts) + 1, np.int64)
        ends[0] = 0
        counts = np.ones(len(texts), np.int64)
        counts[~slow] = np.diff(offsets)
        np.cumsum(counts, out=ends[1:])
        whole = np.empty(ends[-1], np.int64)
        of_slow = np.repeat(slow, counts)
        whole[~of_slow] = index
        whole[of_slow] = np.arange(len(rest)) + len(piece_sizes) - len(rest)
        at, chunk_ends = _spread(piece_starts, piece_sizes, whole)
        text_pieces = pieces.indices.to_numpy().astype(np.int64)[at]
        starts, sizes, ids = self._coded(pieces.dictionary.to_pylist())
        at, piece_ends = _spread(starts, sizes, text_pieces)
        flat = pa.array(ids[at])
        # where texts end, in chunks, then in pieces, then in ids
        bounds = np.concatenate([[0], chunk_ends])[ends]
        bounds = pa.array(np.concatenate([[0], piece_ends])[bounds].astype(np.int32))
        decoded = pc.binary_join(pa.ListArray.from_arrays(bounds, self.bytes.take(flat)), pa.scalar(b""))
        try:
            decoded = decoded.cast(pa.string())
        except pa.ArrowInvalid:  # ids whose bytes are no text
            decoded = pa.array([d.decode("utf-8", "replace") for d in decoded.to_pylist()], pa.string())
        return pa.ListArray.from_arrays(bounds, flat), decoded

    def __call__(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as int32, decoded text) of each text."""
        ids, decoded = self.encode(pa.array(texts, pa.string()))
        return [(np.array(i, np.int32).tobytes(), d) for i, d in zip(ids.to_pylist(), decoded.to_pylist())]


def coded_batches(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, ids, decoded) of batches (id, text), in parts. A batch is let go before the next one is read."""
    for batch in batches:
        at = 0
        for texts in _slices(batch.column(1)):
            ids, decoded = encoder.encode(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids, decoded], ["id", "ids", "decoded"])
            at += len(texts)
        batch = texts = ids = decoded = None


def encode_decode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                  lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """(id, ids array<int>, decoded) of every row, as the ``tokenizers`` library encodes and decodes.

    Special strings in a text become their ids. Null and empty texts have no ids and decode to an empty
    text; repeated rows are repeated; null ids are kept; other columns are ignored; an empty table gives
    an empty table. The vocabulary, of fixed size, is read on the driver and travels with the job.
    """
    spark: SparkSession = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    shared = spark.sparkContext.broadcast((vocabulary, build_lexicon(docs, vocabulary, lexicon_words, text_col)))
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return coded_batches(Encoder(*shared.value), batches)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"id {kind}, ids array<int>, decoded string")


__all__ = ["LEXICON_WORDS", "Encoder", "Lexicon", "Splitter", "Vocabulary", "build_lexicon", "compile_lexicon", "encode_decode", "packed",
           "word_counts"]
