"""LM scoring with a gated recurrent network in numpy.

The vocabulary is counted over all training texts. The ``SHORTLIST`` most frequent words, the end of a text
and "another word" are what the network predicts, first a class and then the word in it, so that the softmax
stays small; classes hold words of like frequency. "Another word" is spread over the rest of the vocabulary,
unseen words included, by smoothed counts.

Every training text is read once: in each of ``ROUNDS`` rounds the tasks train copies of the network on
their share of the texts by truncated backpropagation, and the copies are averaged by an aggregate. Texts run
side by side in lanes; the state goes on from window to window. Scoring carries it to the end of each text,
so a score is the log-likelihood of the complete text.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import cut, kinds_of, shared_folder, stored, text_of

SHORTLIST = 1024
CLASS_WORDS = 32
HIDDEN = 16
STEPS = 16  # of a window
LANES = 512
#: Training cuts longer texts into stretches of so many tokens, so that lanes end together; scoring cuts nothing.
STRETCH = 1024
ROUNDS = 2
RATE = 0.01
#: Words, at most, whose counts workers hold; counts of the others come from a join.
HEAD = 1 << 18
_TOKENS = 1_000_000  # tokens packed into lanes at a time
_COUNTED = 600_000  # words a task counts before it passes the counts on


class Network:
    """Parameters in one flat vector; the views below share its memory."""

    def __init__(self, words: int, flat: np.ndarray | None = None, seed: int = 1):
        h, s = HIDDEN, CLASS_WORDS
        self.words, self.classes = words, -(-words // s) + 2  # the last two are "another word" and the end
        self.other, self.end, self.start, self.resume = words, words + 1, words + 2, words + 3  # the last two only go in
        shapes = {"inp": (words + 4, 3 * h), "rec": (h, 3 * h), "cls": (h, self.classes), "cls_b": (self.classes,),
                  "out": (self.classes - 2, h, s), "out_b": (self.classes - 2, s)}
        self.flat = np.zeros(sum(int(np.prod(x)) for x in shapes.values()), np.float32) if flat is None else flat.astype(np.float32)
        at = 0
        for name, shape in shapes.items():
            size = int(np.prod(shape))
            setattr(self, name, self.flat[at:at + size].reshape(shape))
            at += size
        if flat is None:
            rng = np.random.default_rng(seed)
            for p in (self.inp, self.rec, self.cls, self.out):
                p[...] = rng.normal(0, 0.1, p.shape)

    def start_from(self, counts: np.ndarray, other: float, ends: float) -> None:
        """Biases of the unigram model."""
        s = CLASS_WORDS
        filled = np.zeros((self.classes - 2) * s)
        filled[: self.words] = counts
        by_class = filled.reshape(-1, s)
        mass = np.concatenate([by_class.sum(axis=1), [other, ends]]) + 0.5
        self.cls_b[...] = np.log(mass / mass.sum())
        inside = np.where(np.arange(by_class.size).reshape(by_class.shape) < self.words, by_class + 0.5, 0)
        with np.errstate(divide="ignore"):
            self.out_b[...] = np.maximum(np.log(inside / inside.sum(axis=1, keepdims=True)), -1e4)

    def class_of(self, y: np.ndarray) -> np.ndarray:
        return np.where(y < self.words, y // CLASS_WORDS, y - self.words + self.classes - 2)

    # -- a window ------------------------------------------------------------------------------------------

    def states(self, x: np.ndarray, h: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each step from inputs (steps, lanes); a start, or a stretch that resumes, sets the state to zero."""
        size = HIDDEN
        gates_in = self.inp[x]
        out = np.empty((*x.shape, size), np.float32)
        for t in range(len(x)):
            fresh = x[t] >= self.start
            if fresh.any():
                h = np.where(fresh[:, None], np.float32(0), h)
            a = h @ self.rec
            zr = 1 / (1 + np.exp(-(gates_in[t, :, : 2 * size] + a[:, : 2 * size])))
            z, r = zr[:, :size], zr[:, size:]
            n = np.tanh(gates_in[t, :, 2 * size:] + r * a[:, 2 * size:])
            if keep is not None:
                keep.append((h, zr, n, a[:, 2 * size:], fresh))
            h = n + z * (h - n)
            out[t] = h
        return out

    def likelihood(self, hidden: np.ndarray, y: np.ndarray, back: Network | None = None):
        """Natural log-probabilities of ``y`` given rows of states; with ``back``, also the gradient of minus their sum
        by the states, while the gradients by the output parameters are added to ``back``."""
        # one column a token: sums over classes and words then run along whole rows
        across = np.ascontiguousarray(hidden.T)
        odds = self.cls.T @ across + self.cls_b[:, None]
        odds -= odds.max(axis=0)
        c = self.class_of(y)
        rows = np.arange(len(y))
        logp = odds[c, rows]
        np.exp(odds, out=odds)
        total = odds.sum(axis=0)
        logp -= np.log(total)
        if back is not None:
            odds /= total
            odds[c, rows] -= 1
            grad = self.cls @ odds
            back.cls += across @ odds.T
            back.cls_b += odds.sum(axis=1)
        order = np.argsort(c.astype(np.min_scalar_type(self.classes)), kind="stable")  # narrow numbers are sorted by digits
        edges = np.concatenate([[0], np.cumsum(np.bincount(c, minlength=self.classes))])
        for k in range(self.classes - 2):
            some = order[edges[k]:edges[k + 1]]
            if not len(some):
                continue
            own = across[:, some]
            p = self.out[k].T @ own + self.out_b[k][:, None]
            p -= p.max(axis=0)
            place = y[some] - k * CLASS_WORDS
            here = np.arange(len(some))
            said = p[place, here]
            np.exp(p, out=p)
            sums = p.sum(axis=0)
            logp[some] += said - np.log(sums)
            if back is not None:
                p /= sums
                p[place, here] -= 1
                grad[:, some] += self.out[k] @ p
                back.out[k] += own @ p.T
                back.out_b[k] += p.sum(axis=1)
        return logp if back is None else (logp, grad.T)

    def backpropagate(self, x: np.ndarray, kept: list, grad: np.ndarray, back: Network) -> None:
        """Gradients by inputs and recurrent weights; ``grad`` is (steps, lanes, hidden). Ends at the window's edge."""
        size = HIDDEN
        by_gate = np.empty((*x.shape, 3 * size), np.float32)
        dh = np.zeros_like(grad[0])
        for t in range(len(x) - 1, -1, -1):
            h, zr, n, an, fresh = kept[t]
            dh = dh + grad[t]
            z, r = zr[:, :size], zr[:, size:]
            dn = dh * (1 - z) * (1 - n * n)
            g = by_gate[t]
            g[:, :size] = dh * (h - n) * z * (1 - z)
            g[:, size:2 * size] = dn * an * r * (1 - r)
            g[:, 2 * size:] = dn
            da = g.copy()
            da[:, 2 * size:] *= r
            back.rec += h.T @ da
            dh = dh * z + da @ self.rec.T
            if fresh.any():
                dh[fresh] = 0
        flat = x.ravel()
        order = np.argsort(flat.astype(np.min_scalar_type(self.words + 4)), kind="stable")
        given = flat[order]
        first = np.flatnonzero(np.r_[True, given[1:] != given[:-1]])
        ids = given[first]
        back.inp[ids] += np.add.reduceat(by_gate.reshape(-1, 3 * size)[order], first, axis=0)


class Trainer:
    def __init__(self, net: Network):
        self.net, self.back = net, Network(net.words, np.zeros_like(net.flat))
        self.mean, self.square, self.step = np.zeros_like(net.flat), np.zeros_like(net.flat), 0

    def window(self, x: np.ndarray, y: np.ndarray, h: np.ndarray, weight: float = 1.0) -> np.ndarray:
        """One update, the smaller the fewer lanes still run; ``y`` is -1 where a lane has ended. Returns the states the next window starts from."""
        net, back, kept = self.net, self.back, []
        back.flat[...] = 0
        hidden = net.states(x, h, kept)
        real = y.ravel() >= 0
        _, grad = net.likelihood(hidden.reshape(-1, HIDDEN)[real], y.ravel()[real], back)
        whole = np.zeros((x.size, HIDDEN), np.float32)
        whole[real] = grad
        net.backpropagate(x, kept, whole.reshape(hidden.shape), back)
        g = back.flat / max(int(real.sum()), 1)
        self.step += 1
        self.mean += 0.1 * (g - self.mean)
        self.square += 0.01 * (g * g - self.square)
        rate = weight * RATE * np.sqrt(1 - 0.99 ** self.step) / (1 - 0.9 ** self.step)
        net.flat -= (rate * self.mean / (np.sqrt(self.square) + 1e-8)).astype(np.float32)
        return hidden[-1]


def pairs(texts: list[np.ndarray], net: Network, stretch: int | None = None) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the text, inputs, targets); texts longer than ``stretch`` are cut, if it is given."""
    out = []
    for i, text in enumerate(texts):
        x = np.concatenate([[net.start], text[:-1]]).astype(np.int32)
        for at in range(0, len(text), stretch or len(text)):
            end = at + (stretch or len(text))
            part = x[at:end].copy()
            if at:
                part[0] = net.resume
            out.append((i, part, text[at:end]))
    return out


def lanes(parts: list[tuple[int, np.ndarray, np.ndarray]], net: Network, width: int) -> tuple[np.ndarray, ...]:
    """Texts, each with its end, one after another in lanes of like length: inputs, targets and number of the text, lane
    after lane, and the lanes' lengths, the longest first. Nothing is filled up to the longest lane."""
    width = max(1, min(width, len(parts), sum(len(p[2]) for p in parts) // 256))
    heap = [(0, i) for i in range(width)]
    members: list[list[int]] = [[] for _ in range(width)]
    for i in sorted(range(len(parts)), key=lambda i: -len(parts[i][2])):
        size, lane = heapq.heappop(heap)
        members[lane].append(i)
        heapq.heappush(heap, (size + len(parts[i][2]), lane))
    lengths = np.array([sum(len(parts[i][2]) for i in m) for m in members])
    order = np.argsort(-lengths, kind="stable")
    x, y, which = (np.empty(int(lengths.sum()), np.int32) for _ in range(3))
    at = 0
    for m in order:
        for i in members[m]:
            number, given, wanted = parts[i]
            here = slice(at, at + len(wanted))
            x[here], y[here], which[here] = given, wanted, number
            at = here.stop
    return x, y, which, lengths[order]


def windows(x: np.ndarray, y: np.ndarray, lengths: np.ndarray, net: Network) -> Iterator[tuple[np.ndarray, ...]]:
    """Inputs and targets (steps, lanes still running) of each window, and where they stand; behind a lane's last token
    inputs are the end and targets -1."""
    starts = np.cumsum(lengths) - lengths
    longest = int(lengths.max())
    for at in range(0, longest, STEPS):
        running = int((lengths > at).sum())
        step = np.arange(at, min(at + STEPS, longest))[:, None]
        inside = step < lengths[:running]
        place = np.where(inside, starts[:running] + step, 0)
        yield np.where(inside, x[place], np.int32(net.end)), np.where(inside, y[place], np.int32(-1)), place


def _continue(trainer: Trainer, texts: list[np.ndarray]) -> None:
    x, y, _, lengths = lanes(pairs(texts, trainer.net, STRETCH), trainer.net, LANES)
    h = np.zeros((len(lengths), HIDDEN), np.float32)
    for given, wanted, _ in windows(x, y, lengths, trainer.net):
        running = given.shape[1]
        h = trainer.window(given, wanted, h[:running], running / len(lengths))


def log_likelihoods(net: Network, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each text, its end included."""
    x, y, which, lengths = lanes(pairs(texts, net), net, LANES)
    h = np.zeros((len(lengths), HIDDEN), np.float32)
    total = np.zeros(len(texts))
    for given, wanted, place in windows(x, y, lengths, net):
        hidden = net.states(given, h[:given.shape[1]])
        h = hidden[-1]
        target = wanted.ravel()
        real = target >= 0
        logp = net.likelihood(hidden.reshape(-1, HIDDEN)[real], target[real])
        total += np.bincount(which[place.ravel()[real]], logp, len(texts))
    return total


# -- the jobs -----------------------------------------------------------------------------------------------

def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.col("trains").alias("trains"))


def _counted(learned: DataFrame) -> DataFrame:
    """(word, c) over all texts; each task sums its words before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("values").aggregate([("counts", "sum")]).rename_columns(["values", "counts"])

        for batch in batches:
            for _, _, words in cut(batch.column(0)):
                held.append(pa.Table.from_struct_array(words.value_counts()))
                if sum(map(len, held)) > _COUNTED:
                    held[:] = [summed()]
                    if len(held[0]) > _COUNTED // 2:
                        yield from held.pop().rename_columns(["word", "c"]).to_batches(1 << 16)
        if held:
            yield from summed().rename_columns(["word", "c"]).to_batches(1 << 16)

    return learned.select("text").mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _most_frequent(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """Words that occur more often than some number of times, ``most`` at most, the most frequent first. The number comes
    from how many words occur once, twice and so on, so no task orders all words."""
    least, kept = None, 0
    for c, alike in sorted(map(tuple, counts.groupBy("c").count().collect()), reverse=True):
        if kept + alike > most:
            break
        least, kept = c, kept + alike
    if least is None:
        return []
    top = counts.filter(F.col("c") >= least).toArrow()
    return sorted(zip(top["word"].to_pylist(), top["c"].to_pylist()), key=lambda r: (-r[1], r[0]))


def _batched(batches: Iterator[pa.RecordBatch], at: int, place: dict[str, int], net: Network,
             logs: dict[str, float] | None = None) -> Iterator[tuple]:
    """(columns before the text, notes, encoded texts) of a bounded number of tokens at a time. With ``logs``, a note has
    how many words are there, the sum of their logs, the part of it that is not on the shortlist, and the words that are
    not there. Each different word is looked up once."""
    head, notes, coded, size = [], [], [], 0
    for batch in batches:
        others = [c.to_pylist() for i, c in enumerate(batch.columns) if i != at]
        row = 0
        for n, ends, words in cut(batch.column(at)):
            kinds, index = kinds_of(words)
            codes = np.fromiter(map(place.get, kinds, repeat(net.other)), np.int32, len(kinds))[index]
            known = None if logs is None else np.fromiter(map(logs.get, kinds, repeat(np.nan)), np.float64, len(kinds))[index]
            for i in range(n):
                inside = slice(ends[i], ends[i + 1])
                head.append([c[row + i] for c in others])
                if logs is not None:
                    log = known[inside]
                    held = ~np.isnan(log)
                    notes.append((int(held.sum()), float(log[held].sum()), float(log[held & (codes[inside] == net.other)].sum()),
                                  [kinds[j] for j in index[inside][~held]]))
                else:
                    notes.append(None)
                coded.append(np.append(codes[inside], np.int32(net.end)))
                size += inside.stop - inside.start + 1
            row += n
            if size >= _TOKENS:
                yield head, notes, coded
                head, notes, coded, size = [], [], [], 0
    if head:
        yield head, notes, coded


def _turn(batch: pa.RecordBatch, r: int) -> pa.RecordBatch:
    """The texts of round ``r``: which, a hash says, that Spark's ``xxhash64`` of the text in lower case gives as well."""
    from xxhash import xxh64_intdigest

    hashes = [xxh64_intdigest(t.as_buffer(), 42) for t in pc.ascii_lower(batch.column(0))]
    return batch.filter(pa.array(np.array(hashes, np.uint64).view(np.int64) % ROUNDS == r))


def _round(texts: DataFrame, shared, words: int, r: int) -> np.ndarray | None:
    """The average of the copies that the tasks trained on the texts of round ``r``, weighted by their tokens."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, flat = shared.value
        trainer, seen = Trainer(Network(words, flat.copy())), 0
        for _, _, coded in _batched((_turn(b, r) for b in batches), 0, place, trainer.net):
            _continue(trainer, coded)
            seen += sum(map(len, coded))
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(seen)]), pa.array([trainer.net.flat], pa.list_(pa.float32()))], ["weight", "values"])

    made = texts.mapInArrow(train, "weight double, values array<float>").select("weight", F.posexplode("values").alias("i", "v"))
    mean = made.groupBy("i").agg((F.sum(F.col("weight") * F.col("v")) / F.sum("weight")).alias("v")).toArrow()
    if not mean.num_rows:
        return None
    flat = np.zeros(mean.num_rows, np.float32)
    flat[mean.column("i").to_numpy()] = mean.column("v").to_numpy()
    return flat


def scores(docs: DataFrame, trains, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, trains, n_tokens, n_known, train_tokens, base_score, score) of every row; scores are log10.

    ``trains`` is a condition on ``docs``: the rows whose texts are learned from. A-Z count in lower case; a text is
    its words, split at ASCII white space, and one end; null and empty texts are the end alone. ``base_score``
    is that of smoothed counts. Without training rows nothing is known, and both scores are the base.
    Repeated rows and null ids are kept; other columns are ignored; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    rows = _rows(docs.withColumn("trains", F.coalesce(trains, F.lit(False))), id_col, text_col)
    learned = rows.filter("trains")
    counts = stored(_counted(learned), folder, "counts")
    ends = learned.count()
    n_words, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n, v = n_words + ends, kinds + (ends > 0)
    head = _most_frequent(counts, HEAD)
    short = head[:SHORTLIST]
    rest_n, rest_v = n_words - sum(c for _, c in short), kinds - len(short)
    net = Network(len(short))
    place = {w: i for i, (w, _) in enumerate(short)}
    if ends:
        net.start_from(np.array([c for _, c in short]), rest_n, ends)
        flat = net.flat
        for r in range(ROUNDS):
            shared = spark.sparkContext.broadcast((place, flat))
            trained = _round(learned.select("text"), shared, len(short), r)
            flat = flat if trained is None else trained
        net = Network(len(short), flat)
    whole, rest = np.log10(n + 0.5 * (v + 1)), np.log10(rest_n + 0.5 * (rest_v + 1))
    known = spark.sparkContext.broadcast((place, net.flat, {w: float(np.log10(c + 0.5)) for w, c in head}))
    words, end_log = len(short), float(np.log10(ends + 0.5))
    kind = rows.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, flat, logs = known.value
        own = Network(words, flat)
        for heads, notes, coded in _batched(batches, 1, place, own, logs):
            like = log_likelihoods(own, coded) / np.log(10)
            out = []
            for (id_, trains), (held, log, other_log, tail), code, value in zip(heads, notes, coded, like):
                out.append((id_, trains, len(code), held + (ends > 0), log + end_log, float(value + other_log),
                            int((code[:-1] == own.other).sum()), tail))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[j] for o in out], t) for j, t in enumerate(
                    (batch_kind, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.string())))],
                ["id", "trains", "n_tokens", "n_known", "logs", "like", "others", "tail"])

    from pyspark.sql.pandas.types import to_arrow_type

    batch_kind = to_arrow_type(rows.schema["id"].dataType)
    scored = rows.select("id", "text", "trains").mapInArrow(
        score, f"id {kind}, trains boolean, n_tokens long, n_known long, logs double, like double, others long, tail array<string>")
    partial = stored(scored.withColumn("row", F.monotonically_increasing_id()), folder, "partial")
    # words that workers do not hold: their counts, or none, come from the table
    rare = partial.select("row", F.explode("tail").alias("word")).join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_logs"), F.count("c").alias("rare_known"))
    both = partial.drop("tail").join(rare, "row", "left").withColumn("rare_logs", F.coalesce("rare_logs", F.lit(0.0)))
    base = F.col("logs") + F.col("rare_logs") - F.col("n_tokens") * float(whole)
    model = F.col("like") + F.col("rare_logs") - F.col("others") * float(rest)
    return both.select(
        "id", "trains", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), (model if ends else base).alias("score"))
