"""Language ID: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

A text becomes its character n-grams, with white space, digits and punctuation as word ends, hashed into
buckets. The mean of their embeddings goes through a linear layer. Embeddings and layer are trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows; a fifth of that sample, not
trained on, gives the temperature of the softmax.

The softmax says which learned language is nearest, not whether any is near. A text is rejected by its evidence, the
share of its different five-letter n-grams that the training rows hold. The least evidence comes from the fifth not trained on: its rows as
they are stand for texts of learned languages, and, against the training rows of all other languages, for unknown ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import shared_folder, small, stored

BUCKETS = 1 << 15
LONG = 5  # letters of the n-grams that tell learned languages from others; shorter ones are common to most
PLACES = 1 << 20  # of the set of these trained on; above BUCKETS in the counts of a text
WIDTH = 16
LENGTHS = (2, 3, 4)
#: Expected number of labelled rows of a language that the model is fitted on; smaller languages give all.
SAMPLE_PER_LANG = 400
EPOCHS = 6
#: Share of calibration texts of learned languages that may fall under the least evidence.
REJECTED = 0.001
#: A rejected text has at least so many times the unseen share of the calibration text at that bound.
SLACK = 1.5
#: So many n-grams count as seen besides those of a text: a few unseen ones in a short text are little evidence.
GIVEN = 16
UNKNOWN = "und"


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTERS[0]


def subwords(text: str) -> np.ndarray:
    """Bucket of every n-gram that touches a letter; n-grams do not run over the end of a word. Behind them, from
    BUCKETS on, the places of the long ones."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    code = np.where(_letters()[code], code, 0).astype(np.uint32)
    code = np.concatenate([[0], code, [0]]).astype(np.uint32)
    out = []
    for n in (*LENGTHS, LONG):
        size = len(code) - n + 1
        if size < 1:
            continue
        mixed = np.full(size, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for j in range(n):
            mixed = (mixed ^ code[j:j + size]) * np.uint32(0x01000193)
            mixed ^= mixed >> np.uint32(15)
        inner = code[1:1 + size] != 0 if n > 2 else (code[:size] != 0) | (code[1:1 + size] != 0)
        for j in range(2, n - 1):
            inner &= code[j:j + size] != 0
        out.append(mixed[inner] % np.uint32(BUCKETS) if n < LONG else mixed[inner] % np.uint32(PLACES) + np.uint32(BUCKETS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # bucket -> its part of the logits: embedding times layer
    bias: np.ndarray
    seen: np.ndarray  # whether a training row has the long n-gram
    temperature: float = 1.0
    least: float = 0.0  # evidence below which a text is rejected

    def scores(self, grams: np.ndarray) -> np.ndarray:
        logits = (self.table[grams].mean(axis=0) + self.bias) / self.temperature
        odds = np.exp(logits - logits.max())
        return odds / odds.sum()

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, and whether the text is rejected."""
        grams = subwords(text or "") if self.langs else ()
        if not len(grams):
            return UNKNOWN, 0.0, True
        short = grams < BUCKETS
        odds = self.scores(grams[short])
        long = np.unique(grams[~short]) - np.uint32(BUCKETS)
        best = int(odds.argmax())
        return self.langs[best], float(odds[best]), evidence(int(self.seen[long].sum()), len(long)) < self.least


def evidence(seen: int, size: int) -> float:
    return (seen + GIVEN) / (size + GIVEN)


def fit(texts: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 1) -> Model:
    """``texts``: (lang, grams, counts). Rows without n-grams teach nothing."""
    texts = [(lang, g[g < BUCKETS], c[g < BUCKETS], g[g >= BUCKETS] - BUCKETS) for lang, g, c in texts if len(g)]
    langs = sorted({t[0] for t in texts})
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    held = [texts[i] for i in order[: len(texts) // 5]]
    trained = [texts[i] for i in order[len(texts) // 5:]]
    place = {lang: i for i, lang in enumerate(langs)}
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    steps = EPOCHS * max(len(trained), 1)
    for step in range(steps):
        if step % len(trained or [0]) == 0:
            queue = rng.permutation(len(trained))
        if not trained:
            break
        lang, grams, counts, *_ = trained[queue[step % len(trained)]]
        share = (counts / counts.sum()).astype(np.float32)
        mean = share @ embed[grams]
        logits = mean @ layer + bias
        odds = np.exp(logits - logits.max())
        wrong = odds / odds.sum()
        wrong[place[lang]] -= 1
        rate = 1.0 * (1 - step / steps)
        back = layer @ wrong
        layer -= rate * np.outer(mean, wrong)
        bias -= rate * 0.1 * wrong
        embed[grams] -= rate * share[:, None] * 20 * back  # a bucket sees only its share of the gradient
    langs_with = np.zeros(PLACES, np.int32)  # of each n-gram
    own = {lang: np.unique(np.concatenate([[], *(t[3] for t in trained if t[0] == lang)])).astype(np.int64) for lang in langs}
    for grams in own.values():
        langs_with[grams] += 1
    model = Model(langs, embed @ layer, bias, langs_with > 0)
    _calibrate(model, held or trained, place)
    model.least = _least_evidence(held or trained, langs_with, own)
    return model


def _least_evidence(held: list, langs_with: np.ndarray, own: dict[str, np.ndarray]) -> float:
    """Half-way from texts of unlearned languages to those of learned ones; where they are near, learned ones stay."""
    known, unknown = [], []
    for lang, grams in own.items():
        mine = np.zeros(PLACES, np.int32)
        mine[grams] = 1
        for *_, g in (t for t in held if t[0] == lang):
            known.append(evidence((langs_with[g] > 0).sum(), len(g)))
            unknown.append(evidence((langs_with[g] > mine[g]).sum(), len(g)))
    if not known:
        return 0.0
    low = float(np.quantile(known, REJECTED))
    return min(1 - SLACK * (1 - low), (low + float(np.median(unknown))) / 2)


def _calibrate(model: Model, held: list, place: dict[str, int]) -> None:
    if not held:
        return
    logits = np.array([(c / c.sum()) @ model.table[g] + model.bias for _, g, c, *_ in held])
    truth = np.array([place[lang] for lang, *_ in held])
    best = (np.inf, 1.0)
    for t in np.geomspace(0.05, 20, 60):
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        loss = -(z[np.arange(len(z)), truth] - np.log(np.exp(z).sum(axis=1))).mean()
        best = min(best, (loss, t))
    model.temperature = float(best[1])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = SAMPLE_PER_LANG) -> Model:
    """A model from labelled rows. The sample is drawn by a hash of the id, so it is the same on every run;
    its whole texts, as hashed counts, are all that reaches the driver."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        (F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20)) / (1 << 20)).alias("draw"))
    sizes = stored(rows.groupBy("lang").agg(F.count("*").alias("n")), shared_folder(labelled.sparkSession), "langs")
    drawn = rows.join(small(sizes, 64), "lang").filter(F.col("draw") * F.col("n") < per_lang).select("lang", "text")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams, n = np.unique(subwords(text), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([grams.astype(np.int32).tolist()], pa.list_(pa.int32())),
                     pa.array([n.astype(np.int32).tolist()], pa.list_(pa.int32()))], ["lang", "grams", "n"])

    found = drawn.mapInArrow(counts, "lang string, grams array<int>, n array<int>").toArrow()
    texts = [(lang, g.values.to_numpy(), n.values.to_numpy()) for lang, g, n in zip(
        found.column("lang").to_pylist(), found.column("grams"), found.column("n"))]
    return fit(sorted(texts, key=lambda t: (t[0], len(t[1]), t[1].tobytes(), t[2].tobytes())))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) of every row, from its whole text and nothing else.

    ``lang_pred`` is ``und``, with score 0, if the text is null, empty or has no letter, or if nothing was
    learned. Those and texts under the least evidence are rejected. Null ids and repeated rows are kept.
    """
    return _with_prediction(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model, "text").drop("text")


def _with_prediction(docs: DataFrame, model: Model, text_col: str, names=("lang_pred", "score", "rejected")) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    at = docs.columns.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**shared.value)
        for batch in batches:
            made = [own.predict(t.as_py()) for t in batch.column(at)]
            out = [pa.array([m[i] for m in made], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], [*batch.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(predict, f"{fields}, {names[0]} string, {names[1]} double, {names[2]} boolean")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    names = tuple(f"__{n}" for n in ("lang", "score", "rejected"))
    return _with_prediction(docs, model, text_col, names).filter(f"not {names[2]}").drop(*names)
