"""Quality classifier: a convolutional network over bytes, in numpy.

Input are the UTF-8 bytes of a text and nothing else.  Learned filters of WIDTH bytes run
over every byte; the bytes are laid out in chunks that overlap by WIDTH - 1, so that no
window is lost at a chunk's end, and the chunks cover the whole text.  Each filter is
max-pooled over each chunk; the greatest and the mean of the chunk maxima go into one
logistic unit.

A filter is a table of weights by place and byte, so that a window's response is a sum of
look-ups; pairs of places share one table of 65,536 rows.  Max-pooling makes the gradient
sparse: only the window that gave a chunk its maximum learns.

The model is fitted on the driver, on at most ``MAX_ROWS`` labelled rows of each label,
whatever their length, a bound that does not grow with the corpus.  A text of more than
``MAX_CHUNKS`` chunks is learned from by so many stretches of it, evenly spread from its
first byte to its last.  Scoring covers every byte of every text and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record_batch, slices, texts

WIDTH, FILTERS, CHUNK = 6, 16, 256
#: Bound of the sample that the model is fitted on: rows of each label, chunks of a text.
MAX_ROWS = 2000
MAX_CHUNKS = 512
EPOCHS, BATCH, RATE, SEED = 12, 32, 0.03, 11
#: Scores from this on are predicted as label 1.
THRESHOLD = 0.3
#: Chunks that are looked up at a time.
SLAB = 256


def array_of(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def stretches(text: bytes, most: int = MAX_CHUNKS) -> bytes:
    """The text, or ``most`` stretches of it if it has more chunks: a chunk each, with zeros
    instead of the bytes that overlap the next, evenly spread, the first and last included."""
    if len(text) <= most * CHUNK:
        return text
    own = CHUNK - WIDTH + 1
    starts = np.linspace(0, len(text) - own, most).astype(np.int64)
    return b"".join(text[a : a + own] + bytes(WIDTH - 1) for a in starts.tolist())


def laid_out(inputs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One run of bytes and the number of chunks of each text; at least WIDTH - 1 zeros
    follow each text."""
    chunks = np.array([-(-(len(x) + WIDTH - 1) // CHUNK) for x in inputs], np.int64)
    flat = np.zeros(int(chunks.sum()) * CHUNK + WIDTH, np.uint8)
    at = 0
    for x, n in zip(inputs, chunks.tolist(), strict=True):
        flat[at : at + len(x)] = x
        at += n * CHUNK
    return flat, chunks


@dataclass
class Model:
    table: np.ndarray  # WIDTH, 256, FILTERS; byte 0 has no weight
    weights: np.ndarray  # 2 * FILTERS: greatest and mean of the chunk maxima
    bias: float

    def pairs(self) -> list[np.ndarray]:
        t = self.table
        return [np.ascontiguousarray((t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, -1), np.float32) for j in range(0, WIDTH, 2)]

    def maxima(self, flat: np.ndarray, chunks: np.ndarray, pairs: list[np.ndarray], where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Maximum (0 at least) of each chunk and filter, and the place in the chunk."""
        total = int(chunks.sum())
        out = np.empty((total, FILTERS), np.float32)
        places = np.empty((total, FILTERS), np.int64) if where else None
        ends = np.zeros(total, bool)
        ends[np.cumsum(chunks) - 1] = True
        for a in range(0, total, SLAB):
            b = min(total, a + SLAB)
            bytes_ = flat[a * CHUNK : b * CHUNK + WIDTH - 1].astype(np.int64)
            index = bytes_[:-1] * 256 + bytes_[1:]
            n = (b - a) * CHUNK
            z = np.take(pairs[0], index[:n], axis=0)
            for j in range(1, WIDTH // 2):
                z += np.take(pairs[j], index[2 * j : 2 * j + n], axis=0)
            z = z.reshape(b - a, CHUNK, FILTERS)
            z[ends[a:b], CHUNK - WIDTH + 1 :] = 0  # windows that begin behind the text
            if where:
                places[a:b] = z.argmax(1)
            out[a:b] = z.max(1)
        return np.maximum(out, 0), places

    def pooled(self, maxima: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        starts = np.concatenate([[0], np.cumsum(chunks)[:-1]])
        wide = maxima.astype(np.float64)
        return np.concatenate([np.maximum.reduceat(wide, starts), np.add.reduceat(wide, starts) / chunks[:, None]], axis=1)

    def scores(self, inputs: list[np.ndarray], pairs: list[np.ndarray]) -> np.ndarray:
        flat, chunks = laid_out(inputs)
        h = self.pooled(self.maxima(flat, chunks, pairs)[0], chunks)
        return _sigmoid((h * self.weights).sum(1) + self.bias)  # row by row: the same in any batch


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Adam:
    def __init__(self, shape: tuple[int, ...], rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.99 * self.v + 0.01 * gradient * gradient
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def fit(rows: list[tuple[bytes, int]], weight: dict[int, float], epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """The network for (text, label) rows; ``weight`` is the weight of a row by its label.

    With one label only, or none, the score is a constant: its share.  Rows are used as they
    are given, equal ones each.
    """
    rng = np.random.default_rng(seed)
    mass = {y: weight.get(y, 1.0) * sum(1 for _, label in rows if label == y) for y in (0, 1)}
    prior = (mass[1] + 1) / (mass[0] + mass[1] + 2)
    model = Model(np.zeros((WIDTH, 256, FILTERS)), np.zeros(2 * FILTERS), float(np.log(prior / (1 - prior))))
    if not mass[0] or not mass[1]:
        return model
    model.table = rng.normal(0, 0.3, (WIDTH, 256, FILTERS))
    model.table[:, 0] = 0
    model.weights = rng.normal(0, 0.3, 2 * FILTERS)
    inputs, labels = [array_of(t) for t, _ in rows], np.array([y for _, y in rows], float)
    share = np.array([weight.get(int(y), 1.0) for y in labels])
    share = share / share.mean()
    steps = _Adam(model.table.shape, RATE), _Adam(model.weights.shape, RATE), _Adam((1,), RATE)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), BATCH):
            own = order[a : a + BATCH]
            flat, chunks = laid_out([inputs[i] for i in own])
            maxima, places = model.maxima(flat, chunks, model.pairs(), where=True)
            h = model.pooled(maxima, chunks)
            error = (_sigmoid(h @ model.weights + model.bias) - labels[own]) * share[own] / len(own)
            starts = np.cumsum(chunks) - chunks
            of = np.repeat(np.arange(len(own)), chunks)
            # the error goes to each chunk's maximum by its part in the mean, and to the greatest one by all of it
            back = (error / chunks)[of][:, None] * model.weights[FILTERS:]
            greatest = maxima >= np.maximum.reduceat(maxima, starts)[of]
            back = np.where(maxima > 0, back + greatest * error[of][:, None] * model.weights[:FILTERS], 0)
            chunk, filt = np.nonzero(back)
            begin = chunk * CHUNK + places[chunk, filt]
            gradient = np.zeros_like(model.table)
            for k in range(WIDTH):
                np.add.at(gradient[k], (flat[begin + k], filt), back[chunk, filt])
            gradient[:, 0] = 0
            model.table -= steps[0].step(gradient + 1e-5 * model.table)
            model.weights -= steps[1].step(h.T @ error + 1e-4 * model.weights)
            model.bias -= float(steps[2].step(np.array([error.sum()]))[0])
    return model


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS, max_chunks: int = MAX_CHUNKS) -> tuple[list[tuple[bytes, int]], dict[int, float]]:
    """The sample (text, label) and the weight of a row by its label.

    Labelled ids outside fold 0, in order of a hash of the id: the first ``max_rows`` of each
    label.  Labels other than 0 and 1, and of null ids, are left out; an id with both labels
    counts as 0; of texts with one id the greatest is taken; a null text is an empty one.
    Long texts come as their stretches().  Weights restore the shares that the labels have
    among all labelled rows.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & (fold(id_col) != 0)).groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.min(F.col(label).cast("int")).alias("__y"))
    counts = {r["__y"]: r["n"] for r in known.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    wanted = []
    for y in (0, 1):
        wanted += [(r["__id"], y) for r in known.filter(F.col("__y") == y).select("__id").orderBy(F.xxhash64("__id"), "__id").limit(max_rows).collect()]
    if not wanted:
        return [], {}
    chosen = F.broadcast(docs.sparkSession.createDataFrame(wanted, "__id long, __y int"))  # at most two times max_rows
    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).join(chosen, F.col("id") == F.col("__id"))
    once = found.groupBy("id", "__y").agg(F.max("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([stretches(t, max_chunks) for t in texts(batch.column(2))], pa.binary())], ["id", "y", "text"])

    rows = map_batches(once, cut, "id long, y int, text binary").collect()
    sample = [(bytes(r["text"]), r["y"]) for r in sorted(rows, key=lambda r: r["id"])]
    drawn = {y: sum(1 for _, z in sample if z == y) for y in (0, 1)}
    return sample, {y: counts.get(y, 0) / drawn[y] for y in (0, 1) if drawn[y]}


def _by_bytes(rows: list[bytes], most: int = 1 << 22) -> Iterator[list[bytes]]:
    """The texts in groups of about ``most`` bytes, or one text."""
    own, size = [], 0
    for t in rows:
        if own and size + len(t) > most:
            yield own
            own, size = [], 0
        own.append(t)
        size += len(t)
    if own:
        yield own


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and score (0 to 1), one row per row of ``docs``; a null text is an empty one, and
    an empty one has a score too.  Equal texts have equal scores, a null id stays null, an
    empty table gives no rows.  A text of any length is scored over all its bytes, SLAB chunks
    at a time."""
    schema = pa.schema([("id", pa.int64()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = model.pairs()
        for batch in slices(batches, 64):
            found: list[np.ndarray] = []
            for own in _by_bytes(texts(batch.column(1))):
                found.append(model.scores([array_of(t) for t in own], pairs))
            yield record_batch(schema, [batch.column(0), np.concatenate([*found, np.empty(0)])])

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text)), work, "id long, score double")
