"""Quality of texts: random-indexing word vectors, pooled, and a two-layer network.

*Words* are runs of letters and digits, or of signs, told apart by case (small, capitalised,
capitals) and hashed into ``BUCKETS``. Each bucket has a fixed sparse *index vector* (a few +1 and -1 in
``DIMENSIONS`` places); a word's vector is the sum of the index vectors of the words up to ``REACH`` places
around each of its occurrences, over all documents given, in one pass with one sum per bucket.
The vectors are centred and scaled to length one.

*Pooling*: mean and spread of a text's word vectors, the mean step between one vector and the next (which
is nil where words repeat), and the logarithm of the number of words.

*Network*: one hidden layer, fitted by numpy on the driver on at most ``MOST_LABELLED`` pooled rows of labelled
documents (those with the least digests of the id, a few hundred bytes each). A share of them is set aside to find the temperature that
divides the outputs so that the probabilities are calibrated. The model is broadcast: ``BUCKETS`` vectors of
``DIMENSIONS`` floats (1 MB) and the network, whatever the corpus.

* null text counts as empty; an empty text, or one without words, has an all-zero pooling and is scored by it.
* Several labels of one id count as their mean; labels other than 0 and 1, or without an id, teach nothing.
* Without any label the score is 0.5 for every row; with labels of one kind only it tends to that kind.
* Repeated rows have equal scores; an empty table has none. Columns of the input other than the text come
  back in the struct ``row`` and so clash with no name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from basketry.llm.blocks import LOWER, SIGNS, SPACE, Block, small_batches, span_hashes, text_blocks

BUCKETS = 1 << 13
DIMENSIONS = 32
NONZEROS = 4
REACH = 2
HIDDEN = 24
MOST_LABELLED = 20_000
EPOCHS = 40
BATCH = 128
RATE = 0.003
DECAY = 1e-4
SEED = 20240311
POOLED = 3 * DIMENSIONS + 1

_CASES = 4  # small, capitalised, capitals, signs: a quarter of the buckets each
_KIND = np.where(SPACE, 0, np.where(SIGNS, 2, 1)).astype(np.int8)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For each bucket the places of its nonzeros, and their signs."""
    draw = np.random.Generator(np.random.PCG64(SEED))
    places = np.argsort(draw.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZEROS]
    return places, np.where(np.arange(NONZEROS) % 2 == 0, 1, -1)


def block_words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word of a block in order, and where the words of each text begin (one more than texts)."""
    data = block.data
    kind = _KIND[data]
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[block.offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    word = kind[starts] != 0
    starts, ends = starts[word], ends[word]
    capitals = block.prefix_sums((data >= 65) & (data <= 90))
    n_capitals = capitals[ends] - capitals[starts]
    case = np.minimum(n_capitals, 1)
    case[(n_capitals > 1) & (2 * n_capitals > ends - starts)] = 2
    case[kind[starts] == 2] = 3
    hashes = span_hashes(LOWER[data], starts, ends)
    share = BUCKETS // _CASES
    buckets = case * share + (hashes % np.uint64(share)).astype(np.int64)
    return buckets, np.searchsorted(starts, block.offsets)


def _add_contexts(sums: np.ndarray, block: Block, places: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Add the index vectors of all neighbours to ``sums``; how often each bucket occurred."""
    buckets, bounds = block_words(block)
    text = np.repeat(np.arange(len(block)), np.diff(bounds))
    flat = sums.reshape(-1)
    for reach in range(1, REACH + 1):
        together = np.flatnonzero(text[:-reach] == text[reach:])
        one, two = buckets[together], buckets[together + reach]
        for word, context in ((one, two), (two, one)):
            base = word * DIMENSIONS
            for j in range(NONZEROS):
                flat += signs[j] * np.bincount(base + places[context, j], minlength=len(flat))
    return np.bincount(buckets, minlength=BUCKETS)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    sums = np.zeros((BUCKETS, DIMENSIONS), np.int64)
    seen = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, block in text_blocks(batch, "text"):
            seen += _add_contexts(sums, block, places, signs)
    at = np.flatnonzero(seen)
    if len(at):
        columns = [pa.array(at.astype(np.int32)), pa.array(seen[at]), *(pa.array(sums[at, d]) for d in range(DIMENSIONS))]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "n", *(f"d{d}" for d in range(DIMENSIONS))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Centred vectors of length one (nil for what does not occur) from all texts of ``docs``."""
    small_batches(docs.sparkSession)
    names = ["n", *(f"d{d}" for d in range(DIMENSIONS))]
    schema = "bucket int, " + ", ".join(f"{x} long" for x in names)
    summed = (
        docs.select(F.col("text").cast("string").alias("text"))
        .mapInArrow(_index, schema)
        .groupBy("bucket")
        .agg(*(F.sum(x).alias(x) for x in names))
        .toArrow()
    )
    table = np.zeros((BUCKETS, 1 + DIMENSIONS))
    table[summed["bucket"].to_numpy()] = np.column_stack([summed[x].to_numpy() for x in names])
    return unit_vectors(table[:, 0], table[:, 1:])


def unit_vectors(seen: np.ndarray, sums: np.ndarray) -> np.ndarray:
    known = seen > 0
    means = sums / np.maximum(seen, 1)[:, None]
    centred = np.where(known[:, None], means - sums.sum(axis=0) / max(seen.sum(), 1), 0)
    length = np.linalg.norm(centred, axis=1, keepdims=True)
    return np.divide(centred, length, out=np.zeros_like(centred), where=length > 1e-12).astype(np.float32)


def pool(block: Block, vectors: np.ndarray) -> np.ndarray:
    """A row of ``POOLED`` numbers for each text."""
    buckets, bounds = block_words(block)
    n = np.diff(bounds)
    pooled = np.zeros((len(block), POOLED), np.float32)
    full = np.flatnonzero(n)
    if not len(full):
        return pooled
    own = vectors[buckets]
    share = n[full, None].astype(np.float32)
    mean = np.add.reduceat(own, bounds[full]) / share
    square = np.add.reduceat(own * own, bounds[full]) / share
    step = np.zeros_like(own)
    np.abs(own[1:] - own[:-1], out=step[1:])
    step[bounds[full]] = 0
    steps = np.add.reduceat(step, bounds[full]) / np.maximum(share - 1, 1)
    spread = np.sqrt(np.maximum(square - mean * mean, 0))
    pooled[full] = np.concatenate([mean, spread, steps, np.log1p(share)], axis=1)
    return pooled


@dataclass
class Model:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]  # weights and offsets of the hidden and of the last layer
    temperature: float

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        hidden = np.tanh((pooled - self.centre) / self.scale @ w1 + b1)
        return hidden @ w2 + b2

    def score(self, pooled: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(pooled.astype(np.float64)) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor with the least log loss, by golden section on its logarithm."""
    ratio = (5**0.5 - 1) / 2
    low, high = np.log(0.2), np.log(10.0)
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if _loss(logits / np.exp(a), y) <= _loss(logits / np.exp(b), y) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_network(vectors: np.ndarray, pooled: np.ndarray, y: np.ndarray, aside: np.ndarray) -> Model:
    """Fit on the rows not ``aside`` with Adam steps, then calibrate on those aside."""
    x = pooled.astype(np.float64)
    centre = x.mean(axis=0) if len(x) else np.zeros(POOLED)
    scale = x.std(axis=0) + 1e-6 if len(x) else np.ones(POOLED)
    draw = np.random.Generator(np.random.PCG64(SEED + 1))
    layers = [draw.normal(0, POOLED**-0.5, (POOLED, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(())]
    model = Model(vectors, centre, scale, layers, 1.0)
    fit = np.flatnonzero(~aside)
    if not len(fit):
        return model
    prior = np.clip(y[fit].mean(), 1e-3, 1 - 1e-3)
    layers[3] = np.asarray(np.log(prior / (1 - prior)))
    x = (x - centre) / scale
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in layers]
    t = 0
    for _ in range(EPOCHS):
        order = draw.permutation(fit)
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            w1, b1, w2, b2 = layers
            hidden = np.tanh(x[rows] @ w1 + b1)
            error = (_sigmoid(hidden @ w2 + b2) - y[rows]) / len(rows)
            back = np.outer(error, w2) * (1 - hidden * hidden)
            slopes = [x[rows].T @ back + DECAY * w1, back.sum(axis=0), hidden.T @ error + DECAY * w2, error.sum()]
            t += 1
            for k, slope in enumerate(slopes):
                first, second = moments[k]
                moments[k] = first, second = [0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2]
                layers[k] = layers[k] - RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    if aside.any():
        model.temperature = _temperature(model.logits(pooled[aside].astype(np.float64)), y[aside])
    return model


def _pooled(rows: DataFrame, vectors: np.ndarray) -> DataFrame:
    """``rows`` with the column ``pooled`` in place of ``text``, which comes last."""
    shared = rows.sparkSession.sparkContext.broadcast(vectors)
    schema = rows.drop("text").schema.add("pooled", ArrayType(FloatType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, block in text_blocks(batch, "text"):
                numbers = pa.array(pool(block, shared.value).reshape(-1))
                made = pa.ListArray.from_arrays(pa.array(np.arange(len(block) + 1) * POOLED, pa.int32()), numbers)
                own = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*own.columns[:-1], made], schema.names)

    return rows.mapInArrow(work, schema)


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, most_labelled: int = MOST_LABELLED) -> Model:
    """Word vectors from all of ``docs``; labels (doc_id, quality) where ``may_learn`` holds for the id."""
    vectors = word_vectors(docs)
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0.0, 1.0) & may_learn)
        .groupBy("doc_id")
        .agg(F.avg("y").alias("y"))
    )
    # the bound makes this side fit for a broadcast: at most ``most_labelled`` ids
    some = known.orderBy(digest, "doc_id").limit(most_labelled)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(some), "doc_id").select("doc_id", digest.alias("digest"), "y", "text")
    # rows may share an id, so the bound is set again, on pooled rows
    sample = _pooled(rows, vectors).orderBy("digest", "doc_id", "pooled").limit(most_labelled).toArrow()
    pooled = np.asarray(sample["pooled"].combine_chunks().flatten(), np.float32).reshape(-1, POOLED)
    aside = np.array([int(d[:8], 16) % 5 == 0 for d in sample["digest"].to_pylist()], bool)
    return fit_network(vectors, pooled, sample["y"].to_numpy(), aside)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (all columns but the text) and ``score``, the calibrated probability of good quality."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("row"), F.col("text").cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, block in text_blocks(batch, "text"):
                found = shared.value.score(pool(block, shared.value.vectors))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(found)], ["row", "score"])

    return rows.mapInArrow(work, rows.select("row").schema.add("score", "double"))


def held_out(doc_id: Column) -> Column:
    """The fixed fifth of documents whose labels are never learned from."""
    remainder = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))
    return F.coalesce(remainder == 0, F.lit(False))
