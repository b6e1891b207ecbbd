"""Language of texts: multinomial naive Bayes over hashed character n-grams.

Letters are taken in lower case and everything else as a blank; the n-grams of ``ORDERS`` that
hold a letter are hashed into ``BUCKETS``. Training counts them over all labelled rows it is given,
in one pass with one sum per (language, bucket). The matrix of log-probabilities is broadcast:
``BUCKETS`` doubles for each language and at most ``MOST_LANGUAGES`` of them, 128 MB at the very
most; more languages are an error. Scoring works on blocks of texts: the buckets that occur pick
their log-probabilities, which are summed for each text.

A null text, or one without a letter, is ``und`` with score 0, as is every text if nothing was
learned. Ties go to the language that sorts first. Rows with a null text or label teach nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm.blocks import Block, mix, small_batches, text_blocks

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
MOST_LANGUAGES = 512
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its small letter, or a blank if it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (letter := chr(c)).isalpha():
            small = letter.lower()
            table[c] = ord(small) if len(small) == 1 else c
    return table


def block_grams(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: (text, bucket) of all n-grams of a block, texts in order."""
    starts = (block.data & 0xC0) != 0x80
    cuts = block.prefix_sums(starts)[block.offsets]
    points = np.frombuffer(block.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) != cuts[-1]:  # broken UTF-8: replacement moved the borders
        texts = [block.text(i).decode("utf-8", "replace") for i in range(len(block))]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        cuts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    chars = _letters()[points].astype(np.uint64)
    text = np.repeat(np.arange(len(block)), np.diff(cuts))
    blank = chars == 32
    code = np.zeros(len(chars), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        n = len(chars) - order + 1
        if n <= 0:
            return
        code = code[:n] * np.uint64(0x110000) + chars[order - 1 :]
        if order not in ORDERS:
            continue
        whole = text[:n] == text[order - 1 :]
        if order == 1:
            whole &= ~blank
        else:  # no two blanks in a row, so that long runs of other signs do not count
            for j in range(order - 1):
                whole &= ~(blank[j : j + n] & blank[j + 1 : j + 1 + n])
        buckets = mix(code + np.uint64(order)) & np.uint64(BUCKETS - 1)
        yield text[:n][whole], buckets[whole].astype(np.int32)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        labels = batch.column(batch.schema.get_field_index("label")).to_pylist()
        for low, high, block in text_blocks(batch, "text"):
            own = labels[low:high]
            names = sorted(set(own))
            label = np.array([names.index(x) for x in own], np.int64)
            for name in own:
                rows[name] = rows.get(name, 0) + 1
            for text, buckets in block_grams(block):
                found = np.bincount(label[text] * BUCKETS + buckets, minlength=len(names) * BUCKETS)
                for k, name in enumerate(names):
                    part = found[k * BUCKETS : (k + 1) * BUCKETS]
                    counts[name] = counts[name] + part if name in counts else part
    for name, n in rows.items():
        yield _tallied(name, np.array([-1]), np.array([n]))
        if name in counts:
            at = np.flatnonzero(counts[name])
            yield _tallied(name, at, counts[name][at])


def _tallied(name: str, buckets: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([name] * len(buckets)), pa.array(buckets, pa.int32()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["label", "bucket", "n"])


class Model:
    def __init__(self, languages: list[str], prior: np.ndarray, weights: np.ndarray):
        self.languages, self.prior, self.weights = languages, prior, weights

    def score(self, block: Block) -> tuple[list[str], np.ndarray]:
        """Most likely language of each text, and its posterior."""
        n = len(block)
        seen = np.zeros(n, bool)
        totals = np.tile(self.prior[:, None], (1, n))
        for text, buckets in block_grams(block):
            if not len(text):
                continue
            first = np.flatnonzero(np.diff(text, prepend=-1))
            own = text[first]
            seen[own] = True
            for k, row in enumerate(self.weights):
                totals[k, own] += np.add.reduceat(row[buckets], first)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        best = totals.argmax(axis=0)
        posterior = 1 / np.exp(totals - totals.max(axis=0)).sum(axis=0)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, seen)], np.where(seen, posterior, 0.0)


def train(docs: DataFrame, label: str = "lang") -> Model:
    """Learn from all rows of ``docs`` that have a text and a label."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("text").cast("string").alias("text"), F.col(label).cast("string").alias("label")
    ).where("text IS NOT NULL AND label IS NOT NULL")
    summed = (
        rows.mapInArrow(_tally, "label string, bucket int, n long")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .persist()
    )
    try:
        priors = summed.where("bucket = -1").orderBy("label").limit(MOST_LANGUAGES + 1).collect()
        if len(priors) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
        table = summed.where("bucket >= 0").toArrow()
    finally:
        summed.unpersist()
    languages = [p["label"] for p in priors]
    counts = np.zeros((len(languages), BUCKETS))
    row = {name: k for k, name in enumerate(languages)}
    where = np.array([row[x] for x in table["label"].to_pylist()], np.int64)
    counts[where, table["bucket"].to_numpy()] = table["n"].to_numpy()
    smooth = counts + SMOOTHING
    weights = np.log(smooth / smooth.sum(axis=1, keepdims=True)) if languages else counts
    docs_per = np.array([p["n"] for p in priors], float)
    prior = np.log(docs_per / docs_per.sum()) if languages else docs_per
    return Model(languages, prior, weights)


def predict(docs: DataFrame, model: Model, keep: list[str | Column]) -> DataFrame:
    """The columns ``keep`` of every row with ``lang_pred`` and ``score``, which replace any of those names."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, block in text_blocks(batch, "text"):
                languages, posterior = shared.value.score(block)
                own = batch.column("own").slice(low, high - low)
                columns = [own, pa.array(languages, pa.string()), pa.array(posterior)]
                yield pa.RecordBatch.from_arrays(columns, ["own", "lang_pred", "score"])

    names = [c for c in docs.select(*keep).columns if c not in ("lang_pred", "score")]
    wanted = [c for c in keep if docs.select(c).columns[0] in names]
    # as one struct, so that a kept column may have any name
    own = F.struct(*wanted) if wanted else F.struct(F.lit(True).alias("any"))
    rows = docs.select(own.alias("own"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(work, rows.drop("text").schema.add("lang_pred", "string").add("score", "double"))
    return scored.select(*(F.col(f"own.`{c}`").alias(c) for c in names), "lang_pred", "score")


def held_out() -> Column:
    """The fixed quarter of documents that is never learned from."""
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    return F.coalesce(remainder == 2, F.lit(False))
