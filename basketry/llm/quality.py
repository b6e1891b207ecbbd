"""Quality rules: base counts of every text, then lines that too many documents of a host share.

A line is normalised to its words, ASCII letters in lower case and digits as ``0``. For each
host (``source``) a line is boilerplate if more than ``max_share`` of the host's distinct texts hold
it, or more than ``most_docs`` of them, whichever is less, so that a line does not stay because its
host is large; and more than ``min_docs`` in any case, as a share says nothing of a few texts. Exact copies count as
one document, so that a text is not taken for boilerplate because it was copied. Boilerplate lines
are removed; a document that loses lines and then has under ``least_left`` words, or under
``min_left`` of them, is depleted and rejected.

Null and empty texts have no words and fail the base rule. Null and empty sources are one host.
Equal rows get equal results, an empty table gives none, and other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from basketry.llm.blocks import (
    LOWER,
    SMALL_BYTES,
    Block,
    Words,
    sequence_hashes,
    small_batches,
    span_hashes,
    text_blocks,
    tidy,
)
from basketry.llm.tables import keyed, row_key, same_row, stored, text_schema, with_text

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
MAX_SHARE = 0.1
MIN_DOCS, MOST_DOCS = 5, 1000
MIN_LEFT, LEAST_LEFT = 0.3, MIN_WORDS
PIPELINE_LIMITS = {"most_docs": MOST_DOCS, "least_left": LEAST_LEFT}

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_PLAIN = LOWER.copy()
_PLAIN[48:58] = 48

_PASSED = ("uid", "doc_id", "source", "row_key")
_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_SCHEMA = f"uid long, doc_id long, source string, row_key long, {_COUNTS}, content long, lines array<long>, line_words array<int>"


def _repeats(groups: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: equal to an earlier one of its group; equal to any other of its group."""
    order = np.lexsort((hashes, groups))
    same = np.zeros(len(order) + 1, bool)
    if len(order):
        same[1:-1] = (np.diff(groups[order]) == 0) & (hashes[order][1:] == hashes[order][:-1])
    later, any_other = np.zeros(len(order), bool), np.zeros(len(order), bool)
    later[order] = same[:-1]
    any_other[order] = same[:-1] | same[1:]
    return later, any_other


def text_lines(block: Block, words: Words) -> tuple[np.ndarray, ...]:
    """Lines that hold a word: (text, first word, start byte, end byte)."""
    breaks = np.flatnonzero(block.data == 10)
    before = np.searchsorted(breaks, words.starts)
    text = np.repeat(np.arange(len(block)), words.counts)
    opens = np.ones(len(text), bool)
    opens[1:] = (np.diff(before) != 0) | (np.diff(text) != 0)
    first = np.flatnonzero(opens)
    text, before = text[first], before[first]
    edges = np.concatenate([[-1], breaks, [len(block.data)]])
    start = np.maximum(block.offsets[text], edges[before] + 1)
    end = np.minimum(block.offsets[text + 1], edges[before + 1])
    return text, first, start, end


def plain_lines(block: Block, words: Words, first: np.ndarray) -> np.ndarray:
    """Hash of each line's normalised words, given the first word of each line."""
    plain = span_hashes(_PLAIN[block.data], words.starts, words.ends)
    return sequence_hashes(plain, first, np.append(first[1:], len(plain)))


def _count_block(block: Block) -> dict[str, np.ndarray]:
    data, n = block.data, len(block)
    words = Words(block, lower=False)
    text, first, start, end = text_lines(block, words)
    earlier, _ = _repeats(text, span_hashes(data, start, end))

    at, hashes = words.windows(REPEAT_WINDOW)
    word_text = np.repeat(np.arange(n), words.counts)
    _, twice = _repeats(word_text[at], hashes)
    steps = np.zeros(len(words.hashes) + 1, np.int64)
    steps[at[twice]] += 1
    steps[at[twice] + REPEAT_WINDOW] -= 1
    covered = np.cumsum(steps[:-1]) > 0

    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[words.starts] += 1
    in_word[words.ends] -= 1
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    return {
        "n_words": words.counts,
        "word_chars": block.per_text(in_word & ((data & 0xC0) != 0x80)),
        "n_symbols": block.per_text(_SYMBOL[data]),
        "n_dup_lines": np.bincount(text[earlier], minlength=n),
        "n_repeat_words": np.bincount(word_text[covered], minlength=n),
        "content": span_hashes(data, block.offsets[:-1], block.offsets[1:]),
        "line_cuts": np.searchsorted(text, np.arange(n + 1)),
        "lines": plain_lines(block, words, first),
        "line_words": np.diff(np.append(first, len(words.starts))),
    }


@tidy
def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, block in text_blocks(batch, "text", SMALL_BYTES):
            found = _count_block(block)
            cuts = pa.array(found.pop("line_cuts"), pa.int32())
            own = batch.slice(low, high - low)
            columns = [own.column(name) for name in _PASSED]
            columns += [pa.array(found[c], pa.int64()) for c in _COUNTS.replace(" long", "").split(", ")]
            columns.append(pa.array(found["content"].view(np.int64)))
            columns.append(pa.ListArray.from_arrays(cuts, pa.array(found["lines"].view(np.int64))))
            columns.append(pa.ListArray.from_arrays(cuts, pa.array(found["line_words"], pa.int32())))
            names = [*_PASSED, *_COUNTS.replace(" long", "").split(", ")]
            yield pa.RecordBatch.from_arrays(columns, [*names, "content", "lines", "line_words"])


def measure(docs: DataFrame) -> DataFrame:
    """Counts, content hash and normalised lines of every row; one pass over the texts, stored."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        row_key("source", "text").alias("row_key"),
        F.col("text").cast("string").alias("text"),
    )
    return stored(rows.mapInArrow(_measure, _SCHEMA), "quality")


def boilerplate(
    measured: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, most_docs: int = MOST_DOCS
) -> DataFrame:
    """(source, line): lines held by too many distinct texts of a host."""
    per_host = (
        measured.select("source", "content").distinct().groupBy("source").agg(F.count("*").alias("host_docs"))
    )
    per_line = (
        measured.select("source", "content", F.explode(F.array_distinct("lines")).alias("line"))
        .distinct()
        .groupBy("source", "line")
        .agg(F.count("*").alias("docs"))
        .where(F.col("docs") > min_docs)
    )
    too_many = (F.col("docs") > F.col("host_docs") * max_share) | (F.col("docs") > most_docs)
    return per_line.join(per_host, "source").where(too_many).select("source", "line")


def judge(
    docs: DataFrame,
    max_share: float = MAX_SHARE,
    min_docs: int = MIN_DOCS,
    min_left: float = MIN_LEFT,
    min_words: int = MIN_WORDS,
    most_docs: int = MOST_DOCS,
    least_left: int = LEAST_LEFT,
) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``removed_words``, ``kept`` and ``bad_lines``.

    ``bad_lines`` lists the normalised lines to remove (null: none).
    """
    measured = measure(docs)
    bad = stored(boilerplate(measured, max_share, min_docs, most_docs), "boilerplate")
    lines = measured.select("uid", "source", F.explode(F.arrays_zip("lines", "line_words")).alias("x"))
    lost = (
        lines.select("uid", "source", F.col("x.lines").alias("line"), F.col("x.line_words").alias("n"))
        .join(bad, ["source", "line"])
        .groupBy("uid")
        .agg(F.sum("n").alias("removed_words"), F.collect_set("line").alias("bad_lines"))
    )
    n, removed = F.col("n_words"), F.coalesce("removed_words", F.lit(0))
    failed = (n < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    left = n - removed
    depleted = (removed > 0) & ((left < n * min_left) | (left < least_left))
    return (
        measured.drop("lines", "line_words")
        .join(lost, "uid", "left")
        .withColumn("removed_words", removed)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
    )


@tidy
def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bad = batch.column("bad_lines").to_pylist()
        for low, high, block in text_blocks(batch, "text", SMALL_BYTES):
            words = Words(block, lower=False)
            text, first, start, end = text_lines(block, words)
            lines = plain_lines(block, words, first).view(np.int64)
            texts = []
            for i in range(high - low):
                raw, unwanted = block.text(i), bad[low + i]
                if unwanted:
                    own = np.flatnonzero(text == i)
                    drop = own[np.isin(lines[own], unwanted)]
                    base, pieces, done = block.offsets[i], [], 0
                    for a, b in zip(start[drop] - base, end[drop] - base):
                        pieces.append(raw[done:a])
                        done = min(b + 1, len(raw))  # with its line break
                    raw = b"".join(pieces) + raw[done:]
                texts.append(raw)
            own_rows = batch.slice(low, high - low)
            fresh = pa.array(texts, pa.binary()).cast(pa.string())
            fresh = pc.if_else(own_rows.column("text").is_valid(), fresh, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([own_rows.column("row"), fresh], ["row", "text"])


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, without their boilerplate lines, with all their columns."""
    small_batches(docs.sparkSession)
    good = (
        judge(docs, **limits)
        .where("kept")
        .select("doc_id", "row_key", "bad_lines")
        .dropDuplicates(["doc_id", "row_key"])
    )
    rows = keyed(docs, "source", "text")
    rows = rows.join(good, same_row(rows, good)).select("row", "row.text", good["bad_lines"])
    return with_text(rows.mapInArrow(_strip, text_schema(docs)), docs)
