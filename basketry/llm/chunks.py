"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of each text; it depends on the last ``REACH`` bytes alone. A cut
is where it is smallest among its ``LEAST`` neighbours on either side, so that cuts depend on the
content around them alone, not on the cut before, and an insertion changes the chunks around it only.
Cuts near the ends of a text would depend on its neighbours and are left out. Equal chunks, by a
128-bit digest, are kept where they come first (smallest doc_id, then table order, then place).
Runs of later copies that make up at least ``least_run`` bytes are removed; shorter ones, such as
a stray common phrase, stay. Chunks of under ``LEAST`` bytes, which only end a text, never count.

Null and empty texts have no chunks. Rows with equal ids are told apart by their place in the
table; null ids sort last. Every row gets one result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.blocks import Block, mix, small_batches, span_hashes, text_blocks
from basketry.llm.tables import stored, text_schema, with_text

REACH = 16
LEAST, MOST = 16, 512  # a cut every 2 * LEAST + 1 bytes on average
LEAST_RUN = 64

_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: sum of gear[byte] << age over the last REACH bytes."""
    h = _GEAR[data]
    width = 1
    while width < REACH:
        older = np.zeros_like(h)
        older[width:] = h[:-width] << np.uint32(width)
        h = h + older
        width *= 2
    return h


def cut_places(block: Block) -> np.ndarray:
    """Ends of chunks by content: bytes whose hash is the smallest of LEAST on either side."""
    h = gear(block.data)
    n = len(h)
    if n < 2 * LEAST + REACH:
        return np.zeros(0, np.int64)
    least, width = h, 1  # smallest of ``width`` hashes from here on
    while width < LEAST:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    at = np.arange(LEAST, n - LEAST)
    at = at[(h[at] < least[at - LEAST]) & (h[at] <= least[at + 1])]
    text = np.searchsorted(block.offsets, at, "right") - 1
    inside = (at - LEAST - REACH + 1 >= block.offsets[text]) & (at + LEAST < block.offsets[text + 1])
    return at[inside] + 1


def chunk_ends(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(text, end byte in the block) of every chunk."""
    cuts = cut_places(block).tolist()
    texts, ends = [], []
    at = 0
    for i in range(len(block)):
        low, end = int(block.offsets[i]), int(block.offsets[i + 1])
        while low < end:
            at = bisect_left(cuts, low + LEAST, at)
            last = min(low + MOST, end)
            low = cuts[at] if at < len(cuts) and cuts[at] <= last else last
            texts.append(i)
            ends.append(low)
    return np.array(texts, np.int64), np.array(ends, np.int64)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, block in text_blocks(batch, "text"):
            own = batch.slice(low, high - low)
            texts, ends = chunk_ends(block)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
            first = span_hashes(block.data, starts, ends)
            second = span_hashes(block.data[::-1], len(block.data) - ends, len(block.data) - starts)
            cuts = pa.array(np.searchsorted(texts, np.arange(len(block) + 1)), pa.int32())
            lists = [
                pa.array((starts - block.offsets[texts]), pa.int32()),
                pa.array((ends - starts), pa.int32()),
                pa.array(first.view(np.int64)),
                pa.array(mix(second + np.uint64(1)).view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *own.columns[:2],
                    pa.array(block.lengths, pa.int64()),
                    *(pa.ListArray.from_arrays(cuts, x) for x in lists),
                ],
                ["uid", "doc_id", "n_bytes", "start", "length", "d1", "d2"],
            )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for chunks in batch.column(1).to_pylist():
            runs: list[list[int]] = []
            for c in sorted(chunks, key=lambda c: c["start"]):
                if runs and runs[-1][1] == c["start"]:
                    runs[-1][1] += c["length"]
                else:
                    runs.append([c["start"], c["start"] + c["length"]])
            out.append([{"start": a, "stop": b} for a, b in runs])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["uid", "runs"])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )


def repeated(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """Every row's uid, doc_id, n_bytes, n_chunks and ``spans`` (start, stop) of bytes to remove."""
    small_batches(docs.sparkSession)
    schema = (
        "uid long, doc_id long, n_bytes long, start array<int>, length array<int>, d1 array<long>, d2 array<long>"
    )
    chunked = stored(_rows(docs).mapInArrow(_digest, schema), "chunks")
    chunks = chunked.select(
        "uid", "doc_id", F.explode(F.arrays_zip("start", "length", "d1", "d2")).alias("c")
    ).select("uid", "doc_id", "c.*")
    chunks = chunks.where(F.col("length") >= LEAST)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid", "start")
    first = (
        chunks.groupBy("d1", "d2")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .where("n > 1")
        .select("d1", "d2", F.col("first.uid").alias("first_uid"), F.col("first.start").alias("first_start"))
    )
    first = stored(first, "first-chunks")  # so that the join may split a very common chunk
    later = chunks.join(first, ["d1", "d2"]).where("uid <> first_uid OR start <> first_start")
    runs = (
        later.groupBy("uid")
        .agg(F.collect_list(F.struct("start", "length")).alias("chunks"))
        .mapInArrow(_runs, "uid long, runs array<struct<start:int,stop:int>>")
    )
    long_runs = F.filter("runs", lambda r: r["stop"] - r["start"] >= least_run)
    none = F.array().cast("array<struct<start:int,stop:int>>")
    return chunked.join(runs, "uid", "left").select(
        "uid",
        "doc_id",
        "n_bytes",
        F.size("d1").cast("long").alias("n_chunks"),
        F.coalesce(long_runs, none).alias("spans"),
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans").to_pylist()
        texts = []
        for text, own in zip(batch.column("text").to_pylist(), spans):
            if text is not None and own:
                raw, pieces, done = text.encode(), [], 0
                for s in own:
                    pieces.append(raw[done : s["start"]])
                    done = s["stop"]
                # a cut may fall inside a character: what is left of it goes
                text = b"".join([*pieces, raw[done:]]).decode("utf-8", "ignore")
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def deduplicate(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """``docs`` without the repeated runs, all other columns as they were."""
    numbered = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("no")), "numbered")
    # the row number stands in for the id, so that each row finds its own spans
    spans = repeated(numbered.select(F.col("no").alias("doc_id"), "row.text"), least_run)
    joined = numbered.join(spans.select(F.col("doc_id").alias("no"), "spans"), "no", "left")
    rows = joined.select("row", "row.text", "spans")
    return with_text(rows.mapInArrow(_cut, text_schema(docs)), docs)
