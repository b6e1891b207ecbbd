"""Exact substring dedup: sampled suffixes, grouped by digests; what digests leave open is sorted.

Every byte goes that lies in a string of ``WINDOW`` bytes which also starts somewhere else, in any
document or the same one. Sorting a suffix for every byte would move the corpus many times over,
so suffixes are sampled by content: of the ``GRAM``-byte strings in a window the one with the
least hash (leftmost at a tie) is the window's anchor. Equal windows have equal anchors at equal
places, about one byte in 85 is an anchor, and the windows of an anchor are consecutive.

1. Anchors are counted by the hash of their leading bytes; those that occur once are done.
2. Anchors whose whole stretch of windows occurs twice or more are repeats as they are. Each
   distinct stretch is kept once, with its count, so copies by the thousand become one row.
3. What is left, stretches that agree at their anchor but differ further out, is read from the
   texts and range-partitioned by a 64-bit hash of the leading bytes. A task sorts its
   windows by a multikey sort, eight bytes at a time, going on only where neighbours still tie.
   Equal leading bytes never straddle a boundary, except for anchors of more than ``MOST`` distinct
   stretches: their windows are counted by 128-bit digests instead, which no task holds together.
4. Spans are put together for each document; only partly repeated documents are read again.

Windows never cross documents. Null texts count as empty, texts of under ``WINDOW`` bytes lose
nothing, and each row, equal rows included, gets one result. Strings are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from basketry.llm import blocks, bloom
from basketry.llm.blocks import Block, mix, small_batches, text_blocks
from basketry.llm.tables import row_key, stored

WINDOW = 200
GRAM = 32
MOST = 4096
STRETCH = 1 << 22  # window starts worked on at a time
SORTED = 1 << 19  # windows sorted at a time

_PLACE = np.uint64(24)
_SPANS = "array<struct<start:int,stop:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


# -- anchors -------------------------------------------------------------------------------


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    padded = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Anchors:
    """Anchors of a block: ``text``, first window ``low``, number of windows, place, two hashes."""

    def __init__(self, block: Block):
        data, n = block.data, len(block.data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(blocks._BYTE_CODES[data] * blocks._power("base", blocks._BASE, max(n, 1))[:n], out=self.sums[1:])
        self.inverse = blocks._power("inverse", blocks._BASE_INVERSE, n + 1)
        windows = n - WINDOW + 1
        least = [np.zeros(0, np.int64)]
        for at in range(0, max(windows, 0), STRETCH):
            end = min(windows, at + STRETCH)
            grams = self.hash(np.arange(at, end + WINDOW - GRAM), GRAM)
            places = np.arange(len(grams), dtype=np.uint64)
            ranked = (grams >> _PLACE << _PLACE) | places
            chosen = sliding_least(ranked, WINDOW - GRAM + 1) & np.uint64((1 << 24) - 1)
            least.append(chosen.astype(np.int64) + at)
        place = np.concatenate(least)
        begin, end = block.offsets[:-1], np.maximum(block.offsets[:-1], block.offsets[1:] - WINDOW + 1)
        steps = np.zeros(len(place) + 1, np.int8)
        has = end > begin
        steps[begin[has]] += 1
        valid = np.zeros(len(place), bool)
        for a, b in zip(begin[has], end[has]):
            valid[a:b] = True
        opens = valid.copy()
        opens[1:] &= (place[1:] != place[:-1]) | (steps[1:-1] > 0)
        self.low = np.flatnonzero(opens)
        self.text = np.searchsorted(block.offsets, self.low, "right") - 1
        self.count = np.minimum(np.append(self.low[1:], len(place)), end[self.text]) - self.low
        self.place = place[self.low]
        self.lead = self.hash(self.place, GRAM)
        whole = self.hash(self.low, self.count - 1 + WINDOW)
        self.stretch = mix(whole + (self.count * 4096 + self.place - self.low).astype(np.uint64))
        self.bounds = np.searchsorted(self.text, np.arange(len(block) + 1))

    def hash(self, starts: np.ndarray, lengths) -> np.ndarray:
        return mix((self.sums[starts + lengths] - self.sums[starts]) * self.inverse[starts])


def _anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, block in text_blocks(batch, "text"):
            found = Anchors(block)
            cuts = pa.array(found.bounds, pa.int32())
            own = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays(
                [
                    *own.columns[:3],
                    pa.array(block.lengths, pa.int64()),
                    pa.array([hashlib.sha256(block.text(i)).hexdigest() for i in range(len(block))]),
                    pa.ListArray.from_arrays(cuts, pa.array(found.lead.view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(found.stretch.view(np.int64))),
                ],
                ["uid", "doc_id", "row_key", "n_bytes", "sha256", "lead", "stretch"],
            )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key("doc_id", "text").alias("row_key"),
        F.col("text").cast("string").alias("text"),
    )


# -- sorted windows ------------------------------------------------------------------------


def repeated_windows(buffer: bytes, group: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Flags of windows buffer[start : start + WINDOW] that equal another one of their group.

    Multikey sort: by group, then by eight bytes at a time; windows without an equal neighbour
    drop out after each step.
    """
    words = np.ndarray((len(buffer) - 7,), ">u8", buffer, strides=(1,))
    alive = np.arange(len(starts))
    tied = group
    for step in range(WINDOW // 8 + 1):
        order = np.argsort(tied, kind="stable") if step == 0 else None
        if step:
            key = words[starts[alive] + 8 * (step - 1)].astype(np.uint64)
            order = np.lexsort((key, tied))
            key = key[order]
        alive, tied = alive[order], tied[order]
        differs = np.ones(len(alive) + 1, bool)
        if len(alive):
            differs[1:-1] = tied[1:] != tied[:-1]
            if step:
                differs[1:-1] |= key[1:] != key[:-1]
        lonely = differs[:-1] & differs[1:]
        tied = np.cumsum(differs[:-1])[~lonely]
        alive = alive[~lonely]
        if not len(alive):
            break
    flags = np.zeros(len(starts), bool)
    flags[alive] = True
    return flags


def _merged(starts: np.ndarray) -> list[dict[str, int]]:
    """Spans covered by the windows with these sorted starts."""
    spans: list[dict[str, int]] = []
    for s in starts.tolist():
        if spans and s <= spans[-1]["stop"]:
            spans[-1]["stop"] = s + WINDOW
        else:
            spans.append({"start": s, "stop": s + WINDOW})
    return spans


def _sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of the records of a range; records with equal leads are neighbours."""
    names = ("lead", "uid", "anchor_no", "low", "windows", "anchor_at", "copies")
    pending: list[pa.RecordBatch] = []
    waiting = 0

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        own = {c: rows.column(c).to_numpy() for c in names}
        # a record may come twice if its row does; one is enough
        order = np.lexsort((own["anchor_no"], own["uid"]))
        again = np.zeros(len(order), bool)
        again[order[1:]] = (np.diff(own["uid"][order]) == 0) & (np.diff(own["anchor_no"][order]) == 0)
        once = np.flatnonzero(~again)
        own = {c: v[once] for c, v in own.items()}
        context = rows.column("context").take(pa.array(once)).to_pylist()
        ends = np.cumsum([len(c) for c in context])
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        record = np.repeat(np.arange(len(once)), own["windows"])
        nth = np.arange(len(record)) - np.repeat(np.cumsum(own["windows"]) - own["windows"], own["windows"])
        lead_no = np.unique(own["lead"], return_inverse=True)[1]
        group = lead_no[record].astype(np.int64) * 4096 + own["anchor_at"][record] - nth
        flags = repeated_windows(b"".join(context) + bytes(8), group, begins[record] + nth)
        flags &= own["copies"][record] == 1
        hit = np.flatnonzero(flags)
        cuts = np.flatnonzero(np.diff(record[hit], prepend=-1))
        uids, spans = [], []
        for part in np.split(hit, cuts[1:]) if len(hit) else []:
            r = record[part[0]]
            uids.append(own["uid"][r])
            spans.append(_merged(own["low"][r] + nth[part]))
        if uids:
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(spans, _SPAN_TYPE)], ["uid", "spans"])

    def flush(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield from settle(pa.Table.from_batches(rows))

    for batch in batches:
        if not batch.num_rows:
            continue
        lead = batch.column("lead").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(lead)) + 1).tolist(), batch.num_rows]
        sizes = np.add.reduceat(batch.column("windows").to_numpy(), edges[:-1]).tolist()
        begin = 0
        for k, (low, size) in enumerate(zip(edges, sizes)):
            fresh = low > 0 or not pending or pending[-1].column("lead")[-1].as_py() != lead[0]
            if fresh and waiting >= SORTED:
                if low > begin:
                    pending.append(batch.slice(begin, low - begin))
                yield from flush(pending)
                pending, waiting, begin = [], 0, low
            waiting += size
        pending.append(batch.slice(begin))
    yield from flush(pending)


def _window_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uid, low, windows, copies, context in zip(
            *(batch.column(c).to_pylist() for c in ("uid", "low", "windows", "copies", "context"))
        ):
            digests = [hashlib.blake2b(context[j : j + WINDOW], digest_size=16).digest() for j in range(windows)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uid] * windows, pa.int64()),
                    pa.array(range(low, low + windows), pa.int32()),
                    pa.array([copies] * windows, pa.int64()),
                    pa.array(digests, pa.binary()),
                ],
                ["uid", "start", "copies", "digest"],
            )


def _hot_windows(records: DataFrame) -> DataFrame:
    """(uid, spans) of repeated windows at anchors with very many distinct stretches."""
    once = records.dropDuplicates(["uid", "anchor_no"])
    digests = once.mapInArrow(_window_digests, "uid long, start int, copies long, digest binary")
    digests = stored(digests, "window-digests")
    twice = digests.groupBy("digest").agg(F.sum("copies").alias("n")).where("n > 1").select("digest")
    hits = digests.where("copies = 1").join(twice, "digest", "left_semi")
    spans = F.array(F.struct("start", (F.col("start") + WINDOW).cast("int").alias("stop")))
    return hits.select("uid", spans.alias("spans"))


# -- the operator --------------------------------------------------------------------------


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lead", "uid", "anchor_no", "low", "windows", "anchor_at", "copies", "leads_stretches", "context"]
    for batch in batches:
        wanted = batch.column("wanted").to_pylist()
        uids = batch.column("uid").to_pylist()
        for low, high, block in text_blocks(batch, "text"):
            found = Anchors(block)
            rows: list[tuple] = []
            for i in range(high - low):
                for w in wanted[low + i] or ():
                    a = found.bounds[i] + w["anchor_no"]
                    begin = found.low[a]
                    rows.append(
                        (
                            int(found.lead[a].view(np.int64)),
                            uids[low + i],
                            w["anchor_no"],
                            int(begin - block.offsets[i]),
                            int(found.count[a]),
                            int(found.place[a] - begin),
                            w["copies"],
                            w["stretches"],
                            block.data[begin : begin + found.count[a] - 1 + WINDOW].tobytes(),
                        )
                    )
            if rows:
                columns = [pa.array(c) for c in zip(*rows)]
                columns = [
                    c.cast(k)
                    for c, k in zip(columns, [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int64(), pa.binary()])
                ]
                yield pa.RecordBatch.from_arrays(columns, names)


_CONTEXT = (
    "lead long, uid long, anchor_no int, low int, windows int, anchor_at int, copies long, leads_stretches long, "
    "context binary"
)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        repeats = batch.column("repeats").to_pylist()
        others = batch.column("spans").to_pylist()
        for low, high, block in text_blocks(batch, "text"):
            found = Anchors(block)
            out, kept = [], []
            for i in range(high - low):
                base = block.offsets[i]
                spans = [(s["start"], s["stop"]) for s in others[low + i] or ()]
                for no in repeats[low + i] or ():
                    a = found.bounds[i] + no
                    begin = int(found.low[a] - base)
                    spans.append((begin, begin + int(found.count[a]) - 1 + WINDOW))
                merged: list[list[int]] = []
                for a, b in sorted(spans):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                digest, done, raw = hashlib.sha256(), 0, block.text(i)
                for a, b in merged:
                    digest.update(raw[done:a])
                    done = b
                digest.update(raw[done:])
                out.append([{"start": a, "stop": b} for a, b in merged])
                kept.append(digest.hexdigest())
            uids = batch.column("uid").slice(low, high - low)
            yield pa.RecordBatch.from_arrays(
                [uids, pa.array(out, _SPAN_TYPE), pa.array(kept)], ["uid", "spans", "kept_sha256"]
            )


def repeats(docs: DataFrame) -> DataFrame:
    """Every row's uid, doc_id, n_bytes, ``spans`` of bytes to remove, and kept_sha256 of the rest."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = _texts(docs)
    rows = texts.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "row_key", "text")
    schema = (
        "uid long, doc_id long, row_key long, n_bytes long, sha256 string, lead array<long>, stretch array<long>"
    )
    anchored = stored(rows.mapInArrow(_anchor, schema), "anchors")

    # 1. leads that occur more than once; a Bloom filter spares most others the exchange
    twice = (
        anchored.select(F.explode("lead").alias("lead")).groupBy("lead").agg(F.count("*").alias("n")).where("n > 1")
    )
    twice = stored(twice.select("lead"), "leads")
    passes = bloom.may_contain(spark, bloom.build(twice, "lead", 1 << 16), F.col("lead"))
    each = anchored.select("uid", F.posexplode(F.arrays_zip("lead", "stretch")).alias("anchor_no", "x"))
    each = each.select("uid", "anchor_no", "x.lead", "x.stretch")
    shared = stored(each.where(passes).join(twice, "lead", "left_semi"), "shared")

    # 2. distinct stretches, and which anchors are repeats as a whole
    first = F.min(F.struct("uid", "anchor_no")).alias("first")
    distinct = shared.groupBy("lead", "stretch").agg(F.count("*").alias("copies"), first)
    distinct = stored(distinct, "stretches")
    differing = distinct.groupBy("lead").agg(F.count("*").alias("stretches")).where("stretches > 1")
    wanted = (
        distinct.join(differing, "lead")
        .groupBy("first.uid")
        .agg(F.collect_list(F.struct("first.anchor_no", "copies", "stretches")).alias("wanted"))
    )
    copied = distinct.where("copies > 1").select("lead", "stretch")
    whole = shared.join(copied, ["lead", "stretch"], "left_semi").groupBy("uid")
    whole = whole.agg(F.collect_list("anchor_no").alias("repeats"))
    anchors = anchored.select("uid", "doc_id", "row_key", F.size("lead").alias("anchors"))
    state = (
        anchors.where("anchors > 0")
        .join(wanted, "uid", "left")
        .join(whole, "uid", "left")
        .where("wanted IS NOT NULL OR repeats IS NOT NULL")
        .withColumn("all_gone", F.coalesce(F.size("repeats") == F.col("anchors"), F.lit(False)))
    )
    state = stored(state, "documents")

    # 3. texts of the documents that are needed again, and their stretches in sorted ranges
    reread = state.where("wanted IS NOT NULL OR NOT all_gone")
    near = bloom.may_contain(spark, bloom.build(reread, "row_key", 1 << 16), F.col("row_key"))
    some = texts.where(near)
    same = some["doc_id"].eqNullSafe(reread["doc_id"]) & (some["row_key"] == reread["row_key"])
    copies = Window.partitionBy("row_key", "uid").orderBy("uid")
    read = some.join(reread, same).select(
        reread["uid"], some["row_key"], some["text"], "wanted", "repeats", "all_gone"
    )
    read = read.withColumn("copy_no", F.row_number().over(copies)).where("copy_no = 1").drop("copy_no", "row_key")
    read = stored(read, "texts")
    records = read.where("wanted IS NOT NULL").select("uid", "text", "wanted").mapInArrow(_contexts, _CONTEXT)
    records = stored(records, "contexts")
    ranged = records.where(F.col("leads_stretches") <= MOST).drop("leads_stretches")
    ranged = ranged.repartitionByRange("lead").sortWithinPartitions("lead")
    spans = ranged.mapInArrow(_sort_bucket, f"uid long, spans {_SPANS}")
    spans = spans.unionByName(_hot_windows(records.where(F.col("leads_stretches") > MOST)))
    spans = spans.groupBy("uid").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    # 4. spans of each document
    partly = read.where("NOT all_gone").select("uid", "text", "repeats").join(spans, "uid", "left")
    finished = partly.mapInArrow(_finish, f"uid long, spans {_SPANS}, kept_sha256 string")
    gone = state.where("all_gone").select("uid", F.lit(True).alias("gone"))
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop")))
    out = anchored.select("uid", "doc_id", "n_bytes", "sha256").join(finished, "uid", "left").join(gone, "uid", "left")
    return out.select(
        "uid",
        "doc_id",
        "n_bytes",
        F.when(F.col("gone"), everything)
        .otherwise(F.coalesce("spans", F.array().cast(_SPANS)))
        .alias("spans"),
        F.when(F.col("gone"), F.sha2(F.lit(""), 256))
        .otherwise(F.coalesce("kept_sha256", "sha256"))
        .alias("kept_sha256"),
    )
