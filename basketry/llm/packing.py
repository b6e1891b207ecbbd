"""Token packing: shortest-pack-first over the histogram of piece lengths.

Documents become token ids of a byte-pair vocabulary, each followed by id 0, and are cut every
``width`` ids. Full pieces are sequences of their own. The rest, one piece of 1 to ``width`` - 1
ids for a document at most, is packed by its histogram of at most ``width`` - 1 rows, whatever the
size of the corpus: lengths from the longest to the shortest, ``n`` pieces of a length at a time,
go to the packs with least room that still take them, and counts of equal packs are kept instead
of packs. Pieces of a length are then numbered, and a join on ranges of these numbers gives each
piece its sequence and its offset.

Numbering needs no sort of a whole length: pieces are counted by (length, salt), the counts added
up, and only pieces of one length and salt are ordered in a task.

A null or empty text is the single id 0. Rows with equal or null ids are packed one by one.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketry.llm.blocks import SMALL_BYTES, Block, mix, sequence_hashes, small_batches, text_blocks, tidy
from basketry.llm.tables import stored

WIDTH = 1024
END_ID = 0
ROWS_A_SALT = 1 << 16
MOST_REMEMBERED = 1_000_000

_OTHER, _LETTER, _NUMBER, _SPACE, _UNSEEN = range(5)


class Encoder:
    """Ids of whole texts, computed word by word.

    The vocabulary's pre-tokenizer cuts texts into words of letters, of digits, of other signs and
    of white space, with single blanks leading the next word; no merge crosses a cut. So texts are
    cut in numpy and each distinct word is encoded once by the tokenizer. The kind of a character
    is asked of the tokenizer itself when it is first seen. Texts are first cut at the added tokens
    of the vocabulary, such as ``<|endoftext|>``, which are one id wherever they stand.
    """

    ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.single_word or t.lstrip or t.rstrip for t in added):
            raise ValueError("added tokens that depend on the text around them are not supported")
        longest = sorted((t.content for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, longest))) if longest else None
        self.kinds = np.full(0x110000, _UNSEEN, np.uint8)
        self.forget()

    def forget(self) -> None:
        """Start with an empty memory of words, which is bounded by MOST_REMEMBERED."""
        self.known = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _kind(self, char: str) -> int:
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for kind, sample in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")):
            if len(cut(sample + char)) == 1:
                return kind
        return _SPACE

    def _added(self, raw: str, cuts: np.ndarray) -> np.ndarray:
        """(start, stop) of the added tokens; ``cuts`` has the borders of the texts, which none crosses."""
        found = []
        if self.added and self.added.search(raw):
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                found += [m.span() for m in self.added.finditer(raw, a, b)]
        return np.array(found, np.int64).reshape(-1, 2)

    def _words(self, points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Where the words of the texts begin; ``cuts`` has the borders of the texts."""
        kinds = self.kinds[points]
        unseen = kinds == _UNSEEN
        if unseen.any():
            for p in np.unique(points[unseen]):
                self.kinds[p] = self._kind(chr(p))
            kinds = self.kinds[points]
        n = len(points)
        border = np.zeros(n + 1, bool)
        border[cuts] = True
        begins = np.ones(n, bool)
        begins[1:] = kinds[1:] != kinds[:-1]
        begins |= border[:-1]
        space = kinds == _SPACE
        # the last blank before a word belongs to it; other white space stands alone
        last = np.flatnonzero(space[:-1] & ~space[1:] & ~border[1:-1])
        begins[last] = True
        joined = last[points[last] == 32]
        begins[joined + 1] = False
        # endings such as 's are words of their own where no sign or blank comes before
        quotes = np.flatnonzero(points == 39)
        if len(quotes):
            self._endings(points, begins, border, quotes)
        return np.flatnonzero(begins)

    def _endings(self, points, begins, border, quotes) -> None:
        n = len(points)
        for q in quotes[begins[quotes]]:
            for ending in self.ENDINGS:
                stop = q + 1 + len(ending)
                if stop <= n and not border[q + 1 : stop].any():
                    if all(points[q + 1 + k] == ord(c) for k, c in enumerate(ending)):
                        begins[q + 1 : stop] = False
                        if stop < n:
                            begins[stop] = True
                        break

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, and where each text's ids begin (one more than there are texts)."""
        raw = block.data.tobytes().decode("utf-8", "replace")
        cuts = block.prefix_sums((block.data & 0xC0) != 0x80)[block.offsets]
        if len(raw) != cuts[-1]:  # broken UTF-8
            texts = [block.text(i).decode("utf-8", "replace") for i in range(len(block))]
            raw, cuts = "".join(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        if not raw:
            return np.zeros(0, np.uint32), np.zeros(len(block) + 1, np.int64)
        points = np.frombuffer(raw.encode("utf-32-le"), np.uint32)
        added = self._added(raw, cuts)
        starts = self._words(points, np.union1d(cuts, added))
        if len(added):  # each is one word
            inside = np.searchsorted(added[:, 0], starts, "right") - 1
            starts = starts[(inside < 0) | (starts == added[inside, 0]) | (starts >= added[inside, 1])]
        ends = np.append(starts[1:], len(points))
        hashes = sequence_hashes(mix(points.astype(np.uint64) + np.uint64(1)), starts, ends)
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        row = self._rows(distinct, lambda k: raw[starts[sample[k]] : ends[sample[k]]])[which]
        counts = self.count[row]
        total = np.concatenate([[0], np.cumsum(counts)])
        index = np.arange(total[-1]) - np.repeat(total[:-1] - self.first[row], counts)
        return self.ids[index], total[np.searchsorted(starts, cuts)]

    def _rows(self, distinct: np.ndarray, word: Callable[[int], str]) -> np.ndarray:
        """Where the words with these sorted hashes are remembered; new ones are encoded."""
        if len(self.known) > MOST_REMEMBERED:
            self.forget()
        at = np.searchsorted(self.known, distinct)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != distinct
        else:
            new = np.ones(len(distinct), bool)
        fresh = np.flatnonzero(new)
        if len(fresh):
            encoded = [
                e.ids
                for e in self.tokenizer.encode_batch_fast([word(k) for k in fresh], add_special_tokens=False)
            ]
            count = np.array([len(e) for e in encoded], np.int64)
            first = len(self.ids) + np.concatenate([[0], np.cumsum(count)[:-1]])
            self.ids = np.concatenate([self.ids, np.array([x for e in encoded for x in e], np.uint32)])
            self.known = np.insert(self.known, at[fresh], distinct[fresh])
            self.first = np.insert(self.first, at[fresh], first)
            self.count = np.insert(self.count, at[fresh], count)
            at = np.searchsorted(self.known, distinct)
        return at


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker.

    Its words are encoded in the task's own thread: a pool of threads for all cores takes more than the
    task's core, and each thread keeps memory of its own.
    """
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[path] = Encoder(path)
    return _encoders[path]


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


PAYLOADS: dict[str, tuple[str, Callable]] = {
    "ids": ("array<int>", lambda ids: ids.astype(np.int32).tolist()),
    "ids_crc32": ("long", checksum),
}


def tokenize(docs: DataFrame, path: str, width: int = WIDTH, payload: str = "ids") -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens and the payload.

    ``payload`` is ``ids`` for the token ids or ``ids_crc32`` for their checksum.
    """
    small_batches(docs.sparkSession)
    kind, value = PAYLOADS[payload]
    schema = f"doc_id long, start long, length long, doc_tokens long, {payload} {kind}"

    @tidy
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        for batch in batches:
            names = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            for low, _, block in text_blocks(batch, "text", SMALL_BYTES):
                ids, cuts = tokens.encode(block)
                out: list[list] = [[], [], [], [], []]
                for i in range(len(block)):
                    own = np.append(ids[cuts[i] : cuts[i + 1]], np.uint32(END_ID)).astype(np.uint32)
                    for start in range(0, len(own), width):
                        piece = own[start : start + width]
                        row = (names[low + i], start, len(piece), len(own), value(piece))
                        for column, x in zip(out, row):
                            column.append(x)
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int32()) if payload == "ids" else pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds)],
                    ["doc_id", "start", "length", "doc_tokens", payload],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, schema)


def shortest_pack_first(histogram: dict[int, int], width: int = WIDTH) -> list[tuple[int, tuple[int, ...]]]:
    """(how many packs, lengths in them) for all pieces of a histogram.

    Longest lengths first; the pieces of a length fill the packs with the least room that is
    enough for one, several to a pack where they fit, and open new packs at last.
    """
    by_room: dict[int, dict[tuple[int, ...], int]] = {}

    def put(pattern: tuple[int, ...], room: int, n: int) -> None:
        own = by_room.setdefault(room, {})
        own[pattern] = own.get(pattern, 0) + n

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for room in [r for r in sorted(by_room) if r >= length]:
            each = room // length
            for pattern in list(by_room[room]):
                if not left:
                    break
                packs = by_room[room].pop(pattern)
                full = min(packs, left // each)
                if full:
                    put(pattern + (length,) * each, room - each * length, full)
                    left -= full * each
                if full < packs and 0 < left < each:
                    put(pattern + (length,) * left, room - left * length, 1)
                    left, packs = 0, packs - 1
                if full < packs:
                    put(pattern, room, packs - full)
        if left:
            each = width // length
            if left >= each:
                put((length,) * each, width - each * length, left // each)
            if left % each:
                put((length,) * (left % each), width - left % each * length, 1)
    return [(n, pattern) for own in by_room.values() for pattern, n in own.items() if n]


def _slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges of piece numbers: (length, from, to, first sequence, offset, pieces a sequence).

    Piece number r of a range goes to sequence first + (r - from) // each, at offset
    + (r - from) % each * length.
    """
    used: dict[int, int] = {}
    slots, first = [], 0
    for n, pattern in patterns:
        offset = 0
        for length in dict.fromkeys(pattern):
            each = pattern.count(length)
            begin = used.get(length, 0)
            used[length] = begin + n * each
            slots.append((length, begin, begin + n * each, first, offset, each))
            offset += length * each
        first += n
    return slots


def _table(spark: SparkSession, names: list[str], rows: list[tuple[int, ...]]) -> DataFrame:
    """Rows of longs, by Arrow: a list of tuples would start Python workers of another kind, which stay."""
    columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))]
    return spark.createDataFrame(pa.table(columns, names))


def _numbered(
    pieces: DataFrame, by: str, order: list[str], sizes: dict[int, int], rows_a_salt: int = ROWS_A_SALT
) -> DataFrame:
    """Adds ``rank``: 0, 1, … among the rows with the same ``by``, without sorting them in one task.

    ``sizes`` says how many rows a value has: it is sorted in parts of some ``rows_a_salt`` rows, so
    that a task's rows do not grow with the corpus, and what adds up over parts is one count for each.
    """
    parts = _table(pieces.sparkSession, [by, "parts"], [(k, 1 + n // rows_a_salt) for k, n in sizes.items()])
    salted = pieces.join(F.broadcast(parts), by).withColumn("salt", F.pmod(F.xxhash64(*order), "parts")).drop("parts")
    counts = salted.groupBy(by, "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy(by).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(by, "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(by, "salt").orderBy(*order)
    ranked = salted.withColumn("rank", F.row_number().over(inside) - 1)
    return ranked.join(base, [by, "salt"]).withColumn("rank", F.col("rank") + F.col("base")).drop("salt", "base")


def pack(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """``pieces`` (with a column ``length``) and their ``sequence_id`` and ``offset``.

    The histogram has at most ``width`` rows and the slots at most a few for each of its lengths,
    so both pass through the driver at any size of the corpus.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    sizes = dict(histogram)
    full = histogram.pop(width, 0)
    slots = _slots(shortest_pack_first(histogram, width))
    order = [c for c in pieces.columns if c != "length" and "array" not in dict(pieces.dtypes)[c]]
    ranked = _numbered(pieces, "length", order, sizes)
    packs = 1 + max((s[3] + (s[2] - s[1]) // s[5] - 1 for s in slots), default=-1)
    slots.append((width, 0, full, packs, 0, 1))
    table = _table(spark, ["length", "low", "high", "first", "slot_offset", "each"], slots)
    # many ranges of one length: find the right one by its number among the sorted lower ends
    grouped = table.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("low", "high", "first", "slot_offset", "each"))).alias("ranges")
    )
    chosen = F.filter("ranges", lambda x: (x["low"] <= F.col("rank")) & (F.col("rank") < x["high"]))[0]
    placed = ranked.join(F.broadcast(grouped), "length").withColumn("slot", chosen)
    step = F.col("rank") - F.col("slot.low")
    return placed.select(
        *pieces.columns,
        (F.col("slot.first") + F.floor(step / F.col("slot.each"))).cast("long").alias("sequence_id"),
        (F.col("slot.slot_offset") + step % F.col("slot.each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str, width: int = WIDTH, payload: str = "ids") -> DataFrame:
    return pack(stored(tokenize(docs, path, width, payload), "pieces"), width)
