"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, ASCII capitals folded, so case and punctuation do not hide
a leak. Rolling (Karp-Rabin) hashes of ``SEED`` words in a row are the seeds. A fixed-size Bloom
filter of the benchmark's seeds lets few seeds of the documents pass. A document into which an item
leaks holds a certain number of the item's seeds, hence one of all but as many less one: the rarest
are joined with the documents, and only the pairs of document and item that share one of them are
looked at whole. Phrases that very many documents and items share bring nobody together by themselves.
For each pair the places of common seeds are joined to runs, which are tiled: the longest is marked,
then the longest of what is left unmarked in both, down to ``SEED`` words. Runs may come in any order,
so reordered passages are found too. An item leaks into a document if tiles cover at least
``threshold`` of its words. Places are carried once a seed, never as pairs: a text of one repeated word
has as many as it has words.

An item of fewer than ``SEED`` words is one seed as a whole. Null or empty texts and items have no
seeds and never match. Equal rows (same id and text) count as one document, items with equal id
and text as one item.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from basketry.llm import bloom
from basketry.llm.blocks import SIGNS, SMALL_BYTES, Block, Words, small_batches, text_blocks, tidy
from basketry.llm.tables import keyed, row_key, same_row, stored

SEED = 5
THRESHOLD = 0.6
PAIRS_AT_ONCE = 1 << 20


def runs(shared: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Longest runs of common seeds: rows (place in document, place in item, seeds).

    ``shared`` has the places of each common seed in the document and in the item. A pair of places starts
    a run where the places before it hold no common seed, and ends one where the places after it do not.
    """
    # the seed at each place, with a free place at either end; free places of the two never agree
    doc = np.full(max(int(d.max()) for d, _ in shared) + 3, -1)
    item = np.full(max(int(i.max()) for _, i in shared) + 3, -2)
    for number, (d, i) in enumerate(shared):
        doc[d + 1] = item[i + 1] = number
    edges: tuple[list, list] = ([], [])
    for d, i in shared:
        step = max(1, PAIRS_AT_ONCE // len(i))
        for at in range(0, len(d), step):
            part = d[at : at + step]
            for found, shift in zip(edges, (0, 2)):
                x, y = np.nonzero(doc[part + shift][:, None] != item[i + shift])
                found.append(np.stack([part[x], i[y]], axis=1))
    starts, ends = (np.concatenate(found) for found in edges)
    starts, ends = (e[np.lexsort((e[:, 0], e[:, 0] - e[:, 1]))] for e in (starts, ends))
    return np.column_stack([starts, ends[:, 0] - starts[:, 0] + 1])


def _stretches(free: np.ndarray, seed: int) -> list[tuple[int, int]]:
    """(first, length) of the stretches of at least ``seed`` free places."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]])))
    return [(a, b - a) for a, b in edges.reshape(-1, 2).tolist() if b - a >= seed]


def tiles(found: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiling by ``runs`` of matching seeds: (place in document, place in item, words).

    Longest run first, at a tie the one that comes first in the item, then in the document.
    """
    doc = np.ones(int((found[:, 0] + found[:, 2]).max()) + seed, bool)
    item = np.zeros(int((found[:, 1] + found[:, 2]).max()) + seed, bool)
    for j, n in found[:, 1:].tolist():
        item[j : j + n + seed - 1] = True
    waiting = [(-(n + seed - 1), j, i) for i, j, n in found.tolist()]
    heapq.heapify(waiting)
    marked = []
    while waiting:
        words, j, i = heapq.heappop(waiting)
        free = doc[i : i - words] & item[j : j - words]
        if not free.all():
            for at, n in _stretches(free, seed):
                heapq.heappush(waiting, (-n, j + at, i + at))
            continue
        marked.append((i, j, -words))
        doc[i : i - words] = item[j : j - words] = False
        if not _stretches(item, seed):
            break  # no tile fits any more
    return marked


def _seeds(block: Block, lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each seed length: (length, text, place of the first word, hash)."""
    words = Words(block, gaps=SIGNS)
    for length in lengths:
        at, hashes = words.windows(length)
        text = np.searchsorted(words.bounds, at, "right") - 1
        yield length, text, at - words.bounds[text], hashes.view(np.int64)


@tidy
def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, block in text_blocks(batch, "text", SMALL_BYTES):
            own = batch.slice(low, high - low)
            counts = Words(block, gaps=SIGNS).counts
            for length, text, place, hashes in _seeds(block, list(range(1, SEED + 1))):
                right = np.minimum(counts[text], SEED) == length
                rows = pa.array(text[right])
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0).take(rows),
                        own.column(1).take(rows),
                        pa.array(counts[text[right]], pa.int32()),
                        pa.array(np.full(right.sum(), length), pa.int32()),
                        pa.array(place[right], pa.int32()),
                        pa.array(hashes[right]),
                    ],
                    ["item", "item_id", "item_words", "seed_words", "item_place", "seed"],
                )


def _item_table(benchmark: DataFrame) -> DataFrame:
    """Every seed of every item: item (a number of its own), item_id, item_words, seed_words, item_place, seed."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).distinct()
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    schema = "item long, item_id long, item_words int, seed_words int, item_place int, seed long"
    return stored(numbered.mapInArrow(_item_seeds, schema), "item-seeds")


def _document_seeds(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """(doc_id, row_key, seed, places): the seeds of documents that are seeds of items."""
    spark = docs.sparkSession
    lengths = sorted(r[0] for r in seeds.select("seed_words").distinct().collect())  # 1 to SEED
    words = spark.sparkContext.broadcast(bloom.build(seeds, "seed"))

    @tidy
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, block in text_blocks(batch, "text", SMALL_BYTES):
                own = batch.slice(low, high - low)
                for _, text, place, hashes in _seeds(block, lengths):
                    hit = np.flatnonzero(bloom.probe(words.value, hashes))
                    if len(hit):
                        rows = pa.array(text[hit])
                        yield pa.RecordBatch.from_arrays(
                            [
                                own.column(0).take(rows),
                                own.column(1).take(rows),
                                pa.array(place[hit], pa.int32()),
                                pa.array(hashes[hit]),
                            ],
                            ["doc_id", "row_key", "place", "seed"],
                        )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key("text").alias("row_key"),
        F.col("text").cast("string").alias("text"),
    )
    hits = rows.mapInArrow(work, "doc_id long, row_key long, place int, seed long")
    exact = hits.join(seeds.select("seed").distinct(), "seed", "left_semi")
    return stored(exact.groupBy("doc_id", "row_key", "seed").agg(F.collect_set("place").alias("places")), "seeds")


def _rarest(items: DataFrame, held: DataFrame, threshold: float) -> DataFrame:
    """(item, seed): the seeds of which a document holds at least one if the item leaks into it.

    Tiles that cover enough words hold ``need`` of the item's places at least, so that no such
    document misses all of any ``all - need + 1`` places.
    """
    documents = held.groupBy("seed").agg(F.count("*").alias("documents"))
    counted = items.join(documents, "seed", "left").withColumn("n", F.size("item_places"))
    need = F.greatest(F.lit(1), F.ceil(F.col("item_words") * threshold / F.col("seed_words") - 1e-9))
    rare = Window.partitionBy("item").orderBy(F.coalesce("documents", F.lit(0)), "seed")
    before = F.sum("n").over(rare.rowsBetween(Window.unboundedPreceding, -1))
    spare = F.sum("n").over(Window.partitionBy("item")) - need
    ranked = counted.withColumn("chosen", F.coalesce(before, F.lit(0)) <= spare)
    return ranked.where("chosen AND documents IS NOT NULL").select("item", "seed")


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Places of common seeds: one row for each (document, item) that may leak, with an array of ``shared``."""
    small_batches(docs.sparkSession)
    seeds = _item_table(benchmark)
    held = _document_seeds(docs, seeds)
    own = ["item", "item_id", "item_words", "seed_words"]
    items = seeds.groupBy(*own, "seed").agg(F.collect_set("item_place").alias("item_places"))
    chosen = held.join(_rarest(items, held, threshold), "seed").select("doc_id", "row_key", "item").distinct()
    # written, so that the join may split the documents of a very common item
    chosen = stored(chosen, "leak-candidates")
    wanted = chosen.join(items, "item")
    both = wanted.join(held, same_row(wanted, held) & (wanted["seed"] == held["seed"]))
    common = both.select(*(wanted[c] for c in ("doc_id", "row_key", *own, "item_places")), held["places"])
    return common.groupBy("doc_id", "row_key", *own).agg(
        F.sum(F.size("item_places")).alias("n"), F.collect_list(F.struct("places", "item_places")).alias("shared")
    )


@tidy
def _tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for seed, shared in zip(batch.column("seed_words").to_pylist(), batch.column("shared")):
            places = [shared.values.field(c) for c in ("places", "item_places")]
            pairs = [
                tuple(np.sort(p[k].values.to_numpy(zero_copy_only=False)) for p in places)
                for k in range(len(shared.values))
            ]
            sizes.append([t[2] for t in tiles(runs(pairs), seed)])
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("doc_id", "row_key", "item_id", "item_words")),
                pa.array([sum(s) for s in sizes], pa.int32()),
                pa.array([len(s) for s in sizes], pa.int32()),
            ],
            ["doc_id", "row_key", "item_id", "item_words", "covered", "n_tiles"],
        )


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, row_key, item_id, item_words, covered, n_tiles, coverage) of items in documents."""
    found = matches(docs, benchmark, threshold)
    # each place covers that many words at most: pairs that cannot reach the threshold go first
    hopeful = found.where(F.col("n") * F.col("seed_words") >= F.col("item_words") * threshold)
    schema = "doc_id long, row_key long, item_id long, item_words int, covered int, n_tiles int"
    tiled = hopeful.select("doc_id", "row_key", "item_id", "item_words", "seed_words", "shared").mapInArrow(_tile, schema)
    return tiled.withColumn("coverage", F.col("covered") / F.col("item_words")).where(
        F.col("covered") >= F.col("item_words") * threshold
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents into which no item leaks, with all their columns."""
    bad = leaks(docs, benchmark, threshold).select("doc_id", "row_key")
    rows = keyed(docs, "text")
    return rows.join(bad, same_row(rows, bad), "left_anti").select("row.*")
