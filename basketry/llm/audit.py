"""What a chain of filters removes in each order, from one pass over the texts.

``FILTERS`` are conditions under which a text fails. A document that fails the set ``f`` of filters
survives a set ``s`` of them exactly if the two share none, so its fate under all 32 sets is one 32-bit
*survival word*. Positional popcounts of the words (how many have bit ``s`` set, for every ``s``) are
taken with carry-save adders per part and label, and every figure of every order follows from
these counts: what a step removes is the difference of two of them.

Copies share their text and so all flags but that of the copy itself; each (text digest, part, label)
is brought together before words are made, and a word counts as often as there are such documents (its
multiplicity enters the adders bit by bit). So a text that a third of all rows share is one row of each task.

* null text counts as empty, null part as the empty string.
* Of equal texts those with a doc_id above the least fail as copies; rows of one id are no copies of each other,
  and a row without an id is neither a copy nor labelled.
* A document is good or toxic if any of its labels says so; labels without an id say nothing.
* An empty table gives no rows. Columns are picked by name; others do no harm.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from basketry.llm.blocks import Block, small_batches, text_blocks

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)

# The conditions of A to D; E is a copy of a text with a smaller id.
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
SIGNS = "#$%&*|"

_COPY = 1 << FILTERS.index("E")
_SIGN = np.zeros(256, bool)
_SIGN[list(SIGNS.encode())] = True
_MOST_GROUPS = 4096  # (part, label) counts that a task holds before it hands them on


def text_fails(block: Block) -> np.ndarray:
    """For each text the filters A to D that it fails, as bits."""
    data = block.data
    capitals = block.per_text((data >= 65) & (data <= 90))
    points = block.per_text((data & 0xC0) != 0x80)
    signs = block.per_text(_SIGN[data]) > 0
    fails = (100 * capitals > MOST_CAPITALS_PERCENT * points) * 4 + signs * 8
    for i in range(len(block)):
        words = block.text(i).split()  # bytes split at ASCII white space alone
        fails[i] += (len(words) < LEAST_WORDS) + 2 * (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words))
    return fails


def survival_words() -> np.ndarray:
    """For each set of failed filters the 32-bit word whose bit ``s`` tells whether the set ``s`` lets it pass."""
    sets = np.arange(SUBSETS)
    passes = (sets[:, None] & sets[None, :]) == 0
    return (passes.astype(np.uint32) << np.arange(SUBSETS, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def positional_popcounts(words: np.ndarray, times: np.ndarray) -> np.ndarray:
    """For each of 32 bits how many words have it set, a word counting ``times`` times.

    Words of weight 2^b are summed three to two by full adders, bit by bit in parallel: the sum
    keeps the weight, the carry has the next one. What is left of each weight is one word.
    """
    counts = np.zeros(32, np.int64)
    carried = np.zeros(0, np.uint32)
    weight = 0
    while len(carried) or (times >> weight).any():
        level = np.concatenate([words[(times >> weight) & 1 == 1], carried])
        carries = []
        while len(level) > 1:
            third = -(-len(level) // 3)
            if pad := 3 * third - len(level):
                level = np.concatenate([level, np.zeros(pad, np.uint32)])
            a, b, c = level[:third], level[third : 2 * third], level[2 * third :]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = half ^ c
        if len(level):
            counts += ((level[0] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)).astype(np.int64) << weight
        carried = np.concatenate(carries) if carries else np.zeros(0, np.uint32)
        carried = carried[carried != 0]
        weight += 1
    return counts


def _flagged(docs: DataFrame, part: str) -> DataFrame:
    """doc_id, part, text digest and failed filters A to D of every row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, block in text_blocks(batch, "text"):
                digests = [hashlib.sha256(block.text(i)).digest() for i in range(len(block))]
                own = batch.slice(low, high - low)
                made = [pa.array(digests, pa.binary()), pa.array(text_fails(block), pa.int32())]
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), *made], ["doc_id", "part", "digest", "fails"])

    return rows.mapInArrow(work, "doc_id long, part string, digest binary, fails int")


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = survival_words()
    held: dict[tuple, np.ndarray] = {}
    for batch in batches:
        fails = batch.column("fails").to_numpy()
        times = batch.column("times").to_numpy()
        keys = batch.select(["part", "good", "toxic"]).to_pylist()
        places: dict[tuple, list[int]] = {}
        for i, k in enumerate(keys):
            places.setdefault((k["part"], k["good"], k["toxic"]), []).append(i)
        for key, at in places.items():
            found = positional_popcounts(table[fails[at]], times[at])
            held[key] = held[key] + found if key in held else found
        if len(held) > _MOST_GROUPS:
            yield _tallied(held)
            held = {}
    if held:
        yield _tallied(held)


def _tallied(held: dict[tuple, np.ndarray]) -> pa.RecordBatch:
    parts, good, toxic = zip(*held)
    columns = [pa.array(x) for x in (parts, good, toxic)] + [pa.array([c.tolist() for c in held.values()], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["part", "good", "toxic", "survivors"])


def survivors(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """For each part arrays of 32 counts: ``everything``, ``good`` and ``toxic`` documents that a set of filters lets pass."""
    small_batches(docs.sparkSession)
    marks = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    marked = _flagged(docs, part).join(marks, "doc_id", "left").select(
        "doc_id", "part", "digest", "fails",
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    group = ("digest", "part", "good", "toxic", "fails")
    groups = (
        marked.groupBy(*group, "doc_id").agg(F.count("*").alias("n"))
        .groupBy(*group)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_without"),
            F.min("doc_id").alias("least"),
            F.min_by("n", "doc_id").alias("n_least"),
        )
    )
    # a handful of rows for each text: its parts and labels
    first = F.min("least").over(Window.partitionBy("digest"))
    told = groups.withColumn(
        "n_first", F.col("n_without") + F.when(F.col("least") == first, F.col("n_least")).otherwise(0)
    )
    pairs = F.array(
        F.struct(F.col("fails"), F.col("n_first").alias("times")),
        F.struct((F.col("fails") + _COPY).alias("fails"), (F.col("n") - F.col("n_first")).alias("times")),
    )
    words = told.select("part", "good", "toxic", F.inline(pairs)).where("times > 0")
    counts = words.mapInArrow(_tally, "part string, good boolean, toxic boolean, survivors array<long>")
    by_set = counts.select("part", "good", "toxic", F.posexplode("survivors").alias("s", "n")).groupBy("part", "s").agg(
        F.sum("n").alias("everything"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("s", "everything", "good", "toxic")))
    return by_set.groupBy("part").agg(in_order.alias("c")).select(
        "part", *(F.col(f"c.{name}").alias(name) for name in ("everything", "good", "toxic"))
    )


def audit(counts: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step, from the arrays of ``survivors``."""
    orders = " ".join("".join(p) for p in itertools.permutations(FILTERS))
    rows = (
        counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), " ")))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("filter", F.expr("substr(filter_order, step, 1)"))
        .withColumn("own", F.expr(f"shiftleft(1, locate(filter, '{FILTERS}') - 1)"))
        .withColumn(
            "earlier",
            F.expr(
                f"aggregate(slice(split(filter_order, ''), 1, step - 1), 0, "
                f"(s, x) -> s | shiftleft(1, locate(x, '{FILTERS}') - 1))"
            ),
        )
        .withColumn("now", F.expr("earlier | own"))
    )
    rest = SUBSETS - 1
    # orders in which exactly the set s comes before a filter: |s|! (4 - |s|)!
    shapley = (
        f"aggregate(sequence(0, {rest}), 0L, (t, s) -> t + if((s & own) = 0, "
        "get(array(24L, 6L, 4L, 6L, 24L), bit_count(s)) * (get(everything, s) - get(everything, s | own)), 0L))"
    )
    return rows.select(
        "part",
        "filter_order",
        "step",
        "filter",
        F.expr("get(everything, now)").alias("kept"),
        F.expr("get(everything, earlier) - get(everything, now)").alias("removed"),
        F.expr(
            "get(everything, 0) - get(everything, own) - get(everything, earlier) + get(everything, now)"
        ).alias("redundant"),
        F.expr(f"get(everything, {rest} - own) - get(everything, {rest})").alias("unique_fails"),
        F.expr("get(good, earlier) - get(good, now)").alias("good_lost"),
        F.expr("get(toxic, earlier) - get(toxic, now)").alias("toxic_lost"),
        F.expr(shapley).alias("shapley"),
    )
