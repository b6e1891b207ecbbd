"""N-gram Jaccard join with signature trees: which documents link, and their components.

A document is its set of word shingles. Two documents link if ``100 * both >= percent * either``,
with the sizes of the intersection and the union. Nothing is sampled or capped, and links that
could join two components are decided on the whole sets.

1. Documents with equal sets are one class; the rest works on one member of each class.
2. Linked sets share one of their ``n - ceil(percent / 100 * n) + 1`` first shingles in any common
   order. The order is rarest first, by a sketch of shingle counts of fixed size, so shingles that
   are very common hardly ever bring sets together. Shingles with the same members count once.
3. The members of a shingle form a signature tree. A node holds the OR of its members' bitmaps
   and the range of their sizes. A traversal of the tree against itself drops pairs of nodes
   whose largest possible overlap is too small, whose sizes are too far apart, or whose members
   are all in one component already. The pairs of leaves that are left give a spanning forest.
4. The forest's pairs are checked on whole sets, the true ones join components, and the traversal
   starts again with the new components, without the pairs that failed, until no pair is left.
   So large groups of near copies cost about one check for each member, not one for each pair.
   A unit that gives no pair is done and takes no part in later rounds.
   Where pairs fail, later rounds choose several forests at once, ever more of them.
5. Shingles of more than ``TILE`` members are cut into tiles. After the first round the members
   outside the largest component of such a shingle visit all its tiles, so no pair is missed.

Documents without words (null, empty or blank texts) have empty sets and link with nothing. Texts
of fewer words than a shingle are one shingle as a whole. Rows are told apart by their place in
the table: equal rows are linked rows, also those with equal or null ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, functions as F

from basketry.llm import bloom
from basketry.llm.blocks import SMALL_BYTES, mix, shingle_sets, small_batches, text_blocks, tidy
from basketry.llm.components import merged
from basketry.llm.tables import keyed, row_key, same_row, stored

SHINGLE_WORDS, PERCENT = 4, 85
COUNTERS = 1 << 20  # of the sketch: 4 MB broadcast
SLICE = 1 << 14
BITS = 4096
FANOUT = 8
FORESTS = 8  # times as many in each round
TILE = 2048


# -- rarest-first order --------------------------------------------------------------------


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(COUNTERS - 1)).astype(np.int64)


def shingle_counts(docs: DataFrame, words: int) -> np.ndarray:
    """How many documents hold a shingle of each bucket; the same size for any corpus."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, _, block in text_blocks(batch, "text", SMALL_BYTES):
                sets = list(shingle_sets(block, words))
                np.add.at(total, _bucket(np.concatenate(sets)), 1)
        yield from slices(dict(enumerate(total.reshape(-1, SLICE))))

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for no, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(raw, np.uint32)
                total[no] = total[no] + part if no in total else part.astype(np.int64)
        yield from slices(total)

    def slices(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for no, part in total.items():
            if part.any():
                raw = np.minimum(part, 2**32 - 1).astype(np.uint32).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([no], pa.int32()), pa.array([raw])], ["slice", "counts"])

    schema = "slice int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema).repartition("slice").mapInArrow(add, schema)
    counts = np.zeros(COUNTERS, np.uint32)
    for row in parts.collect():  # COUNTERS / SLICE rows
        counts[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row["counts"], np.uint32)
    return counts


# -- sets, classes and postings ------------------------------------------------------------


def least_shared(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` that any partner must have."""
    return -(-percent * n // 100)


def bitmap(shingles: np.ndarray) -> bytes:
    bits = np.zeros(BITS, np.uint8)
    bits[(shingles >> np.uint64(24) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("row_key"), text.alias("text")
    )


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One stored row per document: uid, ids, set size, set digest, bitmap and first shingles."""
    texts = _texts(docs)
    order = docs.sparkSession.sparkContext.broadcast(shingle_counts(texts, words))

    @tidy
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, block in text_blocks(batch, "text", SMALL_BYTES):
                sizes, first, second, bits, heads = [], [], [], [], []
                for s in shingle_sets(block, words):
                    n = len(s)
                    sizes.append(n)
                    first.append(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                    second.append(mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64))
                    bits.append(bitmap(s) if n else b"")
                    k = n - least_shared(n, percent) + 1 if n else 0
                    rare = np.lexsort((s, order.value[_bucket(s)]))[:k]
                    heads.append(s[rare].view(np.int64))
                cuts = np.concatenate([[0], np.cumsum([len(h) for h in heads])])
                own = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        *own.columns[:3],
                        pa.array(sizes, pa.int32()),
                        pa.array(np.array(first, np.uint64).view(np.int64)),
                        pa.array(np.array(second, np.uint64).view(np.int64)),
                        pa.array(bits, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(heads))),
                    ],
                    ["uid", "doc_id", "row_key", "n", "d1", "d2", "bits", "head"],
                )

    rows = texts.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "row_key", "text")
    schema = "uid long, doc_id long, row_key long, n int, d1 long, d2 long, bits binary, head array<long>"
    return stored(rows.mapInArrow(sign, schema), "signatures")


def memberships(signed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(shingle, tile, members, uid, n): who shares one of its first shingles with another."""
    reps = classes.select(F.col("rep").alias("uid"))
    postings = (
        signed.where("n > 0")
        .select("uid", "n", "head")
        .join(reps, "uid", "left_semi")
        .select(F.explode("head").alias("shingle"), "uid", "n")
    )
    same = ("members", "x1", "x2")
    # counting sizes, so that both uses of the postings have the same columns and share a shuffle
    shared = (
        postings.groupBy("shingle")
        .agg(
            F.count("n").alias("members"),
            F.bit_xor(F.xxhash64("uid")).alias("x1"),
            F.bit_xor(F.xxhash64("uid", F.lit(1))).alias("x2"),
        )
        .where("members > 1")
        .groupBy(*same)
        .agg(F.min("shingle").alias("shingle"))
        .select("shingle", "members")
    )
    joined = postings.join(shared, "shingle")
    small = joined.where(F.col("members") <= TILE)
    # of the few members of a small shingle, those with nobody near their size go
    by_size = Window.partitionBy("shingle").orderBy("n", "uid")
    below, above = F.lag("n").over(by_size), F.lead("n").over(by_size)
    near = (100 * below >= percent * F.col("n")) | (100 * F.col("n") >= percent * above)
    small = small.withColumn("near", near).where("near").drop("near").withColumn("tile", F.lit(0).cast("long"))
    large = joined.where(F.col("members") > TILE).withColumn(
        "tile", F.pmod(F.xxhash64("uid"), F.ceil(F.col("members") / TILE))
    )
    return stored(small.unionByName(large), "members")


def with_bitmaps(units: DataFrame, signed: DataFrame) -> DataFrame:
    """Units with their members' bitmaps, which are by far their largest part and so come last.

    A filter of the members' ids keeps most bitmaps of others from being shuffled.
    """
    key = F.xxhash64("uid")
    words = bloom.build(units.select("uid").distinct().select(key.alias("key")), "key")
    bits = signed.where(bloom.may_contain(signed.sparkSession, words, key)).select("uid", "bits")
    return units.join(bits, "uid")


# -- signature trees -----------------------------------------------------------------------


class _Level:
    """The nodes of one level of a tree: OR of bitmaps, range of sizes, slack, common component."""

    def __init__(self, bits: np.ndarray, low: np.ndarray, high: np.ndarray, slack: np.ndarray, component: np.ndarray):
        self.bits, self.low, self.high, self.slack, self.component = bits, low, high, slack, component

    def above(self) -> _Level:
        first = np.arange(0, len(self.low), FANOUT)
        lowest = np.minimum.reduceat(self.component, first)
        highest = np.maximum.reduceat(self.component, first)
        return _Level(
            np.bitwise_or.reduceat(self.bits, first, axis=0),
            np.minimum.reduceat(self.low, first),
            np.maximum.reduceat(self.high, first),
            np.maximum.reduceat(self.slack, first),
            np.where(lowest == highest, lowest, -1),
        )

    def possible(self, a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs of nodes may hold a link between components; their largest possible overlap."""
        common = np.bitwise_count(self.bits[a] & self.bits[b]).sum(axis=1, dtype=np.int64)
        most = np.minimum(common + np.minimum(self.slack[a], self.slack[b]), np.minimum(self.high[a], self.high[b]))
        near = (100 * self.high[a] >= percent * self.low[b]) & (100 * self.high[b] >= percent * self.low[a])
        enough = (100 + percent) * most >= percent * (self.low[a] + self.low[b])
        apart = (self.component[a] != self.component[b]) | (self.component[a] < 0)
        return near & enough & apart, most


def linked_leaves(bits: np.ndarray, n: np.ndarray, component: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Pairs of members that bitmaps and sizes let link: (index, index, largest possible overlap)."""
    order = np.lexsort((bits[:, 0], n))
    bits, n, component = bits[order], n[order].astype(np.int64), component[order]
    slack = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    levels = [_Level(bits, n, n, slack, component)]
    while len(levels[-1].low) > 1:
        levels.append(levels[-1].above())
    a = b = np.zeros(1, np.int64)
    most = np.zeros(1, np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        if not len(a):
            break
        level = levels[depth]
        kept_a, kept_b, kept_most = [], [], []
        for at in range(0, len(a), 256):  # 256 pairs of nodes have 16,384 pairs of children
            x, y = a[at : at + 256], b[at : at + 256]
            if depth < len(levels) - 1:
                steps = np.arange(FANOUT)
                x, y = np.broadcast_arrays(
                    x[:, None, None] * FANOUT + steps[:, None], y[:, None, None] * FANOUT + steps
                )
                x, y = x.ravel(), y.ravel()
                real = (x < len(level.low)) & (y < len(level.low)) & ((x < y) if depth == 0 else (x <= y))
                x, y = x[real], y[real]
            good, upper = level.possible(x, y, percent)
            if depth == len(levels) - 1 and depth:
                good[:] = True
            elif depth == 0:
                good &= x < y
            kept_a.append(x[good])
            kept_b.append(y[good])
            kept_most.append(upper[good])
        a, b, most = np.concatenate(kept_a), np.concatenate(kept_b), np.concatenate(kept_most)
    return order[a], order[b], most


def forests(
    unit: dict[str, np.ndarray], failed: dict[int, set], percent: int, most: int
) -> list[tuple[int, int]]:
    """Pairs of uids that, if they link, join the components of a unit; no pair that failed before.

    They are ``most`` spanning forests without common pairs, likely links first: the second holds
    what would join the components should pairs of the first fail, and so on.
    """
    uid, component = unit["uid"], unit["component"]
    a, b, upper = linked_leaves(unit["bits"], unit["n"], component, percent)
    # visitors have met each other at home
    home = unit["home"]
    use = (home[a] | home[b]) & (component[a] != component[b])
    a, b, upper = a[use], b[use], upper[use]
    share = upper / (unit["n"][a] + unit["n"][b])
    order = np.lexsort((np.maximum(uid[a], uid[b]), np.minimum(uid[a], uid[b]), -share))
    numbers = np.unique(component, return_inverse=True)[1]
    parents: list[list[int]] = []
    joins_left: list[int] = []

    def root(parent: list[int], c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    chosen = []
    ends = zip(uid[a[order]].tolist(), uid[b[order]].tolist(), numbers[a[order]].tolist(), numbers[b[order]].tolist())
    for x, y, p, q in ends:
        if y in failed.get(x, ()):
            continue
        for level in range(most):
            if level == len(parents):
                parents.append(list(range(numbers.max() + 1)))
                joins_left.append(int(numbers.max()))
            if joins_left[level]:
                i, j = root(parents[level], p), root(parents[level], q)
                if i != j:
                    parents[level][max(i, j)] = min(i, j)
                    joins_left[level] -= 1
                    chosen.append((min(x, y), max(x, y)))
                    break
        if len(joins_left) == most and not any(joins_left):
            break
    return chosen


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], dict[int, set]]]:
    """The units (shingle, tile) of rows that come sorted by unit."""
    pending: dict[str, np.ndarray] | None = None
    failed: dict[int, set] = {}
    names = ("shingle", "tile", "uid", "n", "component", "home")
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        raw = b"".join(batch.column("bits").to_pylist())
        rows["bits"] = np.frombuffer(raw, np.uint64).reshape(batch.num_rows, -1)
        failures = batch.column("failed")
        if failures.null_count < batch.num_rows:
            for u, others in zip(rows["uid"].tolist(), failures.to_pylist()):
                if others:
                    failed[u] = set(others)
        new = (np.diff(rows["shingle"]) != 0) | (np.diff(rows["tile"]) != 0)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            own = {c: v[low:high] for c, v in rows.items()}
            if pending is not None and all(pending[c][0] == own[c][0] for c in ("shingle", "tile")):
                pending = {c: np.concatenate([pending[c], own[c]]) for c in own}
                continue
            if pending is not None:
                yield pending, failed
            pending = own
    if pending is not None:
        yield pending, failed


def candidates(units: DataFrame, percent: int, most: int) -> DataFrame:
    """(a, b, shingle, tile): the pairs to check next, and the units that want them checked."""

    @tidy
    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, failed in _units(batches):
            pairs = forests(unit, failed, percent, most)
            if pairs:
                a, b = (pa.array(x, pa.int64()) for x in zip(*pairs))
                names = ["a", "b", "shingle", "tile"]
                own = [pa.array(unit[c][:1].repeat(len(pairs))) for c in names[2:]]
                yield pa.RecordBatch.from_arrays([a, b, *own], names)

    together = units.repartition("shingle", "tile").sortWithinPartitions("shingle", "tile")
    return together.mapInArrow(traverse, "a long, b long, shingle long, tile long")


# -- rounds --------------------------------------------------------------------------------


def verified(docs: DataFrame, signed: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """``pairs`` with ``linked``, decided on the whole sets of both documents."""
    spark = docs.sparkSession
    wanted = pairs.select(F.col("a").alias("uid")).union(pairs.select(F.col("b").alias("uid"))).distinct()
    keys = stored(signed.select("uid", "doc_id", "row_key").join(wanted, "uid", "left_semi"), "wanted")
    passes = bloom.may_contain(spark, bloom.build(keys, "row_key"), F.col("row_key"))

    @tidy
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, block in text_blocks(batch, "text", SMALL_BYTES):
                raw = [s.tobytes() for s in shingle_sets(block, words)]
                own = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*own.columns[:2], pa.array(raw, pa.binary())], ["doc_id", "row_key", "shingles"])

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    sets = _texts(docs).where(passes).mapInArrow(shingle, "doc_id long, row_key long, shingles binary")
    own = sets.join(keys, same_row(sets, keys)).select(keys["uid"], sets["shingles"])
    own = own.repartition("uid").persist(StorageLevel.MEMORY_AND_DISK)
    half = pairs.join(own.select(F.col("uid").alias("a"), F.col("shingles").alias("left")), "a")
    full = half.join(own.select(F.col("uid").alias("b"), F.col("shingles").alias("right")), "b")
    checked = full.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long, linked boolean")
    out = stored(checked.distinct(), "checked")
    own.unpersist()
    return out


def _busy(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the units that may still give pairs.

    A unit without tiles that gives no pair is done: components only grow, failed pairs only become more.
    """
    units = found.select("shingle", "tile").distinct()
    small = members.where(F.col("members") <= TILE).join(units, ["shingle", "tile"], "left_semi")
    return small.select(*members.columns).unionByName(members.where(F.col("members") > TILE))


def _active(members: DataFrame, node_component: DataFrame | None, failed: DataFrame, tiled: bool) -> DataFrame:
    """Members of units that span components; if there are tiles, with visitors in them."""
    if node_component is None:
        node_component = members.select(F.col("uid").alias("node"), F.col("uid").alias("component")).limit(0)
    labelled = members.join(node_component, members["uid"] == node_component["node"], "left").select(
        *(members[c] for c in members.columns), F.coalesce("component", members["uid"]).alias("component")
    )
    refused = failed.select(F.col("a").alias("uid"), F.col("b").alias("other")).union(
        failed.select(F.col("b").alias("uid"), F.col("a").alias("other"))
    )
    refused = refused.groupBy("uid").agg(F.collect_set("other").alias("failed"))
    mixed = (
        labelled.groupBy("shingle")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("shingle")
    )
    mixed = stored(mixed, "mixed")
    rows = labelled.join(mixed, "shingle", "left_semi").join(refused, "uid", "left").withColumn("home", F.lit(True))
    if not tiled:
        return rows
    large = rows.where(F.col("members") > TILE)
    main = (
        large.groupBy("shingle", "component")
        .agg(F.count("*").alias("size"))
        .groupBy("shingle")
        .agg(F.max(F.struct("size", "component")).alias("main"))
        .select("shingle", F.col("main.component").alias("main"))
    )
    tiles = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("members") / TILE) - 1)
    visitors = (
        large.join(main, "shingle")
        .where("component <> main")
        .withColumn("to", F.explode(tiles))
        .where(F.col("to") != F.col("tile"))
        .withColumn("tile", F.col("to"))
        .withColumn("home", F.lit(False))
        .drop("to", "main")
    )
    return rows.unionByName(visitors)


def link(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Every row's uid, doc_id, row_key, ``n_shingles`` and ``component_id`` (smallest doc_id reachable)."""
    small_batches(docs.sparkSession)
    signed = signatures(docs, words, percent)
    sets = signed.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("uid").alias("rep"))
    classes = stored(sets, "classes")
    members = memberships(signed, classes, percent)
    none = F.lit(None).cast("array<long>")
    units = members.withColumns({"component": F.col("uid"), "failed": none, "home": F.lit(True)})
    failed = labels = None
    tiled = not members.where(F.col("members") > TILE).isEmpty()
    complete = not tiled  # members of other tiles are met as visitors, from the second round on
    most = 1
    while True:
        wanted = stored(candidates(with_bitmaps(units, signed), percent, most), "candidates")
        pairs = stored(wanted.select("a", "b").distinct(), "pairs")
        if not pairs.isEmpty():
            checked = verified(docs, signed, pairs, words, percent)
            good, bad = checked.where("linked").select("a", "b"), checked.where("NOT linked").select("a", "b")
            failed = stored(bad if failed is None else failed.union(bad), "failed")
            labels = merged(labels, good)
        elif complete:
            break
        else:
            failed = pairs.select("a", "b")
        units = stored(_active(_busy(members, wanted), labels, failed, tiled), "units")
        complete = True
        most *= FORESTS
    found = classes.withColumn("component", F.col("rep"))
    if labels is not None:
        found = classes.join(labels, classes["rep"] == labels["node"], "left").select(
            *(classes[c] for c in classes.columns), F.coalesce("component", "rep").alias("component")
        )
    # a document without words is a component of its own
    rows = signed.select("uid", "doc_id", "row_key", "n", "d1", "d2").join(
        found.select("d1", "d2", "n", "component"), ["d1", "d2", "n"], "left"
    )
    rows = stored(rows.withColumn("component", F.coalesce("component", "uid")), "components")
    # written, so that the join may split the rows of a very large component
    least = stored(rows.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    return rows.join(least, "component").select(
        "uid", "doc_id", "row_key", F.col("n").cast("long").alias("n_shingles"), "component_id", "component"
    )


def one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns."""
    linked = link(docs, words, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid", "row_key")).alias("first")
    winners = linked.groupBy("component").agg(first).select("first.doc_id", "first.row_key")
    rows = keyed(docs, "doc_id", "text")
    copies = Window.partitionBy("doc_id", "row_key").orderBy("doc_id")
    kept = rows.join(winners, same_row(rows, winners), "left_semi")
    return kept.withColumn("copy_no", F.row_number().over(copies)).where("copy_no = 1").select("row.*")
