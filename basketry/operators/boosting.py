"""Second-order gradient boosting on histograms, grown by depth or leaf by leaf.

Rows are cut into bins once. For a round, each row gets the gradient of the squared error at the
forecast so far, as a whole number of 2^-16 steps, so that sums are exact: the same rows give
the same trees in any partitioning, and after any lost task. A level of a tree is one partially
aggregated count, (node, feature, bin) -> sums of gradients, weights and rows; its size depends on the
parameters alone. Only the smaller child of each split is counted, the other is what the parent has
more. The best splits are chosen from these tables on the driver.

Rows with the same bins and target have the same forecast and gradient in every round; they differ only in
which samples have them. If there are few such kinds of rows (``MOST_KINDS``), the rows are read once for
many rounds, to count how many of a kind each sample has, and the levels are counted from the kinds. The sums are
the same whole numbers, hence the trees too. With more kinds, each level is counted from the rows.

A split gains ``L^2/(W_L+l2) + R^2/(W_R+l2) - (L+R)^2/(W+l2)`` with sums of gradients L and R, and a leaf says
``learning_rate * sum/(weight+l2)``: more regularisation means smaller leaves.

Leaf-wise growth splits the open leaf with the largest gain, up to a number of leaves. A node's
split depends on its own rows alone, so it needs no job for each leaf: open nodes are split level by level and the order
is replayed afterwards. A node can be among the first k splits only if fewer than k nodes have a
larger least gain on the way from the root, which bounds the nodes of a level by the leaves asked for.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from basketry import scratch
from basketry.functions.ordering import SAMPLE_PRIME, hash_arrays, key_columns, key_hash
from basketry.operators.ensembles import Ensemble, Node

# Gradients are whole multiples of this step.
STEP = 2.0**-16
# Rounds after which the forecast so far is written out.
ROUNDS_AT_ONCE = 8
# A level of a tree of this depth has 4,096 nodes; the driver holds their histograms.
DEEPEST_LEVEL = 12
LEAST_GAIN = 1e-9
# Kinds of rows (bins and target) that the driver grows trees from; their counts in 50 samples take some 50 MB.
MOST_KINDS = 2**17
# Rounds whose samples are counted in one pass over the rows, a bit each.
SAMPLES_AT_ONCE = 50

_MARGIN = "_margin"
_SAMPLED = "_sampled"


@dataclass(frozen=True)
class Growth:
    """How a tree may grow."""

    max_depth: int = 8
    max_leaves: int | None = None  # best first up to so many leaves; None: every split that gains
    l2: float = 1.0
    min_rows: int = 1
    min_weight: float = 1.0

    def __post_init__(self):
        if not 1 <= self.max_depth <= DEEPEST_LEVEL:
            raise ValueError(f"max_depth is 1 to {DEEPEST_LEVEL}; got {self.max_depth}")
        if self.max_leaves is not None and self.max_leaves < 2:
            raise ValueError(f"num_leaves is 2 at least; got {self.max_leaves}")


@dataclass(frozen=True)
class Boosting:
    rounds: int = 200
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample: float = 1.0
    max_bins: int = 256
    growth: Growth = Growth()


# -- bins ----------------------------------------------------------------------------------


def feature_cuts(rows: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Where each feature is cut: between all its values, or at even shares of the rows if there are too many.

    Values are counted first, so the exact percentiles see each distinct value of a feature once.
    """
    values = [F.struct(F.lit(j).alias("f"), F.col(c).alias("v")) for j, c in enumerate(features)]
    levels = rows.select(F.inline(F.array(*values))).groupBy("f", "v").agg(F.count("*").alias("n"))
    shares = [k / max_bins for k in range(1, max_bins)]
    found = levels.groupBy("f").agg(F.count("*").alias("levels"), F.percentile("v", shares, F.col("n")).alias("cuts")).collect()
    cuts: list[list[float]] = [[] for _ in features]
    few = [r["f"] for r in found if r["levels"] <= max_bins]
    for r in found:
        if r["levels"] > max_bins:
            cuts[r["f"]] = sorted(set(r["cuts"]))
    listed: dict[int, list[float]] = {}
    for r in levels.where(F.col("f").isin(few)).collect() if few else []:
        listed.setdefault(r["f"], []).append(r["v"])
    for f, own in listed.items():
        own.sort()
        cuts[f] = sorted({(a + b) / 2 for a, b in zip(own, own[1:])})
    return cuts


def _bin(j: int) -> str:
    return f"_bin{j}"


def with_bins(rows: DataFrame, features: Sequence[str], cuts: list[list[float]]) -> DataFrame:
    """``rows`` with the bin of every feature: how many cuts lie at or below its value."""
    cut = [j for j in range(len(features)) if cuts[j]]
    if cut:
        rows = Bucketizer(
            splitsArray=[[-math.inf, *cuts[j], math.inf] for j in cut],
            inputCols=[features[j] for j in cut],
            outputCols=[_bin(j) for j in cut],
        ).transform(rows)
    return rows.withColumns({_bin(j): F.col(_bin(j)).cast("int") if cuts[j] else F.lit(0) for j in range(len(features))})


# -- one tree ------------------------------------------------------------------------------


@dataclass
class _Open:
    """A node while its tree grows."""

    depth: int
    totals: np.ndarray  # sum of gradients in steps, weight, rows
    key: float = math.inf  # least gain on the way here
    table: np.ndarray | None = None  # (feature, bin, 3)
    split: tuple[float, int, int] | None = None  # gain, feature, last bin on the left
    below: np.ndarray | None = None  # totals of the left side
    children: tuple[int, int] | None = None


def _best_split(node: _Open, columns: Sequence[int], cuts: list[list[float]], growth: Growth):
    """Largest gain; ties go to the first feature, then to the lowest cut. Also the left side's totals."""
    left = np.cumsum(node.table, axis=1)[:, :-1]
    right = node.totals - left
    g, w = left[..., 0] * STEP, left[..., 1].astype(float)
    h, v = right[..., 0] * STEP, right[..., 1].astype(float)
    total, weight = node.totals[0] * STEP, float(node.totals[1])
    enough = (left[..., 2] >= growth.min_rows) & (right[..., 2] >= growth.min_rows)
    enough &= (w >= growth.min_weight) & (v >= growth.min_weight)
    places = np.arange(left.shape[1])
    enough &= places[None, :] < np.array([len(cuts[j]) for j in columns])[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / (w + growth.l2) + h * h / (v + growth.l2) - total * total / (weight + growth.l2)
    gain = np.where(enough, gain, -math.inf)
    best = int(gain.argmax()) if gain.size else -1
    if best < 0 or not gain.flat[best] > LEAST_GAIN:
        return None, None
    f, b = divmod(best, gain.shape[1])
    return (float(gain.flat[best]), columns[f], b), left[f, b]


def _located(nodes: list[_Open], wanted: set[int]) -> str:
    """SQL for the wanted node a row is in, -1 if it is in none."""

    def of(at: int) -> str:
        if nodes[at].children is None:
            return str(at if at in wanted else -1)
        _, f, b = nodes[at].split
        low, high = (of(c) for c in nodes[at].children)
        return low if low == high else f"if({_bin(f)}<={b},{low},{high})"

    return of(0)


# Histograms (feature, bin, sums of gradients in steps, weights and rows) of the wanted nodes.
Tables = Callable[[list[_Open], set[int], Sequence[int], int], dict[int, np.ndarray]]


def _tables(rows: DataFrame, nodes: list[_Open], wanted: set[int], columns: Sequence[int], bins: int) -> dict:
    """Histograms over rows with whole-number ``_g`` (gradient in steps) and ``_w`` (weight): the only job of a level."""
    pairs = [F.struct(F.lit(k).alias("f"), F.col(_bin(j)).alias("b")) for k, j in enumerate(columns)]
    found = (
        rows.withColumn("_node", F.expr(_located(nodes, wanted)))
        .where("_node >= 0")
        .select("_node", "_g", "_w", F.inline(F.array(*pairs)))
        .groupBy("_node", "f", "b")
        .agg(F.sum("_g").alias("g"), F.sum("_w").alias("w"), F.count("*").alias("n"))
        .toArrow()
    )
    tables = {n: np.zeros((len(columns), bins, 3), np.int64) for n in wanted}
    node, f, b = (found[c].to_numpy() for c in ("_node", "f", "b"))
    sums = np.column_stack([found[c].to_numpy() for c in ("g", "w", "n")]) if len(node) else np.zeros((0, 3))
    for n in wanted:
        own = node == n
        tables[n][f[own], b[own]] = sums[own]
    return tables


def grow(tables: Tables, columns: Sequence[int], cuts: list[list[float]], growth: Growth) -> list[_Open]:
    """A tree from the histograms that ``tables`` gives of wanted nodes."""
    bins = max(len(c) for c in cuts) + 1
    nodes = [_Open(0, np.zeros(3, np.int64))]
    root = tables(nodes, {0}, columns, bins)[0]
    nodes[0].table, nodes[0].totals = root, root[0].sum(axis=0)
    level, keys = [0], []
    while level:
        for at in level:
            node = nodes[at]
            node.split, node.below = _best_split(node, columns, cuts, growth)
            if node.split:
                node.key = min(node.key, node.split[0])
                keys.append(node.key)
        bound = -math.inf
        if growth.max_leaves is not None and len(keys) >= growth.max_leaves:
            bound = heapq.nlargest(growth.max_leaves - 1, keys)[-1]
        below, smaller = [], {}
        for at in level:
            node = nodes[at]
            if not node.split or node.key < bound:  # a leaf, as others come first
                continue
            sides = (node.below, node.totals - node.below)
            node.children = (len(nodes), len(nodes) + 1)
            nodes += [_Open(node.depth + 1, s, node.key) for s in sides]
            if node.depth + 1 < growth.max_depth:
                below += node.children
                smaller[node.children[int(sides[1][2] < sides[0][2])]] = at
        counted = tables(nodes, set(smaller), columns, bins) if smaller else {}
        for child, at in smaller.items():
            other = sum(nodes[at].children) - child
            nodes[child].table, nodes[other].table = counted[child], nodes[at].table - counted[child]
        for at in level:
            nodes[at].table = None
        level = below
    return nodes


def _chosen(nodes: list[_Open], max_leaves: int | None) -> set[int]:
    """The nodes that are split: all of them, or the best first."""
    if max_leaves is None:
        return {n for n, node in enumerate(nodes) if node.children}
    chosen: set[int] = set()
    queue = [(-nodes[0].split[0], 0)] if nodes[0].children else []
    while queue and len(chosen) < max_leaves - 1:
        _, at = heapq.heappop(queue)
        chosen.add(at)
        for child in nodes[at].children:
            if nodes[child].children:
                heapq.heappush(queue, (-nodes[child].split[0], child))
    return chosen


def finished(
    nodes: list[_Open],
    split: Callable[[int, int], tuple[str, float]],
    growth: Growth,
    learning_rate: float,
) -> tuple[Node, ...]:
    """The grown tree with its values, root first; ``split`` names (feature, last bin on the left)."""
    chosen = _chosen(nodes, growth.max_leaves)
    out: list[Node | None] = []

    def add(at: int) -> int:
        place = len(out)
        out.append(None)
        node = nodes[at]
        weight = float(node.totals[1])
        over = weight + growth.l2
        value = learning_rate * (float(node.totals[0] * STEP) / over) if over else 0.0
        if at not in chosen:
            out[place] = Node(value, weight)
        else:
            feature, cut = split(*node.split[1:])
            low, high = (add(c) for c in node.children)
            out[place] = Node(value, weight, feature, cut, low, high)
        return place

    add(0)
    return tuple(out)


# -- rounds --------------------------------------------------------------------------------


def sampled_rows(seed: int, tree: int, share: float) -> Column:
    """Whether a row belongs to the sample of a tree, by a hash of its key."""
    drawn = key_hash(F.col("product_id"), F.col("date"), _sample_seed(seed, tree))
    return drawn < F.lit(_sample_bound(share))


def _sample_seed(seed: int, tree: int) -> int:
    return seed * 1_000_003 + tree


def _sample_bound(share: float) -> int:
    return math.floor(share * SAMPLE_PRIME)


def sampled_columns(seed: int, tree: int, share: float, n: int) -> list[int]:
    """The features that a tree may split on, in order; one at least."""
    if not 0 < share <= 1:
        raise ValueError(f"colsample is above 0 and 1 at most; got {share}")
    return sorted(random.Random(f"columns:{seed}:{tree}").sample(range(n), max(1, int(share * n))))


@dataclass
class _Kinds:
    """Rows of equal bins and target, counted."""

    bins: np.ndarray  # (feature, kind)
    target: np.ndarray
    rows: np.ndarray


def _counted(binned: DataFrame, features: int, *counts: Column) -> DataFrame:
    return binned.groupBy("_y", *(_bin(j) for j in range(features))).agg(*counts)


def _in_order(found: pa.Table) -> pa.Table:
    keys = [c for c in found.column_names if c == "_y" or c.startswith("_bin")]
    return found.sort_by([(c, "ascending") for c in keys])


def _kinds(binned: DataFrame, features: int) -> _Kinds | None:
    """The kinds of rows in a fixed order, unless there are more than ``MOST_KINDS``."""
    found = _counted(binned, features, F.count("*").alias("n")).limit(MOST_KINDS + 1).toArrow()
    if found.num_rows > MOST_KINDS:
        return None
    found = _in_order(found)
    bins = np.stack([found[_bin(j)].to_numpy() for j in range(features)])
    return _Kinds(bins, found["_y"].to_numpy(), found["n"].to_numpy())


def _sample_sizes(binned: DataFrame, kinds: _Kinds, seed: int, trees: range, share: float) -> np.ndarray:
    """How many rows of each kind the sample of each tree has; one pass over the rows."""
    if share >= 1:
        return np.broadcast_to(kinds.rows, (len(trees), len(kinds.rows)))
    seeds, bound = [_sample_seed(seed, t) for t in trees], _sample_bound(share)

    def samples(ids: pa.Array, days: pa.Array) -> pa.Array:
        held = np.zeros(len(ids), np.int64)
        for k, own in enumerate(seeds):
            drawn, missing = hash_arrays(ids, days, own)
            held |= ((drawn < bound) & ~missing).astype(np.int64) << k
        return pa.array(held, pa.int64())

    held = F.arrow_udf(samples, "long")(*key_columns(F.col("product_id"), F.col("date")))
    sizes = [F.sum(F.shiftright("_held", k).bitwiseAND(F.lit(1).cast("long"))).alias(f"_n{k}") for k in range(len(seeds))]
    found = _in_order(_counted(binned.withColumn("_held", held), len(kinds.bins), *sizes).toArrow())
    return np.stack([found[f"_n{k}"].to_numpy() for k in range(len(seeds))])


def _kind_tables(
    kinds: _Kinds, gradient: np.ndarray, size: np.ndarray,
    nodes: list[_Open], wanted: set[int], columns: Sequence[int], bins: int,
) -> dict:
    """Histograms over the kinds of rows, in whole numbers as over the rows."""
    numbers = np.full(len(nodes), -1)
    listed = sorted(wanted)
    numbers[listed] = range(len(listed))
    node = numbers[_nodes_of(kinds.bins, nodes)]
    inside = (node >= 0) & (size > 0)
    own, n = node[inside], size[inside]
    sums = np.stack([gradient[inside] * n, n, n], axis=1)
    found = np.zeros((len(listed), len(columns), bins, 3), np.int64)
    for k, j in enumerate(columns):
        np.add.at(found, (own, k, kinds.bins[j][inside]), sums)
    return dict(zip(listed, found))


def _nodes_of(bins: np.ndarray, nodes: list[_Open]) -> np.ndarray:
    """The last node that each kind of rows reaches."""
    feature, last, low = (np.full(len(nodes), -1) for _ in range(3))
    for at, node in enumerate(nodes):
        if node.children:
            _, feature[at], last[at] = node.split
            low[at] = node.children[0]
    place = np.zeros(bins.shape[1], np.int64)
    moving = np.flatnonzero(low[place] >= 0)
    while len(moving):
        at = place[moving]
        place[moving] = low[at] + (bins[feature[at], moving] > last[at])
        moving = moving[low[place[moving]] >= 0]
    return place


def _values_of(bins: np.ndarray, tree: Sequence[Node]) -> np.ndarray:
    """What a finished tree over bins says about each kind of rows; ``feature`` is a number."""
    feature = np.array([-1 if n.feature is None else n.feature for n in tree])
    cut = np.array([math.nan if n.cut is None else n.cut for n in tree])
    low, high, value = (np.array([getattr(n, c) for n in tree]) for c in ("left", "right", "value"))
    place = np.zeros(bins.shape[1], np.int64)
    moving = np.flatnonzero(feature[place] >= 0)
    while len(moving):
        at = place[moving]
        place[moving] = np.where(bins[feature[at], moving] < cut[at], low[at], high[at])
        moving = moving[feature[place[moving]] >= 0]
    return value[place]


def _boost_kinds(
    binned: DataFrame, kinds: _Kinds, features: Sequence[str], cuts: list[list[float]], base: float, seed: int, how: Boosting
) -> list[tuple[Node, ...]]:
    """All rounds from the kinds of rows."""
    margin, trees = np.full(len(kinds.target), base), []
    for number in range(how.rounds):
        place = number % SAMPLES_AT_ONCE
        if place == 0:
            some = range(number, min(how.rounds, number + SAMPLES_AT_ONCE))
            sizes = _sample_sizes(binned, kinds, seed, some, how.subsample)
        gradient = np.floor((kinds.target - margin) / STEP + 0.5).astype(np.int64)
        columns = sampled_columns(seed, number, how.colsample, len(features))
        nodes = grow(partial(_kind_tables, kinds, gradient, sizes[place]), columns, cuts, how.growth)
        trees.append(finished(nodes, lambda f, b: (features[f], cuts[f][b]), how.growth, how.learning_rate))
        margin += _values_of(kinds.bins, finished(nodes, lambda f, b: (f, b + 0.5), how.growth, how.learning_rate))
    return trees


def boost(rows: DataFrame, features: Sequence[str], target: str, seed: int, how: Boosting) -> Ensemble:
    """Fit on rows with a key, double features and a double target.

    With more kinds of rows than ``MOST_KINDS``, a round reads rows of bins, target, forecast so far and
    whether the round's sample has them. They are persisted, and written out every ``ROUNDS_AT_ONCE`` rounds, which
    bounds what a lost executor costs.
    """
    if not 0 < how.subsample <= 1:
        raise ValueError(f"subsample is above 0 and 1 at most; got {how.subsample}")
    spark, features = rows.sparkSession, tuple(features)
    cuts = feature_cuts(rows, features, how.max_bins)
    steps = F.floor(F.col(target) / STEP + 0.5).cast("long")
    first = rows.agg(F.sum(steps).alias("s"), F.count("*").alias("n")).first()
    if not first["n"]:
        raise ValueError("no rows to learn from")
    base = first["s"] * STEP / first["n"]
    bins = [_bin(j) for j in range(len(features))]
    gradient = F.floor((F.col("_y") - F.col(_MARGIN)) / STEP + 0.5).cast("long")

    def sample(number: int) -> Column:
        return sampled_rows(seed, number, how.subsample) if how.subsample < 1 else F.lit(True)

    binned = with_bins(rows, features, cuts).select("product_id", "date", F.col(target).alias("_y"), *bins)
    kinds = _kinds(binned, len(features))
    if kinds is not None:
        return Ensemble(features, tuple(_boost_kinds(binned, kinds, features, cuts, base, seed, how)), float(base))
    state = binned.select("*", F.lit(base).alias(_MARGIN), sample(0).alias(_SAMPLED))
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[tuple[Node, ...]] = []
    earlier, stored = None, None  # the last round's rows; where rows were written last
    try:
        for number in range(how.rounds):
            own = state.where(_SAMPLED).select(gradient.alias("_g"), F.lit(1).cast("long").alias("_w"), *bins)
            columns = sampled_columns(seed, number, how.colsample, len(features))
            nodes = grow(partial(_tables, own), columns, cuts, how.growth)
            trees.append(finished(nodes, lambda f, b: (features[f], cuts[f][b]), how.growth, how.learning_rate))
            if earlier is not None:
                earlier.unpersist()
            if number + 1 == how.rounds:
                break
            step = finished(nodes, lambda f, b: (_bin(f), b + 0.5), how.growth, how.learning_rate)
            forecast = F.col(_MARGIN) + F.expr(Ensemble((), (step,)).tree_expression(0))
            following = state.withColumns({_MARGIN: forecast, _SAMPLED: sample(number + 1)})
            if (number + 1) % ROUNDS_AT_ONCE == 0:
                before, stored = stored, scratch.scratch_path(spark, "margin")
                following.write.parquet(stored)
                following = spark.read.schema(state.schema).parquet(stored)
                if before:
                    scratch.delete(spark, before)
            earlier, state = state, following.persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        state.unpersist()
        if earlier is not None:
            earlier.unpersist()
        if stored:
            scratch.delete(spark, stored)
    return Ensemble(features, tuple(trees), float(base))
