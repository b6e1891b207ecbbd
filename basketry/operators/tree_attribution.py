"""Shapley contributions that follow the trees: no background rows, polynomial in the features.

A feature that is not known sends a row down both sides of a split, by their shares of the training rows.
For one leaf this makes a product over the features of its path: ``o`` (1 if the row is inside the
leaf's bounds of that feature, else 0) where the feature is known, and ``z`` (the share of cover that stays
inside) where it is not. The Shapley value of a factor of such a product is

    value * (o_j - z_j) * integral over t from 0 to 1 of the other factors (1 - t) z_i + t o_i

and the integrand is a polynomial of a degree below the number of features on the path, which
Gauss-Legendre quadrature with half as many points integrates exactly. So a row costs leaves * path length^2
whatever the number of features. The leaves of all trees go to the tasks as one broadcast table, which
the parameters of the model bound; rows are neither shuffled nor multiplied.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, functions as F

from basketry import scratch
from basketry.operators.ensembles import Ensemble, Node
from basketry.settings import FEATURES

# Numbers that a task holds for one step of its work.
_STEP_NUMBERS = 1 << 21


class _Paths:
    """Leaves whose paths have the same number of features."""

    def __init__(self, leaves: list, place: dict[str, int], inclusive: bool):
        self.value = np.array([leaf.value for leaf in leaves])
        sides = [[(place[f], *s) for f, s in leaf.sides.items()] for leaf in leaves]
        self.feature = np.array([[s[0] for s in own] for own in sides], np.int64)
        self.low, self.high, self.share = (np.array([[s[k] for s in own] for own in sides]) for k in (1, 2, 3))
        self.inclusive = inclusive
        points, weights = np.polynomial.legendre.leggauss(max(1, -(-self.feature.shape[1] // 2)))
        self.points, self.weights = (points + 1) / 2, weights / 2

    def add_to(self, phi: np.ndarray, rows: np.ndarray) -> None:
        n, d = self.feature.shape
        for low in range(0, n, most := max(1, _STEP_NUMBERS // max(1, len(rows) * d))):
            self._add(phi, rows, slice(low, low + most))

    def _add(self, phi: np.ndarray, rows: np.ndarray, own: slice) -> None:
        feature, z = self.feature[own], self.share[own]
        x = rows[:, feature]
        if self.inclusive:
            inside = ((x > self.low[own]) & (x <= self.high[own])).astype(float)
        else:
            inside = ((x >= self.low[own]) & (x < self.high[own])).astype(float)
        d = feature.shape[1]
        total = np.zeros_like(inside)
        for t, weight in zip(self.points, self.weights):
            factors = (1 - t) * z + t * inside
            before, after = np.ones_like(factors), np.ones_like(factors)
            for j in range(1, d):
                before[..., j] = before[..., j - 1] * factors[..., j - 1]
                after[..., d - 1 - j] = after[..., d - j] * factors[..., d - j]
            total += weight * before * after
        part = self.value[own][None, :, None] * (inside - z) * total
        for j in range(d):
            np.add.at(phi.T, feature[:, j], part[..., j].T)


class _Explainer:
    def __init__(self, trees: Ensemble, features: Sequence[str]):
        place = {c: k for k, c in enumerate(features)}
        leaves = list(trees.leaves())
        unknown = sorted({f for leaf in leaves for f in leaf.sides} - set(place))
        if unknown:
            raise ValueError(f"the trees use other features as well: {unknown}")
        self.expected = trees.base + sum(leaf.value * math.prod(s[2] for s in leaf.sides.values()) for leaf in leaves)
        lengths = sorted({len(leaf.sides) for leaf in leaves} - {0})
        self.groups = [_Paths([x for x in leaves if len(x.sides) == d], place, trees.inclusive) for d in lengths]

    def contributions(self, rows: np.ndarray) -> np.ndarray:
        phi = np.zeros(rows.shape)
        for group in self.groups:
            group.add_to(phi, rows)
        return phi


def tree_attribution(
    trees: Ensemble,
    sample: DataFrame,
    features: Sequence[str] = FEATURES,
    keys: Sequence[str] = ("product_id", "date"),
) -> DataFrame:
    """Keys, ``base_value`` (mean forecast over the training rows), ``prediction``, ``phi_<feature>``.

    The contributions of a row add up to its forecast less the base value.
    """
    explainer = _Explainer(trees, features)
    shared = sample.sparkSession.sparkContext.broadcast(explainer)
    values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) for c in features]
    rows = sample.select(*keys, *values)
    schema = rows.select(*keys).schema
    for name in ("base_value", "prediction", *(f"phi_{c}" for c in features)):
        schema = schema.add(name, "double")
    first = len(keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[first:]])
            phi = shared.value.contributions(x)
            base = np.full(len(x), shared.value.expected)
            made = [pa.array(c) for c in (base, base + phi.sum(axis=1), *phi.T)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:first], *made], schema.names)

    return rows.mapInArrow(work, schema)


def mllib_trees(model: PipelineModel) -> Ensemble:
    """The trees of a fitted MLlib forest or boosted model as data, from the node table it saves."""
    features = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    fitted = [s for s in model.stages if hasattr(s, "treeWeights")]
    trees = []
    for stage in fitted:
        boosted = isinstance(stage, GBTRegressionModel)
        for k, nodes in enumerate(_saved_nodes(stage)):
            share = stage.treeWeights[k] if boosted else 1.0 / (stage.getNumTrees * len(fitted))
            trees.append(tuple(_node(n, features, share) for n in nodes))
    return Ensemble(tuple(features), tuple(trees), inclusive=True)


def _saved_nodes(stage) -> list[list]:
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    path = scratch.scratch_path(spark, "trees")
    stage.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    scratch.delete(spark, path)
    trees: dict[int, list] = {}
    for r in rows:
        trees.setdefault(r["treeID"], []).append(r)
    return [trees[t] for t in sorted(trees)]


def _node(row, features: Sequence[str], share: float) -> Node:
    cover = row["impurityStats"][0]
    if row["leftChild"] < 0:
        return Node(row["prediction"] * share, cover)
    split = row["split"]
    feature, cut = features[split["featureIndex"]], split["leftCategoriesOrThreshold"][0]
    return Node(row["prediction"] * share, cover, feature, cut, row["leftChild"], row["rightChild"])
