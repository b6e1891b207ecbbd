"""A forest whose bags follow from the keys of the rows, the same in any engine and partitioning.

How often a row is drawn for a tree is a Poisson number (mean 1) read off a hash of its key and
the tree's number, so no draw depends on where a row lies. MLlib takes it as the weight of the row.
Rows that are not drawn are left out, so that ``min_samples_leaf`` counts drawn rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from basketry import scratch
from basketry.functions.ordering import SAMPLE_PRIME, hash_arrays, key_columns
from basketry.jobs import side_by_side

_VECTOR = "feature_vector"
MOST_DRAWS = 12


def poisson_bounds() -> list[int]:
    """Hash values from which a row is drawn once, twice and so on."""
    bounds, total, term = [], Fraction(0), Fraction(math.exp(-1))
    for k in range(1, MOST_DRAWS + 1):
        total += term
        bounds.append(math.floor(total * SAMPLE_PRIME))
        term /= k
    return [b for b in bounds if b < SAMPLE_PRIME]


def draws(product_id: Column, date: Column, seed: int, tree: int) -> Column:
    """How often the bag of a tree holds a row."""
    bounds = np.array(poisson_bounds(), np.int64)

    def times(ids: pa.Array, days: pa.Array) -> pa.Array:
        drawn, missing = hash_arrays(ids, days, seed * 1_000_003 + tree)
        return pa.array(np.searchsorted(bounds, drawn, "right").astype(float), pa.float64(), mask=missing)

    return F.arrow_udf(times, "double")(*key_columns(product_id, date))


def fit_bagged(
    rows: DataFrame,
    features: Sequence[str],
    target: str,
    seed: int,
    trees: int,
    max_depth: int,
    min_rows: int,
    max_features: str,
    max_bins: int,
    parallelism: int = 4,
) -> PipelineModel:
    """Mean of ``trees`` trees, a few of them fitted side by side.

    MLlib reads the rows of a tree several times, so the draws of those few are worked out once and persisted.
    """
    spark = rows.sparkSession
    scratch.shared_dir(spark)
    assembler = VectorAssembler(inputCols=list(features), outputCol=_VECTOR)
    vectors = assembler.transform(rows).select("product_id", "date", _VECTOR, target)

    def fit(drawn: DataFrame, tree: int):
        return RandomForestRegressor(
            featuresCol=_VECTOR,
            labelCol=target,
            weightCol=_drawn(tree),
            predictionCol=_forecast(tree),
            numTrees=1,
            bootstrap=False,
            maxDepth=max_depth,
            minInstancesPerNode=min_rows,
            featureSubsetStrategy=max_features,
            maxBins=max_bins,
            seed=seed + tree,
        ).fit(drawn.where(F.col(_drawn(tree)) > 0))

    fitted = []
    for start in range(0, trees, max(1, parallelism)):
        some = range(start, min(trees, start + max(1, parallelism)))
        weights = [draws(F.col("product_id"), F.col("date"), seed, t).alias(_drawn(t)) for t in some]
        drawn = vectors.select(_VECTOR, target, *weights).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fitted += side_by_side(spark, partial(fit, drawn), some, parallelism)
        finally:
            drawn.unpersist()
    total = "+".join(_forecast(t) for t in range(trees))
    mean = SQLTransformer(statement=f"SELECT *, ({total}) / {trees} AS prediction FROM __THIS__")
    return PipelineModel([assembler, *fitted, mean])


def _drawn(tree: int) -> str:
    return f"_drawn{tree}"


def _forecast(tree: int) -> str:
    return f"_forecast{tree}"
