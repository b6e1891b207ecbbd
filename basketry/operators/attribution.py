"""Shapley contributions of each feature to each forecast."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from basketry.functions.ordering import SAMPLE_PRIME, key_hash, nth_smallest
from basketry.operators.scoring import Scorer, with_prediction
from basketry.settings import ATTRIBUTION_BACKGROUND, ATTRIBUTION_ROWS, FEATURES, SEED


def attribution_sample(df: DataFrame, n: int = ATTRIBUTION_ROWS, seed: int = SEED) -> DataFrame:
    """``n`` pseudo-random rows (all when there are fewer), the same ones in any partitioning.

    The rows with the ``n`` smallest key hashes. The cut-off hash is looked up first, so the
    closing top-n gets about ``n`` rows in all instead of ``n`` from every task.
    """
    hashed = df.withColumn("_hash", key_hash(F.col("product_id"), F.col("date"), seed))
    grouped = hashed.select(F.lit(0).alias("g"), "_hash")
    cutoff = nth_smallest(grouped, "g", "_hash", {0: [n - 1]}, 0, SAMPLE_PRIME - 1)[0][n - 1]
    if cutoff is None:
        return df
    near = hashed.where(F.col("_hash") <= cutoff)
    return near.orderBy("_hash", "product_id", "date").limit(n).select(*df.columns)


def background_rows(
    df: DataFrame, n: int = ATTRIBUTION_BACKGROUND, seed: int = SEED + 1
) -> DataFrame:
    """The few rows that stand for "feature unknown"."""
    return attribution_sample(df, n, seed)


def _shapley_weights(n: int) -> list[list[float]]:
    """Per feature, the weight of every coalition's forecast (bit j set: feature j known)."""
    share = [math.factorial(s) * math.factorial(n - s - 1) / math.factorial(n) for s in range(n)]
    weights = []
    for j in range(n):
        others = [(mask & ~(1 << j)).bit_count() for mask in range(1 << n)]
        weights.append(
            [share[s] if mask >> j & 1 else -share[s] for mask, s in enumerate(others)]
        )
    return weights


def attribution(
    scorer: Scorer,
    sample: DataFrame,
    background: DataFrame,
    features: Sequence[str] = FEATURES,
    keys: Sequence[str] = ("product_id", "date"),
    most_background: int = 200,
    most_features: int = 12,
) -> DataFrame:
    """Interventional Shapley values: keys, ``base_value``, ``prediction``, ``phi_<feature>``.

    The contributions of a row add up to its forecast minus the mean background forecast.
    Every sample row is scored with each coalition of its own features, the others taken
    from each background row: 2^features * background forecasts for each row, hence
    ``most_features``. The background is a fixed handful of rows (more than
    ``most_background`` is an error) and travels as literals in the plan; the sample is
    spread over the cluster before it is expanded, and one aggregate on the same
    partitioning folds the scores, so the expanded rows are never shuffled.
    """
    n = len(features)
    if n > most_features:
        raise ValueError(f"{n} features make 2^{n} coalitions; most_features is {most_features}")
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    known = background.select(*values).limit(most_background + 1).collect()
    if not 0 < len(known) <= most_background:
        raise ValueError(f"the background needs 1 to {most_background} rows")

    partitions = int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = sample.select(*keys, *values).repartition(partitions, *keys)
    coalitions = spread.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))).alias("mask")
    )
    mixes = coalitions.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(len(known) - 1))).alias("other")
    )
    mixed = mixes.withColumns(
        {
            c: F.when(F.col("mask").bitwiseAND(1 << j) != 0, F.col(c)).otherwise(
                F.get(F.lit([row[c] for row in known]), F.col("other"))
            )
            for j, c in enumerate(features)
        }
    )
    scored = with_prediction(mixed, scorer, features, "f")
    mask, f = F.col("mask"), F.col("f")
    contributions = [
        (F.sum(F.get(F.lit(w), mask) * f) / len(known)).alias(f"phi_{c}")
        for c, w in zip(features, _shapley_weights(n))
    ]
    return scored.groupBy(*keys).agg(
        F.avg(F.when(mask == 0, f)).alias("base_value"),
        F.avg(F.when(mask == (1 << n) - 1, f)).alias("prediction"),
        *contributions,
    )


def attribution_ranking(contributions: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    means = [
        F.struct(F.lit(c).alias("feature"), F.avg(F.abs(f"phi_{c}")).alias("mean_abs"))
        for c in features
    ]
    table = contributions.agg(F.array(*means).alias("m")).select(F.inline("m"))
    return table.orderBy(F.desc("mean_abs"), "feature")
