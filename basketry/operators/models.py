"""Tree models on MLlib and the comparison of all six forecasts on one split."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from basketry import scratch
from basketry.jobs import side_by_side
from basketry.operators import bagging, boosting
from basketry.operators.baselines import BASELINE_COLUMNS, with_baselines
from basketry.operators.ensembles import Ensemble
from basketry.operators.metrics import regression_metrics
from basketry.operators.scoring import with_prediction
from basketry.operators.splits import Split, labelled
from basketry.settings import FEATURES, KEYED_MODELS, MODEL_DEFAULTS, MODELS, SEED, TARGET, TREE_MODELS

# MLlib's deepest tree, standing in for "no limit".
DEEPEST = 30

# Most split points of a feature, unless a model asks for another number. MLlib looks for them
# among max_bins^2 rows, here a million; a feature with fewer values has a point between any two.
MAX_BINS = 1024

_VECTOR = "feature_vector"


def training_rows(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Labelled rows as doubles, in a partitioning and order that depend on the keys alone.

    Bagging draws per partition and position, so a fixed layout is what makes a seed mean
    the same forest twice, also when a lost task is run again.
    """
    partitions = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    doubles = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    rows = labelled(train, target).select(
        "product_id", "date", *doubles, F.col(target).cast("double").alias(target), *keep
    )
    return rows.repartition(partitions, "product_id", "date").sortWithinPartitions(
        "product_id", "date"
    )


def _fit(regressor, rows: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Fit on the features as they are."""
    # MLlib writes checkpoints every few trees; this names the folder for them.
    scratch.shared_dir(rows.sparkSession)
    stages = [VectorAssembler(inputCols=list(features), outputCol=_VECTOR), regressor]
    return Pipeline(stages=stages).fit(rows)


def _settings(model: str, params: dict | None, extra: Sequence[str] = ()) -> dict:
    defaults = MODEL_DEFAULTS[model]
    unknown = sorted(set(params or {}) - set(defaults) - {"max_bins", *extra})
    if unknown:
        raise ValueError(f"Unknown {model} parameters: {unknown}")
    return {**defaults, **(params or {})}


def _with_bins(regressor, params: dict):
    return regressor.setMaxBins(params.get("max_bins", MAX_BINS))


def _depth(value: int | None) -> int:
    """``None`` is the engine's deepest tree; a number beyond that is an error."""
    if value is not None and value > DEEPEST:
        raise ValueError(f"max_depth is {DEEPEST} at most; got {value}")
    return DEEPEST if value is None else int(value)


def _forest(rows, features, target, seed, params) -> PipelineModel:
    p = _settings("random_forest", params, ("bootstrap",))
    regressor = RandomForestRegressor(
        featuresCol=_VECTOR,
        labelCol=target,
        numTrees=p["n_estimators"],
        maxDepth=_depth(p["max_depth"]),
        minInstancesPerNode=p["min_samples_leaf"],
        featureSubsetStrategy=str(p["max_features"]),
        bootstrap=p.get("bootstrap", True),
        seed=seed,
    )
    return _fit(_with_bins(regressor, p), rows, features)


def _boosted(rows, features, target, seed, p, depth, subsample, min_leaf) -> PipelineModel:
    regressor = GBTRegressor(
        featuresCol=_VECTOR,
        labelCol=target,
        lossType="squared",
        maxIter=p["n_estimators"],
        maxDepth=depth,
        stepSize=p["learning_rate"],
        subsamplingRate=subsample,
        featureSubsetStrategy=str(p["colsample"]),
        minInstancesPerNode=min_leaf,
        seed=seed,
    )
    return _fit(_with_bins(regressor, p), rows, features)


def _depthwise(rows, features, target, seed, params) -> PipelineModel:
    p = _settings("gbt_depthwise", params)
    return _boosted(
        rows, features, target, seed, p, _depth(p["max_depth"]), float(p["subsample"]), 1
    )


def _leafcap(rows, features, target, seed, params) -> PipelineModel:
    # A leaf limit becomes the depth that holds as many leaves. "subsample" is accepted and
    # has no effect, as row bagging stays off.
    extra = ("min_child_samples", "subsample")
    p = _settings("gbt_leafcap", params, extra)
    depth = min(_depth(p["max_depth"]), math.ceil(math.log2(p["num_leaves"])))
    return _boosted(rows, features, target, seed, p, depth, 1.0, p.get("min_child_samples", 20))


def _keyed_forest(rows, features, target, seed, params) -> PipelineModel:
    p = _settings("forest_keyed", params)
    return bagging.fit_bagged(
        rows,
        features,
        target,
        seed,
        trees=p["n_estimators"],
        max_depth=_depth(p["max_depth"]),
        min_rows=p["min_samples_leaf"],
        max_features=str(p["max_features"]),
        max_bins=p.get("max_bins", MAX_BINS),
    )


def second_order_settings(params: dict | None = None) -> boosting.Boosting:
    p = _settings("gbt_second_order", params)
    growth = boosting.Growth(
        max_depth=p["max_depth"], l2=p["reg_lambda"], min_weight=p["min_child_weight"]
    )
    return _boosting(p, p["subsample"], growth)


def leafwise_settings(params: dict | None = None) -> boosting.Boosting:
    # As with gbt_leafcap, "subsample" is accepted and has no effect.
    p = _settings("gbt_leafwise", params, ("subsample",))
    growth = boosting.Growth(
        max_depth=p["max_depth"],
        max_leaves=p["num_leaves"],
        l2=p["reg_lambda"],
        min_rows=p["min_child_samples"],
        min_weight=0.0,
    )
    return _boosting(p, 1.0, growth)


def _boosting(p: dict, subsample: float, growth: boosting.Growth) -> boosting.Boosting:
    return boosting.Boosting(
        p["n_estimators"],
        p["learning_rate"],
        float(subsample),
        float(p["colsample"]),
        p.get("max_bins", boosting.Boosting.max_bins),
        growth,
    )


def _second_order(rows, features, target, seed, params) -> PipelineModel:
    return boosting.boost(rows, features, target, seed, second_order_settings(params)).pipeline()


def _leafwise(rows, features, target, seed, params) -> PipelineModel:
    return boosting.boost(rows, features, target, seed, leafwise_settings(params)).pipeline()


_FITTERS = {
    "random_forest": _forest,
    "gbt_depthwise": _depthwise,
    "gbt_leafcap": _leafcap,
    "forest_keyed": _keyed_forest,
    "gbt_second_order": _second_order,
    "gbt_leafwise": _leafwise,
}


def _persisted(fit):
    """Fit on rows that are laid out once and read for every level of every tree."""

    def run(train, features=FEATURES, target=TARGET, seed: int = SEED, params: dict | None = None):
        rows = training_rows(train, features, target).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return fit(rows, features, target, seed, params)
        finally:
            rows.unpersist()

    return run


def fit_rows(
    model: str,
    rows: DataFrame,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    seed: int = SEED,
    params: dict | None = None,
) -> PipelineModel:
    """Fit one model on the output of ``training_rows``."""
    return _FITTERS[model](rows, features, target, seed, params)


# Boosting is limited by depth, with row and feature sampling, or by leaves (as a depth) and
# rows per leaf.
fit_random_forest = _persisted(_forest)
fit_gbt_depthwise = _persisted(_depthwise)
fit_gbt_leafcap = _persisted(_leafcap)

# Bags by a hash of the key, boosting with second-order gains by depth, and leaf by leaf.
fit_forest_keyed = _persisted(_keyed_forest)
fit_gbt_second_order = _persisted(_second_order)
fit_gbt_leafwise = _persisted(_leafwise)


def boosted_trees(
    train: DataFrame,
    how: boosting.Boosting,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    seed: int = SEED,
) -> Ensemble:
    """The boosted trees themselves, for attribution and for a table of their nodes."""
    rows = training_rows(train, features, target).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return boosting.boost(rows, features, target, seed, how)
    finally:
        rows.unpersist()


def fit_all(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    params: dict | None = None,
    seed: int = SEED,
    models: Sequence[str] = TREE_MODELS,
) -> dict[str, PipelineModel]:
    """The tree models, fitted side by side on one shared, persisted set of training rows."""
    rows = training_rows(train, features, target).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(model: str) -> PipelineModel:
        return fit_rows(model, rows, features, target, seed, (params or {}).get(model))

    try:
        fitted = side_by_side(train.sparkSession, fit, models, len(models))
        return dict(zip(models, fitted))
    finally:
        rows.unpersist()


def evaluate_baselines(split: Split, target: str = TARGET) -> DataFrame:
    """Error measures of the three baselines on the test rows."""
    return regression_metrics(with_baselines(split.with_labels(target)), target, BASELINE_COLUMNS)


def evaluate_models(
    split: Split,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    params: dict | None = None,
    seed: int = SEED,
    models: Sequence[str] = TREE_MODELS,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Error measures of all six forecasts, and the fitted tree models.

    The fitted models add their forecasts to the baselines' rows one projection after the
    other; a single aggregate then measures them all.
    """
    split = split.with_labels(target)
    fitted = fit_all(split.train, features, target, params, seed, models)
    rows = with_baselines(split)
    for name, model in fitted.items():
        rows = with_prediction(rows, model, features, f"pred_{name}")
    columns = {**BASELINE_COLUMNS, **{m: f"pred_{m}" for m in fitted}}
    ordered = {m: columns[m] for m in (*MODELS, *KEYED_MODELS) if m in columns}
    return regression_metrics(rows, target, ordered), fitted
