"""Parameter search over expanding time folds."""

from __future__ import annotations

import itertools
import json
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from basketry.jobs import side_by_side
from basketry.operators.folds import FOLD_COLUMN, time_folds
from basketry.operators.models import fit_rows, training_rows
from basketry.operators.splits import labelled
from basketry.settings import (
    FEATURES,
    SEARCH_DRAWS,
    SEARCH_FOLDS,
    SEARCH_SPACES,
    SEED,
    TARGET,
)


@dataclass(frozen=True)
class SearchResult:
    """Every trial as a table, and the best parameters of each model."""

    trials: DataFrame
    best: dict[str, dict]


def draw_params(space: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    """``n_iter`` different combinations of the space, repeatable for a seed."""
    grid = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(grid, min(n_iter, len(grid)))


def _fold_mae(model, params, rows, fold, features, target, seed) -> float:
    fitted = fit_rows(model, rows.where(F.col(FOLD_COLUMN) < fold), features, target, seed, params)
    tested = fitted.transform(rows.where(F.col(FOLD_COLUMN) == fold))
    return tested.agg(F.avg(F.abs(F.col(target) - F.col("prediction")))).first()[0]


def tune(
    train: DataFrame,
    spaces: dict[str, dict] = SEARCH_SPACES,
    n_iter: int = SEARCH_DRAWS,
    n_splits: int = SEARCH_FOLDS,
    seed: int = SEED,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    by_date: bool = False,
    parallelism: int = 4,
) -> SearchResult:
    """Mean MAE over the folds for each drawn parameter set; the least one wins per model.

    Fold ``i`` trains only on rows before its test slice, which MLlib's own cross
    validation would not do. The rows are prepared and persisted once for all fits, and a
    few fits run side by side so that small jobs do not leave executors idle.
    """
    folded = time_folds(labelled(train, target), n_splits, by_date)
    rows = training_rows(folded, features, target, keep=[FOLD_COLUMN])
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    trials = [
        (model, number, params)
        for model, space in spaces.items()
        for number, params in enumerate(draw_params(space, n_iter, seed))
    ]

    def run(trial) -> list[float]:
        model, _, params = trial
        return [
            _fold_mae(model, params, rows, fold, features, target, seed)
            for fold in range(n_splits)
        ]

    try:
        errors = side_by_side(train.sparkSession, run, trials, parallelism)
    finally:
        rows.unpersist()

    scored = [(*trial, sum(e) / len(e), e) for trial, e in zip(trials, errors)]
    best = {m: min((s for s in scored if s[0] == m), key=lambda s: s[3]) for m in spaces}
    table = train.sparkSession.createDataFrame(
        [
            (m, number, json.dumps(params, sort_keys=True), mae, folds, number == best[m][1])
            for m, number, params, mae, folds in scored
        ],
        "model string, trial int, params string, cv_mae double, fold_mae array<double>, "
        "is_best boolean",
    )
    return SearchResult(table, {m: s[2] for m, s in best.items()})
