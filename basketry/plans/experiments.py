"""Experiments: split, fit, measure, pick the model to serve."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketry.operators.attribution import attribution, attribution_sample, background_rows
from basketry.operators.metrics import listing_order
from basketry.operators.models import evaluate_baselines, evaluate_models
from basketry.operators.splits import Calendar, Split, labelled, split_boundary, split_first_n
from basketry.operators.tuning import SearchResult
from basketry.settings import (
    ATTRIBUTION_BACKGROUND,
    ATTRIBUTION_ROWS,
    EXPERIMENTS,
    FEATURES,
    MODELS,
    SEED,
    TARGET,
    TREE_MODELS,
)
from basketry.sources import tables

log = logging.getLogger(__name__)

RESULT_COLUMNS = (
    "experiment string, tuned boolean, model string, n long, mae double, rmse double, "
    "mape double, r2 double, train_dates array<date>, test_dates array<date>, "
    "train_rows long, test_rows long, is_best boolean"
)


@dataclass
class ExperimentRun:
    """Results table, fitted models per experiment, and the model chosen for serving."""

    results: DataFrame
    fitted: dict[str, dict[str, PipelineModel]]
    skipped: dict[str, str] = field(default_factory=dict)
    serving: dict | None = None
    attribution: DataFrame | None = None

    @property
    def serving_model(self) -> PipelineModel | None:
        if self.serving is None:
            return None
        return self.fitted[self.serving["experiment"]][self.serving["model_name"]]


def make_split(gold: DataFrame, config: dict, calendar: Calendar | None = None) -> Split:
    return (split_boundary if "train_end" in config else split_first_n)(gold, **config, calendar=calendar)


def best_name(metrics: dict[str, float | None], among: Sequence[str] = MODELS) -> str:
    """Name with the least MAE; ``metrics`` holds one number per model."""
    worst = float("inf")
    pool = [m for m in among if m in metrics]
    return min(pool, key=lambda m: worst if metrics[m] is None else metrics[m])


def _result_rows(label: str, tuned: bool, split: Split, metrics: list) -> list[tuple]:
    best = best_name({r["model"]: r["mae"] for r in metrics}, [r["model"] for r in metrics])
    return [
        (label, tuned, *(r[c] for c in ("model", "n", "mae", "rmse", "mape", "r2")))
        + (split.train_dates, split.test_dates, split.train_rows, split.test_rows)
        + (r["model"] == best,)
        for r in metrics
    ]


def baseline_results(gold: DataFrame, configs: dict[str, dict], target: str = TARGET) -> DataFrame:
    """Results table of the baselines alone: one aggregate per experiment, nothing collected."""
    rows = labelled(gold, target)
    calendar = Calendar.of(rows)
    frames = []
    for label, config in configs.items():
        split = make_split(rows, config, calendar)
        frames.append(
            evaluate_baselines(split, target).select(
                F.lit(label).alias("experiment"),
                F.lit(False).alias("tuned"),
                "*",
                F.lit(split.train_dates).alias("train_dates"),
                F.lit(split.test_dates).alias("test_dates"),
                F.lit(split.train_rows).cast("long").alias("train_rows"),
                F.lit(split.test_rows).cast("long").alias("test_rows"),
            )
        )
    # a window over a handful of models per experiment
    order = Window.partitionBy("experiment").orderBy(
        F.coalesce("mae", F.lit(float("inf"))), listing_order(F.col("model"))
    )
    results = reduce(DataFrame.unionByName, frames)
    return results.withColumn("is_best", F.row_number().over(order) == 1)


def _serving(
    label: str, tuned: bool, metrics: list, params: dict | None, config: dict, features, target: str
) -> dict:
    errors = {r["model"]: r["mae"] for r in metrics}
    name = best_name(errors, TREE_MODELS)
    return {
        "model_name": name,
        "overall_best_by_mae": best_name(errors),
        "experiment": label,
        "tuned": tuned,
        "mae": errors[name],
        "params": (params or {}).get(name),
        "feature_columns": list(features),
        "target": target,
        **{k: config[k] for k in ("train_end", "test_start", "test_days") if k in config},
    }


def run_experiments(
    gold: DataFrame,
    configs: dict[str, dict] = EXPERIMENTS,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    params: dict | None = None,
    tuned_params: dict | None = None,
    seed: int = SEED,
    models: Sequence[str] = TREE_MODELS,
    attribute: str | None = None,
    attribution_rows: int = ATTRIBUTION_ROWS,
    background: int = ATTRIBUTION_BACKGROUND,
) -> ExperimentRun:
    """Run every experiment on ``gold``, which should be a written table: it is read often.

    A boundary experiment whose dates are missing is skipped with a message. With
    ``tuned_params`` only ``e_final`` runs, under those parameters, and missing dates are an
    error. The model to serve is the best tree of ``e_final``, or of ``e1`` without it. With
    ``attribute`` that tree's forecasts in the same experiment are broken down by feature.
    """
    spark: SparkSession = gold.sparkSession
    rows = labelled(gold, target)
    calendar = Calendar.of(rows)
    tuned = tuned_params is not None
    chosen = {"e_final": configs["e_final"]} if tuned else configs
    run = ExperimentRun(spark.createDataFrame([], RESULT_COLUMNS), {})
    table: list[tuple] = []
    measured: dict[str, list] = {}
    cut: dict[str, Split] = {}
    for name, config in chosen.items():
        try:
            split = make_split(rows, config, calendar)
        except ValueError as problem:
            if tuned or "train_end" not in config:
                raise
            log.warning("skipping %s: %s", name, problem)
            run.skipped[name] = str(problem)
            continue
        label = f"{name}_tuned" if tuned else name
        metrics, fitted = evaluate_models(
            split, features, target, tuned_params if tuned else params, seed, models
        )
        measured[label] = metrics.collect()
        cut[label] = split
        run.fitted[label] = fitted
        table += _result_rows(label, tuned, split, measured[label])

    run.results = spark.createDataFrame(table, RESULT_COLUMNS)
    for label in ("e_final_tuned", "e_final", "e1"):
        if label in measured and any(m in run.fitted[label] for m in TREE_MODELS):
            config = chosen[label.removesuffix("_tuned")]
            run.serving = _serving(
                label, tuned, measured[label], tuned_params if tuned else params, config, features, target
            )
            if label == "e1" and "e_final" in chosen:
                run.serving["note"] = "served from e1, as the days of e_final are not there"
            if attribute in run.fitted[label]:
                run.attribution = attribution(
                    run.fitted[label][attribute],
                    attribution_sample(cut[label].test, attribution_rows, seed),
                    background_rows(cut[label].train, background, seed + 1),
                    features,
                )
            break
    return run


def save_run(run: ExperimentRun, root: str, log_path: str | None = None) -> None:
    """Results, every fitted model, attribution, and the record of the model to serve, below ``root``."""
    tables.write_results(run.results, f"{root}/results")
    if run.attribution is not None:
        run.attribution.write.mode("overwrite").parquet(f"{root}/attribution")
    if log_path is not None:
        rows = run.results.select("experiment", "tuned", "model", "mae", "is_best")
        tables.append_run_log(rows, log_path, "train")
    for label, models in run.fitted.items():
        for name, model in models.items():
            tables.save_model(model, f"{root}/models/{label}/{name}")
    if run.serving is not None:
        record = json.dumps(run.serving, default=str)
        spark = run.results.sparkSession
        row = [(run.serving["model_name"], record)]
        served = spark.createDataFrame(row, "model string, info string")
        tables.write_profile(served, f"{root}/serving")


def load_serving(spark: SparkSession, root: str) -> dict:
    """The record of the model to serve: name, experiment, features, target, parameters."""
    return json.loads(spark.read.json(f"{root}/serving").first()["info"])


def save_search(found: SearchResult, root: str, log_path: str | None = None) -> None:
    """All trials with their fold errors, the best one of each model marked."""
    found.trials.write.mode("overwrite").parquet(f"{root}/search")
    if log_path is not None:
        rows = found.trials.select("model", "trial", "params", "cv_mae", "is_best")
        tables.append_run_log(rows, log_path, "tune")


def load_best_params(spark: SparkSession, root: str) -> dict[str, dict]:
    """Best parameters of each model from a saved search, as ``tuned_params`` of a run."""
    best = spark.read.parquet(f"{root}/search").where("is_best").collect()
    return {r["model"]: json.loads(r["params"]) for r in best}
