"""A saved run's served model, looked at on the test window of its experiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry import scratch
from basketry.operators import residuals
from basketry.operators.scoring import with_prediction
from basketry.operators.splits import Calendar, labelled
from basketry.plans.experiments import load_serving, make_split
from basketry.settings import EXPERIMENTS
from basketry.sources import tables


def analyse(
    gold: DataFrame,
    root: str,
    configs: dict[str, dict] = EXPERIMENTS,
    log_path: str | None = None,
    max_pairs: int | None = None,
) -> dict[str, DataFrame]:
    """Write and return summary, histogram, activity errors, pairs and comparison of a saved run.

    The window is that of the experiment the model was served from: ``e_final``, or ``e1`` where
    the days of ``e_final`` are missing. The forecasts are written once and read by every report.
    """
    spark = gold.sparkSession
    info = load_serving(spark, root)
    label, name, target = info["experiment"], info["model_name"], info["target"]
    rows = labelled(gold, target)
    split = make_split(rows, configs[label.removesuffix("_tuned")], Calendar.of(rows))
    model = tables.load_model(f"{root}/models/{label}/{name}")
    scored = with_prediction(split.test, model, info["feature_columns"])
    scored = scratch.materialise(scored.select("product_id", "date", target, "prediction", "views"), "scored")
    results = tables.read_results(spark, f"{root}/results")
    found = [r[0] for r in results.select("experiment").distinct().collect()]
    pairs = residuals.pred_vs_actual(scored, name, target)
    reports = {
        "summary": residuals.residual_summary(scored, name, label, target),
        "histogram": residuals.residual_histogram(scored, target=target),
        "activity": residuals.error_by_activity(scored, target=target),
        "pairs": pairs if max_pairs is None else pairs.limit(max_pairs),
        "comparison": residuals.experiment_comparison(results, sorted(found)),
    }
    written = {}
    for report, frame in reports.items():
        frame.write.mode("overwrite").parquet(f"{root}/analysis/{report}")
        written[report] = spark.read.parquet(f"{root}/analysis/{report}")
    if log_path is not None:
        summary = written["summary"].select(F.lit(root).alias("run"), "*")
        tables.append_run_log(summary, log_path, "analyze")
    return written
