"""Looking at the errors of one model. A residual is actual minus predicted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketry.settings import MODELS, TARGET

ACTIVITY_LABELS = ("low_views", "medium_views", "high_views")


def _residual(target: str, prediction: str) -> Column:
    return F.col(target).cast("double") - F.col(prediction).cast("double")


def pred_vs_actual(
    df: DataFrame, model_name: str, target: str = TARGET, prediction: str = "prediction"
) -> DataFrame:
    return df.select(
        F.lit(model_name).alias("model_name"),
        F.col(target).cast("double").alias("y"),
        F.col(prediction).cast("double").alias("y_hat"),
    )


def residual_summary(
    df: DataFrame,
    model_name: str,
    split_name: str,
    target: str = TARGET,
    prediction: str = "prediction",
) -> DataFrame:
    r = _residual(target, prediction)
    return df.agg(
        F.lit(model_name).alias("model_name"),
        F.lit(split_name).alias("split"),
        F.count("*").alias("n_test"),
        F.avg(F.abs(r)).alias("mae"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        F.avg(r).alias("mean_residual"),
    )


def residual_histogram(
    df: DataFrame, bins: int = 80, target: str = TARGET, prediction: str = "prediction"
) -> DataFrame:
    """Counts in ``bins`` equal-width bins; the last one is closed on both sides, empty ones stay.

    A bin is found by division and then moved by one where rounding put a value on the wrong
    side of its edge. Equal residuals give a range of one around their value.
    """
    residuals = df.select(_residual(target, prediction).alias("r")).dropna()
    low, high = residuals.agg(F.min("r"), F.max("r")).first()
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins

    def edge(i: Column) -> Column:
        inner = F.lit(low) + i * F.lit(step)
        return F.when(i == bins, F.lit(high)).otherwise(inner)

    r = F.col("r")
    guess = F.least(F.floor((r - F.lit(low)) / F.lit(step)), F.lit(bins - 1))
    moved = (
        F.when(r < edge(guess), guess - 1)
        .when((r >= edge(guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    counted = residuals.groupBy(moved.alias("bin")).agg(F.count("*").alias("residuals"))
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return grid.join(counted, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("bin_start"),
        edge(F.col("bin") + 1).alias("bin_end"),
        F.coalesce("residuals", F.lit(0).cast("long")).alias("residuals"),
    )


def activity_quantiles(df: DataFrame, q: Sequence[float] = (0.33, 0.66)) -> tuple[list, float]:
    """Exact quantiles of ``views`` by linear interpolation, and the largest value.

    Rows are first counted per distinct value. The distinct counts of E events number at
    most about sqrt(2E) (1.4 million for 10^12 events), so the closing aggregate stays
    small however many rows there are and however often one value repeats.
    """
    counted = df.dropna(subset=["views"]).groupBy("views").agg(F.count("*").alias("n"))
    row = counted.agg(F.percentile("views", list(q), F.col("n")).alias("q"), F.max("views")).first()
    return row[0], row[1]


def error_by_activity(
    df: DataFrame,
    q: Sequence[float] = (0.33, 0.66),
    target: str = TARGET,
    prediction: str = "prediction",
) -> DataFrame:
    """Mean absolute error of the rows with few, medium and many views; empty groups vanish."""
    cuts, top = activity_quantiles(df, q)
    if cuts is None:
        cuts, top = [0.0, 0.0], 0
    views = F.col("views")
    group = (
        F.when((views > -0.1) & (views <= cuts[0]), ACTIVITY_LABELS[0])
        .when((views > cuts[0]) & (views <= cuts[1]), ACTIVITY_LABELS[1])
        .when((views > cuts[1]) & (views <= top + 1), ACTIVITY_LABELS[2])
    )
    error = F.abs(_residual(target, prediction))
    return (
        df.groupBy(group.alias("activity"))
        .agg(F.count("*").alias("n"), F.avg(error).alias("mae"))
        .where(F.col("activity").isNotNull())
    )


def experiment_comparison(
    results: DataFrame, experiments: Sequence[str], models: Sequence[str] = MODELS
) -> DataFrame:
    """MAE per model (rows) and experiment (columns); a missing pair is null."""
    return (
        results.where(F.col("model").isin(*models))
        .groupBy("model")
        .pivot("experiment", list(experiments))
        .agg(F.first("mae"))
    )
