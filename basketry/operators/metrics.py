"""Forecast errors and the choice of the best model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketry.settings import MODELS


def _error_struct(model: str, y: Column, y_hat: Column) -> Column:
    error = y - y_hat
    n = F.count(y)
    sse = F.sum(error * error)
    # A constant target has no variance to explain: 1 for an exact forecast, else 0.
    # (regr_r2 is a squared correlation and would not notice a wrong scale.)
    r2 = F.when(
        F.min(y) == F.max(y), F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    ).otherwise(F.lit(1.0) - F.try_divide(sse, F.var_pop(y) * n))
    return F.struct(
        F.lit(model).alias("model"),
        n.alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.when(y != 0, F.abs(error) / F.abs(F.nullif(y, F.lit(0.0))))) * 100).alias("mape"),
        F.when(n > 1, r2).alias("r2"),
    )


def regression_metrics(
    df: DataFrame, target: str, predictions: dict[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE, MAPE (over non-zero actuals, null without one) and R2 per model.

    ``predictions`` maps a model name to its prediction column. All models share one pass
    and one partial aggregate over the wide rows; the rows are not multiplied by model.
    """
    y = F.col(target).cast("double")
    structs = [_error_struct(m, y, F.col(c).cast("double")) for m, c in predictions.items()]
    packed = df.groupBy(*by).agg(F.array(*structs).alias("m"))
    return packed.select(*by, F.inline("m"))


def regression_metrics_long(
    df: DataFrame, y: str = "y", y_hat: str = "y_hat", by: Sequence[str] = ("model",)
) -> DataFrame:
    """The same measures for rows of (keys, actual, forecast)."""
    struct = _error_struct("", F.col(y).cast("double"), F.col(y_hat).cast("double"))
    packed = df.groupBy(*by).agg(struct.alias("m"))
    return packed.select(*by, "m.n", "m.mae", "m.rmse", "m.mape", "m.r2")


def listing_order(model: Column, names: Sequence[str] = MODELS) -> Column:
    """Position of a model in the listing; unknown names come last."""
    place = F.array_position(F.lit(list(names)), model)
    return F.when(place > 0, place).otherwise(F.lit(len(names) + 1))


def best_model(
    metrics: DataFrame, among: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Lowest MAE; a missing MAE counts as infinite and ties keep the listing order."""
    pool = metrics if among is None else metrics.where(F.col("model").isin(*among))
    rank = F.struct(
        F.coalesce("mae", F.lit(float("inf"))), listing_order(F.col("model")), F.col("model")
    )
    return pool.groupBy(*by).agg(
        F.min_by("model", rank).alias("model"), F.min_by("mae", rank).alias("mae")
    )
