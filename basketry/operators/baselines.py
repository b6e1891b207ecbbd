"""Forecasts that need no fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from basketry.operators.daily import series
from basketry.operators.splits import Split
from basketry.settings import TARGET

BASELINE_COLUMNS = {"lag1": "pred_lag1", "ma7": "pred_ma7", "hist_mean": "pred_hist_mean"}

_LAST_SEVEN = (-6, Window.currentRow)


def with_lag1(daily: DataFrame) -> DataFrame:
    """Tomorrow is forecast as today."""
    return daily.withColumn("pred_lag1", F.col("purchases"))


def with_ma7(daily: DataFrame) -> DataFrame:
    """Mean purchases of the last seven active days including today."""
    return daily.withColumn("pred_ma7", F.avg("purchases").over(series().rowsBetween(*_LAST_SEVEN)))


def add_baselines(daily: DataFrame) -> DataFrame:
    return with_ma7(with_lag1(daily))


def product_means(train: DataFrame, column: str = "purchases") -> DataFrame:
    """Training mean per product: the table form of the historical-mean model."""
    return train.groupBy("product_id").agg(F.avg(column).alias("mean"))


def historical_mean(train: DataFrame, test: DataFrame, column: str = "purchases") -> DataFrame:
    """Add each product's training mean to ``test``; products unseen in training get 0.

    The means hold one row per product and are left to Spark to broadcast or shuffle by
    their size.
    """
    means = product_means(train, column).withColumnRenamed("mean", "pred_hist_mean")
    joined = test.join(means, "product_id", "left")
    return joined.withColumn("pred_hist_mean", F.coalesce("pred_hist_mean", F.lit(0.0)))


def with_baselines(split: Split) -> DataFrame:
    """All test rows and columns, with the three baseline forecasts.

    The moving average runs over training and test rows together; the mean looks at the
    training rows only. Both are windows over the same product partitions, so one shuffle
    and one sort serve all three, and no join leads back to the test rows.
    """
    product = Window.partitionBy("product_id")
    forecasts = split.both.withColumns(
        {
            "pred_lag1": F.col("purchases").cast("double"),
            "pred_ma7": F.avg("purchases").over(series().rowsBetween(*_LAST_SEVEN)),
            "pred_hist_mean": F.avg(F.when(~F.col("is_test"), F.col("purchases"))).over(product),
        }
    )
    tested = forecasts.where("is_test").drop("is_test")
    return tested.fillna(0.0, subset=list(BASELINE_COLUMNS.values()))


def baseline_predictions(split: Split, target: str = TARGET) -> DataFrame:
    """Test keys, the actual value ``y`` and the three forecasts."""
    return with_baselines(split).select(
        "product_id",
        "date",
        F.col(target).cast("double").alias("y"),
        *BASELINE_COLUMNS.values(),
    )
