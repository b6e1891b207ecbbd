"""Batch scoring: lookups by key, top products, top forecasts.

A scorer is a fitted pipeline model, a column expression, or ``None`` for the lag-1
fallback, so every report works with any of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.settings import FEATURES, NO_DATA, NO_GOLD, NO_VIEWS, TARGET

Scorer = PipelineModel | Column | None


def with_prediction(
    df: DataFrame,
    scorer: Scorer = None,
    features: Sequence[str] = FEATURES,
    name: str = "prediction",
) -> DataFrame:
    """Add the forecast; missing features score as 0 but stay missing in the output."""
    kept = {f"_raw_{c}": F.col(c) for c in features}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features}
    ready = df.withColumns(kept).withColumns(filled)
    if scorer is None:
        scored = ready.withColumn(name, F.col("purchases"))
    elif isinstance(scorer, Column):
        scored = ready.withColumn(name, scorer.cast("double"))
    else:
        scored = scorer.transform(ready).withColumnRenamed("prediction", name)
    return scored.withColumns({c: F.col(f"_raw_{c}") for c in features}).select(*df.columns, name)


def _answer(prediction: Column, actual: str = TARGET) -> list[Column]:
    actual = F.col(actual).cast("double")
    return [
        prediction.alias("predicted_purchases_next_day"),
        actual.alias("actual_purchases_next_day"),
        (prediction - actual).alias("prediction_error"),
    ]


def score(
    gold: DataFrame,
    requests: DataFrame,
    scorer: Scorer = None,
    model_name: str = "lag1",
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """Forecast for each requested ``(product_id, date)``; the date is ``yyyy-MM-dd`` text.

    A key without a gold row keeps its request, gets 0 and a note. Gold is first cut down to
    the distinct requested keys by a semi join, each key is scored once however often it is
    asked for, and the answers are joined back. Whether a side is broadcast, which days are
    read and how a hot key is cut up is left to Spark and what it learns at run time.
    """
    asked = F.col("date")
    day = F.when(
        asked.rlike(r"^\d{4}-\d{2}-\d{2}$"),
        F.to_date(F.try_to_timestamp(asked, F.lit("yyyy-MM-dd"))),
    )
    keyed = requests.select("*", day.alias("_day"))
    keys = keyed.select("product_id", F.col("_day").alias("date")).dropna().distinct()
    hits = gold.join(keys, ["product_id", "date"], "left_semi")
    scored = with_prediction(hits, scorer, features).select(
        "product_id",
        F.col("date").alias("_day"),
        "prediction",
        F.col(TARGET).alias("_actual"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_used_{c}") for c in features],
    )
    found = F.col("prediction").isNotNull()
    used = F.create_map(*[p for c in features for p in (F.lit(c), F.col(f"_used_{c}"))])
    nothing = F.create_map().cast("map<string,double>")
    return keyed.join(scored, ["product_id", "_day"], "left").select(
        *requests.columns,
        *_answer(F.when(found, F.col("prediction")).otherwise(F.lit(0.0)), "_actual"),
        F.lit(model_name).alias("model_used"),
        F.when(found, used).otherwise(nothing).alias("features_used"),
        F.when(~found, F.lit(NO_DATA)).alias("note"),
    )


def top_products(gold: DataFrame, limit: int = 20) -> DataFrame:
    """Products by total purchases; equal totals go by product id."""
    totals = gold.groupBy("product_id").agg(F.sum("purchases").alias("total_purchases"))
    return totals.orderBy(F.desc("total_purchases"), "product_id").limit(limit)


def gold_date_range(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.date_format(F.min("date"), "yyyy-MM-dd").alias("min_date"),
        F.date_format(F.max("date"), "yyyy-MM-dd").alias("max_date"),
    )


def _on_date(date: str) -> Column:
    """Rows of a ``yyyy-MM-dd`` date; no other spelling matches any row."""
    try:
        day = dt.date.fromisoformat(date)
    except ValueError:
        return F.lit(False)
    return F.col("date") == F.lit(day) if day.isoformat() == date else F.lit(False)


def _busy_enough(min_views: float) -> Column:
    if min_views > 0:
        return F.coalesce("views", F.lit(0)) >= F.lit(min_views)
    return F.lit(True)


def top_predicted(
    gold: DataFrame,
    date: str,
    scorer: Scorer = None,
    limit: int = 10,
    min_views: float = 0.0,
    model_name: str = "lag1",
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """The ``limit`` highest forecasts for one gold date; ties go by product id.

    Each task keeps its own best ``limit`` rows, and the closing rank is a window over those
    that are left, in one task: ``limit`` is meant for reports, not for whole days.
    """
    if limit < 1:
        raise ValueError(f"a report needs at least one row; got limit {limit}")
    day = gold.where(_on_date(date) & _busy_enough(min_views))
    scored = with_prediction(day, scorer, features)
    best = scored.orderBy(F.desc("prediction"), "product_id").limit(limit)
    rank = F.row_number().over(Window.orderBy(F.desc("prediction"), "product_id"))
    return best.select(
        F.lit(date).alias("date"),
        rank.alias("rank"),
        "product_id",
        *_answer(F.col("prediction").cast("double")),
        F.col("purchases").cast("double").alias("purchases"),
        F.col("views").cast("double").alias("views"),
        F.lit(model_name).alias("model_used"),
    )


def top_predicted_status(gold: DataFrame, date: str, min_views: float = 0.0) -> DataFrame:
    """One row that says whether ``top_predicted`` has anything to rank, and if not, why.

    The counts read the one day and the range reads dates only; both are single rows, which
    are stacked and folded together.
    """
    day = gold.where(_on_date(date)).agg(
        F.count("*").alias("rows_on_date"), F.count_if(_busy_enough(min_views)).alias("rows_kept")
    )
    stacked = day.unionByName(gold_date_range(gold), allowMissingColumns=True)
    folded = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
    return folded.select(
        F.lit(date).alias("date"),
        "rows_on_date",
        "rows_kept",
        F.when(F.col("rows_on_date") == 0, NO_GOLD.format(date=date))
        .when(F.col("rows_kept") == 0, NO_VIEWS.format(views=min_views, date=date))
        .alias("note"),
        "min_date",
        "max_date",
    )
