"""Per-product summary table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.cells import utc_hour
from basketry.settings import EVENT_TYPES

_TOTALS = {
    "view": "total_views",
    "cart": "total_carts",
    "remove_from_cart": "total_removals",
    "purchase": "total_purchases",
}


def _totals() -> list:
    return [F.count_if(F.col("event_type") == t).alias(_TOTALS[t]) for t in EVENT_TYPES]


def product_counts(events: DataFrame) -> DataFrame:
    """Events of each type per product, for every product seen in any event."""
    return events.groupBy("product_id").agg(*_totals())


def with_rates(counts: DataFrame) -> DataFrame:
    """Cart and purchase rates; null when there is nothing to divide by."""
    return counts.withColumns(
        {
            "view_to_cart_rate": F.try_divide("total_carts", "total_views"),
            "cart_to_purchase_rate": F.try_divide("total_purchases", "total_carts"),
        }
    )


def product_rates(events: DataFrame) -> DataFrame:
    return with_rates(product_counts(events)).select(
        "product_id", "view_to_cart_rate", "cart_to_purchase_rate"
    )


def viewers(events: DataFrame) -> DataFrame:
    """Distinct and repeat viewers of each viewed product.

    The first count runs per (product, user), so a hot product is spread over its users
    and its shuffle carries each pair once per task; the second sees one row per pair.
    Both numbers come from that one intermediate, without a distinct aggregate.
    """
    pairs = (
        events.where(F.col("event_type") == "view")
        .groupBy("product_id", "user_id")
        .agg(F.count("*").alias("n"))
    )
    return pairs.groupBy("product_id").agg(
        F.count("*").alias("unique_viewers"),
        F.count_if(F.col("n") > 1).alias("repeat_viewers"),
    )


def _viewer_column(events: DataFrame, name: str) -> DataFrame:
    products = events.select("product_id").distinct()
    return products.join(viewers(events), "product_id", "left").select(
        "product_id", F.coalesce(name, F.lit(0).cast("long")).alias(name)
    )


def unique_viewers(events: DataFrame) -> DataFrame:
    return _viewer_column(events, "unique_viewers")


def repeat_viewers(events: DataFrame) -> DataFrame:
    return _viewer_column(events, "repeat_viewers")


def avg_purchase_price(events: DataFrame) -> DataFrame:
    """Mean price of a product's purchases; null when it has none."""
    return events.groupBy("product_id").agg(
        F.avg(F.when(F.col("event_type") == "purchase", F.col("price"))).alias("avg_purchase_price")
    )


def _hourly(events: DataFrame) -> DataFrame:
    """Everything the summary needs that adds up over the hours of the day."""
    bought = F.when(F.col("event_type") == "purchase", F.col("price"))
    return events.groupBy("product_id", utc_hour(F.col("event_time")).alias("hour")).agg(
        *_totals(), F.sum(bought).alias("spent")
    )


def _peak_hour():
    """Hour with most views, the earliest on a tie, null without views.

    Views and hour form one number to compare (hours are below 24); a struct would push the
    aggregate from hashing to sorting.
    """
    rank = F.when(F.col("total_views") > 0, F.col("total_views") * 24 - F.col("hour"))
    return F.max_by("hour", rank).alias("peak_view_hour")


def peak_view_hour(events: DataFrame) -> DataFrame:
    hourly = events.groupBy("product_id", utc_hour(F.col("event_time")).alias("hour")).agg(_totals()[0])
    return hourly.groupBy("product_id").agg(_peak_hour())


def product_summary(events: DataFrame) -> DataFrame:
    """The whole table in two passes over the events.

    The first counts per (product, hour) and folds the at most 24 rows of a product; the
    second reads only the views for the viewer counts. Both end partitioned by product,
    so the closing join adds no shuffle.
    """
    totals = _hourly(events).groupBy("product_id").agg(
        *[F.sum(name).alias(name) for name in _TOTALS.values()],
        F.sum("spent").alias("spent"),
        _peak_hour(),
    )
    zero = F.lit(0).cast("long")
    return with_rates(totals.join(viewers(events), "product_id", "left")).select(
        "product_id",
        *_TOTALS.values(),
        "view_to_cart_rate",
        "cart_to_purchase_rate",
        F.coalesce("unique_viewers", zero).alias("unique_viewers"),
        F.coalesce("repeat_viewers", zero).alias("repeat_viewers"),
        F.try_divide("spent", "total_purchases").alias("avg_purchase_price"),
        "peak_view_hour",
    )
