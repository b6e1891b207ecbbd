"""Exploratory profile of the cleaned events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from basketry import scratch
from basketry.functions.cells import utc_day, utc_hour
from basketry.settings import EVENT_TYPES


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("events"))


def event_funnel(events: DataFrame) -> DataFrame:
    """The four funnel steps in order, zero when a step has no event."""
    steps = [F.count_if(F.col("event_type") == t) for t in EVENT_TYPES]
    rows = [
        F.struct(F.lit(i).alias("step"), F.lit(t).alias("event_type"), n.alias("events"))
        for i, (t, n) in enumerate(zip(EVENT_TYPES, steps), start=1)
    ]
    return events.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def daily_volume(events: DataFrame) -> DataFrame:
    return events.groupBy(utc_day(F.col("event_time")).alias("date")).agg(F.count("*").alias("events"))


def hourly_volume(events: DataFrame) -> DataFrame:
    """Events per UTC hour of the day."""
    return events.groupBy(utc_hour(F.col("event_time")).alias("hour")).agg(F.count("*").alias("events"))


def top_viewed(events: DataFrame, n: int = 20) -> DataFrame:
    """Most viewed products; equal counts go by product id."""
    views = events.where(F.col("event_type") == "view")
    counted = views.groupBy("product_id").agg(F.count("*").alias("views"))
    return counted.orderBy(F.desc("views"), "product_id").limit(n)


def _distinct(events: DataFrame, column: str, name: str) -> DataFrame:
    return events.select(column).distinct().agg(F.count(column).alias(name))


def eda_summary(events: DataFrame, n: int = 20) -> DataFrame:
    """One row: size, time range, distinct products and users, type counts, funnel, top views.

    Two scans: one counts by (product, type), and from that small table, written once, come
    size, range, types, products and top list; the other counts users. The parts come down to
    single rows, which are stacked and folded instead of being joined.
    """
    counted = scratch.materialise(
        events.groupBy("product_id", "event_type").agg(
            F.count("*").alias("n"),
            F.min("event_time").alias("first"),
            F.max("event_time").alias("last"),
        ),
        "profile",
    )
    types = counted.groupBy("event_type").agg(
        F.sum("n").alias("events"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    viewed = counted.where("event_type = 'view'").select("product_id", F.col("n").alias("views"))
    most = viewed.orderBy(F.desc("views"), "product_id").limit(n)

    def step(event_type: str):
        found = F.sum(F.when(F.col("event_type") == event_type, F.col("events")))
        return F.coalesce(found, F.lit(0).cast("long")).alias(event_type)

    whole = types.agg(
        F.sum("events").alias("rows"),
        F.min("first").alias("date_min"),
        F.max("last").alias("date_max"),
        F.map_from_entries(F.collect_list(F.struct("event_type", "events"))).alias("event_counts"),
        F.struct(*[step(t) for t in EVENT_TYPES]).alias("funnel"),
    )
    ranked = F.sort_array(
        F.collect_list(F.struct((-F.col("views")).alias("order"), "product_id", "views"))
    )
    top = most.agg(
        F.transform(ranked, lambda r: F.struct(r["product_id"], r["views"])).alias(
            "top_viewed_products"
        )
    )
    parts = (
        whole,
        _distinct(counted, "product_id", "unique_products"),
        _distinct(events, "user_id", "unique_users"),
        top,
    )
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
