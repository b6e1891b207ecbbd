"""Events and product days as unbounded streams whose state stays bounded.

``live_events`` cleans raw rows and drops copies that arrive within ``delay`` of each other, whichever
batches they are in; the state forgets a row when the watermark has passed it. ``live_product_days`` counts
per product and day natively, closes a day when the watermark has passed its end, and hands the closed
days of a product, one row each, to a small stateful operator: a ring of the last days. A row
leaves when the product's next active day closes, because only then its target is known.

Rows later than the watermark are dropped by Spark and counted; ``late_rows`` reports them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from basketry.operators import cleaning
from basketry.operators.daily import product_day_counts
from basketry.settings import COUNT_COLUMNS, EVENT_COLUMNS, ROLLED_COLUMNS, ROLLING_WINDOW, TARGET

DELAY = "2 days"

_COUNTS = tuple(COUNT_COLUMNS.values())
_DAY_SCHEMA = "date date, " + ", ".join(f"{c} long" for c in _COUNTS)
_CLOSING = "spark.sql.streaming.noDataMicroBatches.enabled"
_STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def live_events(bronze: DataFrame, delay: str = DELAY, valid_event_types=None) -> DataFrame:
    """Cleaned events of a raw stream, each copy within ``delay`` once."""
    rows = cleaning.normalise(bronze.select(*EVENT_COLUMNS), valid_event_types)
    fresh = rows.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(EVENT_COLUMNS))
    return cleaning.with_day(fresh)


class SeriesRing(StatefulProcessor):
    """The last days of a product. State: at most ``window`` rows for each product."""

    def __init__(self, window: int):
        self.window = window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getListState("days", _DAY_SCHEMA)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        """Closed days in; each gives the day before it its target."""
        ring = [tuple(r) for r in self.days.get()] if self.days.exists() else []
        closed = pd.concat(list(rows)).sort_values("date")
        done = []
        for day in closed[["date", *_COUNTS]].itertuples(index=False, name=None):
            if ring:
                done.append((key[0], *ring[-1], day[1 + _COUNTS.index("purchases")], *self._sums(ring)))
            ring = [*ring, (day[0], *(int(x) for x in day[1:]))][-self.window :]
        self.days.put(ring)
        if done:
            names = ["product_id", "date", *_COUNTS, TARGET, *(f"{c}_{self.window}d" for c in ROLLED_COLUMNS)]
            yield pd.DataFrame(done, columns=names)

    def _sums(self, ring: list[tuple]) -> list[int]:
        return [sum(day[1 + _COUNTS.index(c)] for day in ring) for c in ROLLED_COLUMNS]

    def close(self) -> None:
        pass


def product_day_schema(window: int = ROLLING_WINDOW) -> str:
    sums = ", ".join(f"{c}_{window}d long" for c in ROLLED_COLUMNS)
    return f"product_id long, {_DAY_SCHEMA}, {TARGET} long, {sums}"


def live_product_days(events: DataFrame, window: int = ROLLING_WINDOW) -> DataFrame:
    """Labelled rows of the product-day table from a stream of events with a watermark on ``event_time``.

    The same rows as the batch table has, but for those whose next active day is not closed yet.
    """
    span = F.window("event_time", "1 day")
    days = product_day_counts(events.drop("date").withColumn("date", span)).withColumn("date", F.to_date("date.start"))
    return days.groupBy("product_id").transformWithStateInPandas(
        SeriesRing(window), product_day_schema(window), outputMode="Append", timeMode="None"
    )


def start(rows: DataFrame, path: str, checkpoint: str, last: bool = True) -> StreamingQuery:
    """Append what is new to Parquet files at ``path`` and stop.

    What the watermark has passed is closed at the end. With ``last=False``, for a run that others follow, it is
    left to the next run's first batch, as between two batches of one run.
    """
    spark: SparkSession = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_PROVIDER)
    writer = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if last:
        return writer.start()
    closing = spark.conf.get(_CLOSING, "true")
    spark.conf.set(_CLOSING, "false")
    try:
        return writer.start()  # a query keeps the settings it was started with
    finally:
        spark.conf.set(_CLOSING, closing)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark in the progress Spark still remembers (its last 100 batches)."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"][:1]
    )
