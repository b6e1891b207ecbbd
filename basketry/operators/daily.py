"""Product-day table: counts per active day, next-day target and trailing sums."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.settings import COUNT_COLUMNS, ROLLED_COLUMNS, ROLLING_WINDOW, TARGET


def _is_type(event_type: str) -> Column:
    return F.col("event_type") == F.lit(event_type)


def product_day_counts(events: DataFrame, extra_types: Iterable[str] = ()) -> DataFrame:
    """Events of each type per product and active day; absent types count zero.

    One hash aggregate with map-side partial counts, so a hot product sends one row per
    task and day. ``extra_types`` adds a column named after each further event type.
    """
    counts = [F.count_if(_is_type(t)).alias(name) for t, name in COUNT_COLUMNS.items()]
    counts += [F.count_if(_is_type(t)).alias(t) for t in extra_types]
    return events.groupBy("product_id", "date").agg(*counts)


def series() -> Window:
    """A product's days in order. At most one row per day, so no partition grows with traffic."""
    return Window.partitionBy("product_id").orderBy("date")


def with_next_day_target(daily: DataFrame) -> DataFrame:
    """Purchases of the product's next active day; null on its last one."""
    return daily.withColumn(TARGET, F.lead("purchases", 1).over(series()))


def with_trailing_sums(daily: DataFrame, window: int = ROLLING_WINDOW) -> DataFrame:
    """Sums over the last ``window`` active days including the current one."""
    frame = series().rowsBetween(-(window - 1), Window.currentRow)
    return daily.withColumns({f"{c}_{window}d": F.sum(c).over(frame) for c in ROLLED_COLUMNS})


def _calendar_features(daily: DataFrame, window: int) -> DataFrame:
    # One day-number order serves the lead and the value range, so the series is sorted
    # once. Empty days need no rows of their own: they add zero to a sum, and a gap
    # before the next active day means that tomorrow had no purchase.
    day = F.unix_date("date")
    order = Window.partitionBy("product_id").orderBy(day)
    frame = order.rangeBetween(-(window - 1), Window.currentRow)
    next_day = F.lead(day, 1).over(order)
    target = F.when(next_day == day + 1, F.lead("purchases", 1).over(order)).when(
        next_day.isNotNull(), F.lit(0).cast("long")
    )
    sums = {f"{c}_{window}d": F.sum(c).over(frame) for c in ROLLED_COLUMNS}
    return daily.withColumns({TARGET: target, **sums})


def product_by_day(
    events: DataFrame,
    window: int = ROLLING_WINDOW,
    calendar: bool = False,
    extra_types: Iterable[str] = (),
) -> DataFrame:
    """The modelling table: daily counts, next-day target, trailing sums.

    Target and sums count active days (rows). ``calendar=True`` reads them as calendar
    days instead: purchases on ``date + 1`` and sums over ``window`` calendar days.

    The aggregate shuffles on (product, date), which spreads a hot product over its days;
    the window then shuffles the far smaller daily rows on product and sorts them once.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    daily = product_day_counts(events, extra_types)
    if calendar:
        return _calendar_features(daily, window)
    return with_trailing_sums(with_next_day_target(daily), window)
