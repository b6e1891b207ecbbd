"""Expanding-window folds over rows in date order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.ordering import nth_smallest

FOLD_COLUMN = "test_fold"


def _boundaries(df: DataFrame, n_splits: int) -> list[tuple]:
    """The (date, product_id) key of the first row of each fold's test slice."""
    days = sorted(
        df.groupBy("date")
        .agg(
            F.count("*").alias("n"),
            F.min("product_id").alias("low"),
            F.max("product_id").alias("high"),
        )
        .collect(),
        key=lambda r: r["date"],
    )
    total = sum(r["n"] for r in days)
    size = total // (n_splits + 1)
    if size == 0:
        raise ValueError(f"Cannot have {n_splits + 1} folds with {total} rows")
    starts = [total - (n_splits - i) * size for i in range(n_splits)]
    wanted: dict = {}
    places = []
    for start in starts:
        before = 0
        for day in days:
            if start < before + day["n"]:
                wanted.setdefault(day["date"], set()).add(start - before)
                places.append((day["date"], start - before))
                break
            before += day["n"]
    low, high = min(r["low"] for r in days), max(r["high"] for r in days)
    found = nth_smallest(df, "date", "product_id", wanted, low, high)
    return [(date, found[date][rank]) for date, rank in places]


def time_folds(df: DataFrame, n_splits: int = 3, by_date: bool = False) -> DataFrame:
    """Mark each row with the fold that tests on it, -1 for rows that only ever train.

    With the rows in (date, product_id) order and ``size = n // (n_splits + 1)``, the last
    ``n_splits * size`` rows form the test slices; fold ``i`` trains on every row before its
    slice, so it trains on ``test_fold < i`` and tests on ``test_fold == i``. ``by_date=True``
    counts distinct dates instead of rows and keeps a day in one piece.

    Only the ``n_splits`` boundary keys are looked up; the rows themselves are compared with
    them in a projection, so they are neither sorted, numbered nor shuffled.
    """
    if by_date:
        dates = sorted(r["date"] for r in df.select("date").distinct().collect())
        size = len(dates) // (n_splits + 1)
        if size == 0:
            raise ValueError(f"Cannot have {n_splits + 1} folds with {len(dates)} dates")
        starts = [dates[len(dates) - (n_splits - i) * size] for i in range(n_splits)]
        passed = [F.col("date") >= F.lit(d) for d in starts]
    else:
        passed = [
            (F.col("date") > F.lit(d)) | ((F.col("date") == F.lit(d)) & (F.col("product_id") >= p))
            for d, p in _boundaries(df, n_splits)
        ]
    fold = F.lit(-1)
    for test in passed:
        fold = fold + test.cast("int")
    return df.withColumn(FOLD_COLUMN, fold)
