"""Time-ordered train/test splits."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from basketry.operators.daily import series
from basketry.settings import TARGET

LABEL_DATE = "label_date"


@dataclass(frozen=True)
class Split:
    """Two windows over one table; both sides stay lazy filters on it."""

    frame: DataFrame
    train_dates: list[dt.date]
    test_dates: list[dt.date]
    train_rows: int
    test_rows: int
    purge: bool = False

    def _between(self, dates: list[dt.date]):
        # Each side takes every distinct date between its first and its last, so a range
        # says the same as the list; it prunes day folders and row groups.
        return F.col("date").between(F.lit(dates[0]), F.lit(dates[-1]))

    @property
    def in_train(self):
        inside = self._between(self.train_dates)
        if self.purge:
            inside &= F.col(LABEL_DATE) < F.lit(self.test_dates[0])
        return inside

    @property
    def in_test(self):
        return self._between(self.test_dates)

    @property
    def train(self) -> DataFrame:
        return self.frame.where(self.in_train)

    @property
    def test(self) -> DataFrame:
        return self.frame.where(self.in_test)

    def with_labels(self, target: str = TARGET) -> Split:
        """The same windows without the rows that have no target."""
        return replace(self, frame=labelled(self.frame, target))

    @property
    def both(self) -> DataFrame:
        """Both sides in one scan, told apart by ``is_test``."""
        return self.frame.where(self.in_train | self.in_test).withColumn("is_test", self.in_test)


def labelled(gold: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows with a known target."""
    return gold.dropna(subset=[target])


def with_label_date(gold: DataFrame) -> DataFrame:
    """Add the day a row's target comes from; ``purge`` needs it. Apply before ``labelled``."""
    return gold.withColumn(LABEL_DATE, F.lead("date", 1).over(series()))


def split_calendar(df: DataFrame) -> DataFrame:
    """Distinct dates with their row and label counts. One row per day, whatever the data size."""
    label = F.count(TARGET) if TARGET in df.columns else F.count("*")
    return df.groupBy("date").agg(F.count("*").alias("rows"), label.alias("labelled_rows"))


@dataclass(frozen=True)
class Calendar:
    """The days of a table, in order, and how many labelled rows each has.

    One row per day comes to the driver. A table read for several splits needs it once.
    """

    days: list[dt.date]
    rows: list[int]

    @classmethod
    def of(cls, df: DataFrame) -> Calendar:
        found = sorted((r["date"], r["labelled_rows"]) for r in split_calendar(df).collect())
        return cls([d for d, _ in found], [n for _, n in found])

    def cut(self, df: DataFrame, train: range, test: range, purge: bool = False) -> Split:
        """Windows over the days at these positions, which must exist and follow each other."""
        for side, places in (("training", train), ("test", test)):
            there = len(range(len(self.days))[places.start : places.stop])
            if not places or there < len(places):
                raise ValueError(f"the {side} window has {there} days, not {max(1, len(places))}")
        if purge and LABEL_DATE not in df.columns:
            raise ValueError(f"purge needs the column {LABEL_DATE}; see with_label_date")
        windows = [[self.days[i] for i in places] for places in (train, test)]
        sizes = [sum(self.rows[i] for i in places) for places in (train, test)]
        split = Split(df, *windows, *sizes, purge)
        return replace(split, train_rows=split.train.count()) if purge else split


def split_first_n(
    df: DataFrame, train_days: int, test_days: int, calendar: Calendar | None = None
) -> Split:
    """The first ``train_days`` distinct dates train, the next ``test_days`` test."""
    calendar = calendar or Calendar.of(df)
    end = train_days + test_days
    return calendar.cut(df, range(train_days), range(train_days, end))


def _as_date(day: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def split_boundary(
    df: DataFrame,
    train_end: str | dt.date,
    test_start: str | dt.date,
    test_days: int,
    purge: bool = False,
    calendar: Calendar | None = None,
) -> Split:
    """Dates up to ``train_end`` train; the first ``test_days`` dates from ``test_start`` test.

    ``purge=True`` drops the training rows whose target was observed inside the test window.
    """
    last, first = _as_date(train_end), _as_date(test_start)
    if first <= last:
        raise ValueError(f"the windows overlap: training ends {last}, the test starts {first}")
    calendar = calendar or Calendar.of(df)
    begin = bisect_left(calendar.days, first)
    known = range(bisect_right(calendar.days, last))
    return calendar.cut(df, known, range(begin, begin + test_days), purge)
