"""Raw text events to typed, de-duplicated events with a UTC day."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from basketry.functions import cells
from basketry.settings import EVENT_COLUMNS, EVENT_TYPES
from basketry.sources.bronze import SOURCE_COLUMN, SOURCE_NO

_ID_COLUMNS = ("product_id", "category_id", "user_id")
_TEXT_COLUMNS = ("event_type", "category_code", "brand", "user_session")


def require_columns(df: DataFrame, needed: Iterable[str] = EVENT_COLUMNS) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"these event columns are not there: {missing}")


def null_tokens(df: DataFrame) -> DataFrame:
    """Null out the missing-value tokens in every raw event column."""
    return df.withColumns({c: cells.na_to_null(F.col(c)) for c in EVENT_COLUMNS})


def _stripped(df: DataFrame) -> DataFrame:
    """All columns as text (typed ones can be cleaned again); text cells freed of tokens and blanks.

    The other cells need neither: a token is no time and no number.
    """
    text = {c: F.col(c).cast("string") for c in df.columns}
    for c in _TEXT_COLUMNS:
        text[c] = cells.strip(cells.na_to_null(text[c]))
    return df.select(*[e.alias(c) for c, e in text.items()])


# How each column is typed, given the stripped text.
_TYPED = {
    "event_time": cells.event_time,
    "event_type": F.lower,
    "product_id": cells.whole_number,
    "category_id": cells.whole_number,
    "category_code": cells.present,
    "brand": cells.present,
    "price": cells.number,
    "user_id": cells.whole_number,
    "user_session": lambda text: text,
}


def _retype(df: DataFrame, *columns: str) -> DataFrame:
    return _stripped(df).withColumns({c: _TYPED[c](F.col(c)) for c in columns})


def _known_type(valid_event_types: Iterable[str] | None) -> Column:
    return F.col("event_type").isin(*sorted(set(valid_event_types or EVENT_TYPES)))


def _good_price() -> Column:
    return F.col("price").between(0.0, sys.float_info.max)


def with_event_time(df: DataFrame) -> DataFrame:
    """Parse the event time and drop the rows without one."""
    return _retype(df, "event_time").where(F.col("event_time").isNotNull())


def with_event_type(df: DataFrame, valid_event_types: Iterable[str] | None = None) -> DataFrame:
    """Strip and lower the event type and keep the allowed ones (none given: the default four)."""
    return _retype(df, "event_type").where(_known_type(valid_event_types))


def with_price(df: DataFrame) -> DataFrame:
    """Finite numeric price, zero or more."""
    return _retype(df, "price").where(_good_price())


def with_ids(df: DataFrame) -> DataFrame:
    """Product, category and user ids as longs; a row needs all three."""
    return _retype(df, *_ID_COLUMNS).dropna(subset=list(_ID_COLUMNS))


def with_text(df: DataFrame) -> DataFrame:
    """Strip the text columns; blank category codes and brands become null."""
    return _retype(df, "category_code", "brand", "user_session")


def normalise(df: DataFrame, valid_event_types: Iterable[str] | None = None) -> DataFrame:
    """All row-wise cleaning steps in one pass over the scan, without a shuffle.

    The typed cells go through a one-element ``inline``. Filters cannot slip below it, so
    each cell is parsed once; after a plain projection the optimizer copies the parsing
    expressions into the filter and runs them twice (measured: half the throughput).
    """
    require_columns(df)
    extra = [F.col(c) for c in df.columns if c not in EVENT_COLUMNS]
    typed = [to_type(F.col(c)).alias(c) for c, to_type in _TYPED.items()]
    rows = _stripped(df).select(F.inline(F.array(F.struct(*typed, *extra))))
    return rows.where(
        F.col("event_time").isNotNull() & _known_type(valid_event_types) & _good_price()
    ).dropna(subset=list(_ID_COLUMNS))


def drop_copies(df: DataFrame, keep_source: bool = False) -> DataFrame:
    """One row per group of rows equal in every input column, nulls counting as equal.

    The columns are the grouping keys, so copies collapse inside each task before the
    shuffle: a row repeated a billion times sends one record per task. With ``keep_source`` a
    row keeps the number of the first entry it is in; the least of a number stays in a hash
    aggregate.
    """
    rows = df.drop(SOURCE_COLUMN) if keep_source else df.drop(SOURCE_COLUMN, SOURCE_NO)
    if SOURCE_NO not in rows.columns:
        return rows.dropDuplicates()
    keys = [c for c in rows.columns if c != SOURCE_NO]
    return rows.groupBy(*keys).agg(F.min(F.col(SOURCE_NO).cast("int")).alias(SOURCE_NO))


def with_day(df: DataFrame) -> DataFrame:
    """Add the UTC day and keep the nine event columns, the day, and the entry's number if known."""
    number = [SOURCE_NO] if SOURCE_NO in df.columns else []
    return df.select(*EVENT_COLUMNS, cells.utc_day(F.col("event_time")).alias("date"), *number)


def clean_events(
    df: DataFrame, valid_event_types: Iterable[str] | None = None, keep_source: bool = False
) -> DataFrame:
    """The whole cleaning: normalise, drop copies, add the day."""
    return with_day(drop_copies(normalise(df, valid_event_types), keep_source))


def cleaning_stats(raw: DataFrame, cleaned: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Rows read and rows kept for each entry, by its number; ``sources`` names them in order.

    Both are counts of one small column, of the raw files and of the cleaned table as written.
    """
    rows_in = raw.groupBy(SOURCE_NO).agg(F.count("*").alias("rows_in"))
    rows_out = cleaned.groupBy(SOURCE_NO).agg(F.count("*").alias("rows_out"))
    return rows_in.join(rows_out, SOURCE_NO, "left").select(
        SOURCE_NO,
        F.get(F.lit(list(sources)), F.col(SOURCE_NO)).alias(SOURCE_COLUMN),
        "rows_in",
        F.coalesce("rows_out", F.lit(0).cast("long")).alias("rows_out"),
    )


class RowCounts:
    """Rows of each entry, counted while another job reads them.

    ``watch`` adds the counters to a frame, ``get`` waits for the job that runs it. No frame is read
    again, and what comes back is one number for each entry.
    """

    def __init__(self, entries: int):
        self.entries = entries
        self.seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        counts = [F.count_if(F.col(SOURCE_NO) == n).alias(f"n{n}") for n in range(self.entries)]
        return df.observe(self.seen, *counts)

    def get(self) -> list[int]:
        found = self.seen.get
        return [found[f"n{n}"] for n in range(self.entries)]


def counted_stats(spark: SparkSession, rows_in: RowCounts, rows_out: RowCounts, sources: Sequence[str]) -> DataFrame:
    """The table of ``cleaning_stats`` from counters of the job that cleaned; entries without rows are left out."""
    rows = [r for r in zip(range(len(sources)), sources, rows_in.get(), rows_out.get()) if r[2]]
    return spark.createDataFrame(rows, f"{SOURCE_NO} int, {SOURCE_COLUMN} string, rows_in long, rows_out long")
