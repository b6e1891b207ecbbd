from __future__ import annotations

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from basketry.operators import cleaning, daily
from basketry.settings import COUNT_COLUMNS
from data import daily_frame, day, raw_frame

GOLD = [
    # product, day, views, carts, removals, purchases, next day, views_7d, carts_7d, purchases_7d
    (7, day(0, "2024-03-01"), 2, 1, 0, 1, 0, 2, 1, 1),
    (7, day(1, "2024-03-01"), 0, 0, 1, 0, 0, 2, 1, 1),
    (7, day(2, "2024-03-01"), 1, 0, 0, 0, None, 3, 1, 1),
    (8, day(0, "2024-03-01"), 1, 0, 0, 0, 1, 1, 0, 0),
    (8, day(1, "2024-03-01"), 1, 1, 0, 1, None, 2, 1, 1),
]


def test_golden_table(spark, rows):
    gold = daily.product_by_day(cleaning.clean_events(raw_frame(spark)))
    assert gold.columns == [
        "product_id",
        "date",
        "views",
        "carts",
        "removals",
        "purchases",
        "purchases_next_day",
        "views_7d",
        "carts_7d",
        "purchases_7d",
    ]
    assert rows(gold) == sorted(GOLD, key=repr)


def test_suffix_follows_the_window(spark):
    gold = daily.product_by_day(cleaning.clean_events(raw_frame(spark)), window=2)
    assert gold.columns[-3:] == ["views_2d", "carts_2d", "purchases_2d"]
    assert gold.where("product_id = 7 AND date = '2024-03-03'").first()["views_2d"] == 1


def test_extra_types_become_columns(spark):
    events = cleaning.clean_events(raw_frame(spark), ["view", "wishlist"])
    gold = daily.product_by_day(events, extra_types=["wishlist"])
    assert gold.agg(F.sum("wishlist")).first()[0] == 1
    assert gold.agg(F.sum("purchases")).first()[0] == 0


def test_calendar_reading_sees_gaps(spark, rows):
    counts = daily_frame(
        spark, [(1, day(0), 1, 0, 0, 5), (1, day(1), 1, 0, 0, 6), (1, day(9), 1, 0, 0, 7)]
    )
    by_row = daily.with_trailing_sums(daily.with_next_day_target(counts))
    assert rows(by_row, "purchases_next_day", "purchases_7d") == [(6, 5), (7, 11), (None, 18)]
    by_day = daily._calendar_features(counts, 7)
    assert rows(by_day, "purchases_next_day", "purchases_7d") == [(0, 11), (6, 5), (None, 7)]


event = st.tuples(
    st.integers(1, 4), st.integers(0, 12), st.sampled_from(sorted(COUNT_COLUMNS)), st.integers(1, 3)
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=st.lists(event, min_size=1, max_size=80), window=st.integers(1, 5))
def test_against_pandas(spark, events, window):
    frame = spark.createDataFrame(
        [(p, day(d), t) for p, d, t, n in events for _ in range(n)],
        "product_id long, date date, event_type string",
    )
    got = daily.product_by_day(frame, window).toPandas()
    pdf = pd.DataFrame([(p, day(d), t, n) for p, d, t, n in events], columns=["p", "d", "t", "n"])
    want = pdf.pivot_table(index=["p", "d"], columns="t", values="n", aggfunc="sum", fill_value=0)
    want = want.reindex(columns=list(COUNT_COLUMNS), fill_value=0).sort_index()
    got = got.sort_values(["product_id", "date"]).reset_index(drop=True)
    assert got[list(COUNT_COLUMNS.values())].values.tolist() == want.values.tolist()
    series = want["purchase"].groupby(level="p")
    nxt = series.shift(-1)
    assert got["purchases_next_day"].isna().tolist() == nxt.isna().tolist()
    assert got["purchases_next_day"].dropna().tolist() == nxt.dropna().tolist()
    sums = want["view"].groupby(level="p").rolling(window, min_periods=1).sum()
    assert got[f"views_{window}d"].tolist() == sums.tolist()
    # one unlabelled row per product, and a trailing sum never falls below its own day
    assert got["purchases_next_day"].isna().sum() == got["product_id"].nunique()
    assert (got[f"views_{window}d"] >= got["views"]).all()


def test_partitioning_does_not_matter(spark, rows):
    events = cleaning.clean_events(raw_frame(spark))
    want = rows(daily.product_by_day(events))
    for n in (1, 5):
        assert rows(daily.product_by_day(events.repartition(n, "user_id"))) == want


def test_window_must_be_positive(spark):
    with pytest.raises(ValueError):
        daily.product_by_day(cleaning.clean_events(raw_frame(spark)), window=0)
