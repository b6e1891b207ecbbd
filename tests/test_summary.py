from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest

from basketry.operators import cleaning, profile, summary
from data import raw_frame


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(5)
    types = ["view"] * 6 + ["cart", "purchase", "remove_from_cart"]
    rows = [
        (
            # product 0 takes a third of the events
            0 if rng.random() < 0.33 else rng.randrange(1, 30),
            rng.randrange(12),
            rng.choice(types),
            dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(60 * 24 * 20)),
            float(rng.randrange(1, 900)) / 4,
        )
        for _ in range(1500)
    ] + [(99, 1, "cart", dt.datetime(2024, 1, 5, 3), 2.0)]
    frame = spark.createDataFrame(
        rows, "product_id long, user_id long, event_type string, event_time timestamp, price double"
    )
    return frame, pd.DataFrame(rows, columns=["p", "u", "t", "ts", "price"])


def test_golden_summary(spark, rows):
    got = rows(summary.product_summary(cleaning.clean_events(raw_frame(spark))))
    assert got == [
        (7, 3, 1, 1, 1, 1 / 3, 1.0, 2, 1, 19.5, 9),
        (8, 2, 1, 0, 1, 0.5, 1.0, 2, 0, 4.0, 9),
    ]


def test_summary_against_pandas(spark, events):
    frame, pdf = events
    got = summary.product_summary(frame).toPandas().set_index("product_id").sort_index()
    products = sorted(pdf["p"].unique())
    assert got.index.tolist() == products
    for p in products:
        mine, row = pdf[pdf.p == p], got.loc[p]
        n = mine["t"].value_counts()
        views, carts, bought = (int(n.get(t, 0)) for t in ("view", "cart", "purchase"))
        assert (row.total_views, row.total_carts, row.total_purchases) == (views, carts, bought)
        assert row.total_removals == n.get("remove_from_cart", 0)
        per_user = mine[mine.t == "view"]["u"].value_counts()
        assert (row.unique_viewers, row.repeat_viewers) == (len(per_user), (per_user > 1).sum())
        if views:
            assert row.view_to_cart_rate == pytest.approx(carts / views)
            hours = mine[mine.t == "view"]["ts"].dt.hour.value_counts()
            assert row.peak_view_hour == min(hours[hours == hours.max()].index)
        else:
            assert pd.isna(row.view_to_cart_rate) and pd.isna(row.peak_view_hour)
        if bought:
            mean = mine[mine.t == "purchase"]["price"].mean()
            assert row.avg_purchase_price == pytest.approx(mean)
        else:
            assert pd.isna(row.avg_purchase_price)


def test_single_columns_agree_with_the_table(spark, events, rows):
    frame, _ = events
    whole = summary.product_summary(frame)
    for part in (
        summary.product_counts,
        summary.product_rates,
        summary.unique_viewers,
        summary.repeat_viewers,
        summary.peak_view_hour,
    ):
        out = part(frame)
        assert rows(out) == rows(whole, *out.columns)


def test_rate_is_null_without_and_zero_with_a_denominator(spark):
    counts = spark.createDataFrame(
        [(1, 0, 3, 0), (2, 4, 0, 1)],
        "product_id long, total_views long, total_carts long, total_purchases long",
    )
    out = {r["product_id"]: r for r in summary.with_rates(counts).collect()}
    assert out[1]["view_to_cart_rate"] is None and out[1]["cart_to_purchase_rate"] == 0.0
    assert out[2]["view_to_cart_rate"] == 0.0 and out[2]["cart_to_purchase_rate"] is None


def test_profile(spark, events, rows):
    frame, pdf = events
    funnel = profile.event_funnel(frame).orderBy("step").collect()
    steps = ["view", "cart", "remove_from_cart", "purchase"]
    assert [r["event_type"] for r in funnel] == steps
    assert [r["events"] for r in funnel] == [int((pdf.t == t).sum()) for t in steps]
    only = profile.event_funnel(frame.where("event_type = 'cart'")).orderBy("step").collect()
    assert [r["events"] > 0 for r in only] == [False, True, False, False]

    assert rows(profile.hourly_volume(frame)) == sorted(
        ((int(h), int(n)) for h, n in pdf["ts"].dt.hour.value_counts().items()), key=repr
    )
    assert sum(r["events"] for r in profile.daily_volume(frame).collect()) == len(pdf)

    views = pdf[pdf.t == "view"]["p"].value_counts()
    want = sorted(views.items(), key=lambda i: (-i[1], i[0]))[:20]
    assert [tuple(r) for r in profile.top_viewed(frame).collect()] == want

    eda = profile.eda_summary(frame).collect()
    assert len(eda) == 1
    row = eda[0]
    assert row["rows"] == len(pdf) and row["unique_products"] == pdf["p"].nunique()
    assert row["unique_users"] == pdf["u"].nunique()
    assert row["event_counts"] == {t: int(n) for t, n in pdf["t"].value_counts().items()}
    assert row["funnel"]["view"] == int((pdf.t == "view").sum())
    assert [tuple(t) for t in row["top_viewed_products"]] == want
