"""Streams with bounded state against the batch operators."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import cleaning, daily
from basketry.settings import EVENT_COLUMNS
from basketry.streaming import ingest, live
from data import RAW, raw_frame
from test_streaming import write

START = dt.datetime(2024, 3, 1)


def event(minutes, kind="view", product=1, user="1", price="2.0"):
    time = START + dt.timedelta(minutes=minutes)
    return (f"{time:%Y-%m-%d %H:%M:%S} UTC", kind, str(product), "7", "a.b", "x", price, user, "s")


def many_events(n=600, days=12, seed=4):
    rng = random.Random(seed)
    kinds = ("view", "cart", "remove_from_cart", "purchase")
    rows = [event(rng.randrange(days * 1440), rng.choice(kinds), rng.choice([1, 1, 1, 2, 3]), str(k)) for k in range(n)]
    return sorted(rows)


def run(spark, tmp_path, files, make, name):
    folder = tmp_path / name
    folder.mkdir()
    out, state = str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-state")
    queries = []
    for k, rows in enumerate(files):  # one file after the other, each in batches of its own
        write(folder, f"{k}.csv", rows)
        queries.append(live.start(make(ingest.stream_bronze(spark, str(folder), 1)), out, state))
        queries[-1].awaitTermination()
    return spark.read.parquet(out), queries


def test_copies_in_different_batches_go_once(spark, rows, tmp_path):
    files = [RAW[:5], RAW[3:9], RAW[:2] + RAW[9:]]
    got, queries = run(spark, tmp_path, files, lambda raw: live.live_events(raw, "5 days"), "copies")
    assert rows(got) == rows(cleaning.clean_events(raw_frame(spark)))
    assert [live.late_rows(q) for q in queries] == [0, 0, 0]


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    files = [[event(0)], [event(3 * 1440)], [event(10, user="2"), event(3 * 1440 + 1, user="2")]]
    got, queries = run(spark, tmp_path, files, lambda raw: live.live_events(raw, "1 day"), "late")
    assert sorted(r["user_id"] for r in got.collect()) == [1, 1, 2]
    assert sum(live.late_rows(q) for q in queries) == 1


def batch_rows(spark, rows, delay):
    """Labelled rows of the batch table whose next active day the watermark has passed."""
    events = cleaning.normalise(raw_frame(spark, rows))
    limit = events.agg(F.max("event_time")).first()[0] - delay
    table = daily.product_by_day(cleaning.with_day(events))
    following = F.lead("date").over(daily.series())
    return table.withColumn("following", following).where(F.date_add("following", 1).cast("timestamp") <= F.lit(limit)).drop("following")


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (1, 0, 3, 2)])
def test_product_days_equal_the_batch_in_any_file_order(spark, rows, tmp_path, order):
    found = many_events()
    cuts = [found[:150], found[150:300], found[300:450], found[450:]]
    make = lambda raw: live.live_product_days(
        cleaning.normalise(raw).withWatermark("event_time", "7 days")
    )
    got, queries = run(spark, tmp_path, [cuts[k] for k in order], make, "days")
    want = batch_rows(spark, found, dt.timedelta(days=7))
    columns = want.columns
    assert rows(got, *columns) == rows(want, *columns) and got.count() > 5
    assert sum(live.late_rows(q) for q in queries) == 0


def test_ring_keeps_only_the_window(spark, rows, tmp_path):
    found = [event(1440 * d, kind, user=str(i)) for d in range(12) for i, kind in enumerate(["view", "purchase", "purchase"][: 1 + d % 3])]
    make = lambda raw: live.live_product_days(
        cleaning.normalise(raw).withWatermark("event_time", "0 seconds"), 3
    )
    got, _ = run(spark, tmp_path, [found[:13], found[13:]], make, "ring")
    table = daily.product_by_day(cleaning.clean_events(raw_frame(spark, found)), 3)
    want = table.where(f"date < '{(START + dt.timedelta(days=10)).date()}'")
    assert rows(got, *want.columns) == rows(want, *want.columns)


def test_state_does_not_grow_with_the_stream(spark, tmp_path):
    files = [[event(1440 * d + m, user=str(m)) for m in range(20)] for d in range(0, 12, 3)]
    _, queries = run(spark, tmp_path, files, lambda raw: live.live_events(raw, "1 day"), "state")
    held = [q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] for q in queries]
    assert max(held) <= 40


def test_normalised_stream_keeps_the_event_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    events = live.live_events(ingest.stream_bronze(spark, str(tmp_path / "in")))
    assert events.isStreaming and events.columns == [*EVENT_COLUMNS, "date"]


def test_lots_of_a_stream_have_a_file_for_each_task(spark):
    import glob

    from basketry import scratch
    from basketry.plans import catalog

    known = set(scratch._made)
    rows = catalog.queries()["streaming_dedup"](spark, "/root/testdata/sf0.001")
    landing = [p for p in scratch._made if p not in known and "landing" in p]
    files = glob.glob(f"{landing[0].removeprefix('file:')}/*.csv")
    assert len(landing) == 1 and len(files) > 3  # three lots
    assert rows.count() == catalog.queries()["clean_all"](spark, "/root/testdata/sf0.001").count() > 0
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled", "true") == "true"
