"""Sketches against exact answers, and that they merge."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import sketches, summary
from basketry.plans import build
from basketry.sources import tables
from data import day


@pytest.fixture(scope="module")
def events(spark):
    """Three products over ten days; users come back on other days."""
    rng = random.Random(2)
    rows = []
    for product, users, n in ((1, 5000, 20_000), (2, 300, 3_000), (3, 4, 50)):
        for _ in range(n):
            kind = rng.choices(["view", "cart", "purchase"], [8, 1, 1])[0]
            rows.append((product, day(rng.randrange(10)), kind, rng.randrange(users) + 10**12))
    rows.append((4, day(0), "cart", 1))
    return spark.createDataFrame(rows, "product_id long, date date, event_type string, user_id long").cache()


@pytest.mark.parametrize("days", [(None, None), (day(2), day(5)), ("2024-01-04", "2024-01-04"), (day(50), None)])
def test_viewers_of_any_days(events, days):
    found = sketches.unique_viewers_sketch(sketches.viewer_sketches(events), *days)
    first, last = (d or x for d, x in zip(days, (day(0), day(99))))
    inside = events.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    exact = {r["product_id"]: r["unique_viewers"] for r in summary.viewers(inside).collect()}
    got = {r["product_id"]: r["unique_viewers"] for r in found.collect()}
    assert set(got) == set(exact) and all(got[p] == pytest.approx(exact[p], rel=0.03) for p in exact)


def test_sketches_merge_to_the_sketch_of_all(events):
    daily = sketches.viewer_sketches(events)
    whole = events.withColumn("date", F.lit(day(0)))
    one = {r[0]: r[1] for r in sketches.unique_viewers_sketch(daily).collect()}
    two = {r[0]: r[1] for r in sketches.unique_viewers_sketch(sketches.viewer_sketches(whole)).collect()}
    assert all(one[p] == pytest.approx(two[p], rel=0.02) for p in one) and set(one) == set(two)


def test_sketches_are_stored_with_gold(spark, tmp_path):
    from basketry.plans import testdata

    silver = str(tmp_path / "silver")
    tables.write_silver(testdata.click_silver(spark, "/root/testdata/sf0.001"), silver)
    built = build.build_gold(spark, silver, str(tmp_path / "gold"), str(tmp_path / "log"), sketches=True)
    logged = {r["table"]: r["rows"] for r in spark.read.json(str(tmp_path / "log")).collect()}
    assert set(logged) == {"product_summary", "product_by_day", "viewer_sketches"}
    got = sketches.unique_viewers_sketch(built["viewer_sketches"]).collect()
    exact = {r["product_id"]: r["unique_viewers"] for r in built["product_summary"].collect()}
    assert got and all(r["unique_viewers"] == exact[r["product_id"]] for r in got)


def test_viewer_sketch_counts_before_it_shuffles(events):
    plan = sketches.viewer_sketches(events)._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan and plan.count("Exchange hashpartitioning") == 1


def forecasts(spark):
    rng = random.Random(3)
    rows = []
    for group, n in (("a", 30_000), ("b", 5_000), ("c", 7)):
        rows += [(group, int(rng.paretovariate(0.9)), rng.random()) for _ in range(n)]
    rows += [("a", None, 1.0), ("d", None, 1.0)]
    return spark.createDataFrame(rows, "model string, views long, error double")


def test_activity_cuts_have_the_stated_rank_error(spark):
    df = forecasts(spark).repartition(6)
    halves = df.withColumn("half", F.crc32(F.col("error").cast("string")) % 2)
    merged = sketches.merged_sketches(sketches.activity_sketches(halves, ["model", "half"]), ["model"])
    rows = {m: sorted(r["views"] for r in df.where(f"model = '{m}' AND views IS NOT NULL").collect()) for m in "abc"}
    for found in (sketches.activity_sketches(df, ["model"]), merged):
        cuts = {r["model"]: r for r in sketches.sketch_quantiles(found).collect()}
        assert set(cuts) == set("abc")
        for m, views in rows.items():
            assert cuts[m]["n"] == len(views)
            for q, name in ((0.33, "low_cut"), (0.66, "high_cut")):
                below = sum(v < cuts[m][name] for v in views) / len(views)
                upto = sum(v <= cuts[m][name] for v in views) / len(views)
                slack = 0.01 + 1 / len(views)
                assert below <= q + slack and upto >= q - slack


def test_error_by_activity_of_each_group(spark):
    df = forecasts(spark)
    got = {(r["model"], r["activity"]): r for r in sketches.error_by_activity_groups(df, ["model"], F.col("error")).collect()}
    for m in "ab":
        total = sum(got[m, a]["n"] for a in ("low", "medium", "high") if (m, a) in got) if (m, "low") in got else sum(
            r["n"] for k, r in got.items() if k[0] == m
        )
        assert total == {"a": 30_000, "b": 5_000}[m]
    assert all(0 <= r["mae"] <= 1 for r in got.values()) and not [k for k in got if k[0] == "d"]


def test_only_the_cuts_are_broadcast_in_activity_sketch(spark):
    from basketry.plans import catalog

    found = catalog.queries()["activity_sketch"](spark, "/root/testdata/sf0.001")
    joined = str(found._jdf.queryExecution().optimizedPlan().toString()).split("Join Inner")[1].splitlines()[0]
    assert "rightHint=(strategy=broadcast)" in joined and "leftHint" not in joined
    assert found.count() == 2
