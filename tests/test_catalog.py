"""Every catalog query against its SQL, and the shape of the main plans."""

from __future__ import annotations

import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from basketry.operators import baselines, daily, folds, models, scoring, splits, summary
from basketry.plans import catalog, checks, testdata

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("lineitem", "orders", "events")
QUERIES, ORACLES = catalog.queries(), checks.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=0, abs_tol=2e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(cursor.fetchall(), key=repr)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert len(got) == len(want) > 0
    assert all(_same(a, b) for g, w in zip(got, want) for a, b in zip(g, w))
    plan = physical(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0


# -- plans ---------------------------------------------------------------------------------


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^,]+(?:, [a-z_]+#\w+)*),", physical(df))


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "gold")
    daily.product_by_day(testdata.click_silver(spark, SF_DIR)).write.partitionBy("date").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("calendar", [False, True])
def test_daily_table_sorts_once(spark, calendar):
    plan = physical(daily.product_by_day(testdata.click_silver(spark, SF_DIR), calendar=calendar))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("+- Sort [") == 1 and plan.count("+- Window [") == 1
    assert "partial_count" in plan


def test_summary_joins_without_a_shuffle_of_its_own(spark):
    df = summary.product_summary(testdata.lineitem_silver(spark, SF_DIR, with_user=True))
    plan = physical(df)
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("SortAggregate") == 0


def test_baselines_share_one_shuffle(gold):
    split = splits.split_first_n(splits.labelled(gold), 20, 5)
    plan = physical(baselines.with_baselines(split))
    assert plan.count("Exchange") == 1 and plan.count("+- Sort [") == 1 and "Join" not in plan
    assert re.search(r"PartitionFilters: \[[^\]]*date#", plan)


def test_fold_marks_need_no_shuffle(gold):
    plan = physical(folds.time_folds(gold, 3))
    assert "Exchange" not in plan and "Sort" not in plan


def test_top_predicted_reads_one_day(gold):
    plan = physical(scoring.top_predicted(gold, "2024-01-05"))
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*2024-01-05", plan)
    assert "ReadSchema: struct<product_id:bigint,views:bigint,purchases:bigint" in plan


def test_lookup_reduces_gold_before_joining(spark, gold):
    plan = physical(scoring.score(gold, catalog.requests(spark, SF_DIR)))
    assert plan.count("LeftSemi") >= 1


@pytest.mark.parametrize("name", ["top_predicted_baseline", "top_predicted_model"])
def test_registered_reports_read_one_day(spark, name):
    assert re.search(r"PartitionFilters: \[[^\]]*date#\w+ = ", physical(QUERIES[name](spark, SF_DIR)))


def test_a_report_on_the_sparse_stream_skips_row_groups(spark):
    plan = physical(QUERIES["top_predicted_lineitem"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(date,", plan)


@pytest.mark.parametrize("name", ["split_boundary", "evaluate_baselines", "baseline_on_split"])
def test_registered_splits_read_their_days(spark, name):
    assert re.search(r"PartitionFilters: \[[^\]]*date#\w+ >= ", physical(QUERIES[name](spark, SF_DIR)))


def test_profile_scans_the_events_twice(spark, monkeypatch):
    from basketry.operators import profile

    scans = []
    write = profile.scratch.materialise

    def counted(df, label):
        scans.append(physical(df).count("FileScan"))
        return write(df, label)

    monkeypatch.setattr(profile.scratch, "materialise", counted)
    rest = physical(profile.eda_summary(testdata.click_silver(spark, SF_DIR)))
    assert scans == [1] and rest.count("events.parquet") == 1


def test_two_time_zones_give_the_same_days_and_hours(spark):
    from basketry.operators import cleaning, profile, summary as per_product

    raw = testdata.dirty_bronze(spark, SF_DIR).drop("event_id")

    def found():
        cleaned = cleaning.clean_events(raw).selectExpr("unix_micros(event_time)", "date", "product_id")
        events = testdata.click_silver(spark, SF_DIR)
        return [
            sorted(map(tuple, df.collect()), key=repr)
            for df in (cleaned, profile.hourly_volume(events), per_product.peak_view_hour(events))
        ]

    try:
        here = found()
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        clean = cleaning.clean_events(raw).selectExpr("unix_micros(event_time)", "date", "product_id")
        assert sorted(map(tuple, clean.collect()), key=repr) == here[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_metrics_of_six_models_take_one_pass(gold):
    split = splits.split_first_n(splits.labelled(gold), 20, 5)
    table, _ = models.evaluate_models(split, params=catalog.STUMPS, models=("random_forest",))
    assert physical(table).count("FileScan") == 1


def test_gold_in_buckets_is_not_shuffled(spark, tmp_path):
    from basketry.sources import tables

    gold = daily.product_by_day(testdata.click_silver(spark, SF_DIR))
    tables.write_bucketed_gold(gold, "gold_in_buckets", str(tmp_path / "gold"), 8)
    try:
        held = tables.read_bucketed_gold(spark, "gold_in_buckets")
        split = splits.split_first_n(splits.labelled(held), 20, 5)
        assert "Exchange" not in physical(baselines.with_baselines(split))
        assert "Exchange" not in physical(summary.with_rates(held.groupBy("product_id").agg(
            *(F.sum(c).alias(f"total_{c}") for c in ("views", "carts", "purchases"))
        )))
        # a lookup moves its requests alone
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = physical(scoring.score(held, catalog.requests(spark, SF_DIR)))
        above = nodes_above(plan, "gold_in_buckets")
        assert any("SortMergeJoin" in node for node in above)
        first_join = next(k for k, node in enumerate(above) if "Join" in node)
        assert not [node for node in above[: first_join + 1] if "Exchange" in node]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE gold_in_buckets")


def nodes_above(plan: str, scan: str) -> list[str]:
    """The nodes from a scan up to the root of a plan."""
    lines = plan.splitlines()
    depth = [len(re.match(r"[\s:+-]*", line)[0]) for line in lines]
    at = next(k for k, line in enumerate(lines) if "FileScan" in line and scan in line)
    found = []
    for k in range(at, -1, -1):
        if depth[k] < depth[at]:
            found.append(lines[k])
            at = k
    return found
