from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketry.operators import cleaning
from basketry.settings import EVENT_COLUMNS, EVENT_TYPES
from data import RAW, raw_frame


def test_bad_rows_go_and_a_day_is_added(spark):
    out = cleaning.clean_events(raw_frame(spark))
    assert out.columns == [*EVENT_COLUMNS, "date"]
    assert dict(out.dtypes) == {
        "event_time": "timestamp",
        "event_type": "string",
        "product_id": "bigint",
        "category_id": "bigint",
        "category_code": "string",
        "brand": "string",
        "price": "double",
        "user_id": "bigint",
        "user_session": "string",
        "date": "date",
    }
    assert out.count() == 10
    assert {r[0] for r in out.select("event_type").distinct().collect()} <= set(EVENT_TYPES)
    assert out.where("brand IS NULL").count() == 4
    assert out.where("date <> to_date(event_time)").count() == 0


def test_a_copy_changes_nothing(spark, rows):
    once = rows(cleaning.clean_events(raw_frame(spark)))
    assert rows(cleaning.clean_events(raw_frame(spark, RAW + RAW[:1]))) == once
    assert rows(cleaning.clean_events(raw_frame(spark, RAW * 3).repartition(7))) == once


def test_copies_are_found_after_normalising(spark):
    row = list(RAW[0])
    row[1], row[6], row[3] = " VIEW\t", "19.50", "70.0"
    assert cleaning.clean_events(raw_frame(spark, RAW + [tuple(row)])).count() == 10


def test_nulls_are_equal_in_copies(spark):
    row = list(RAW[4])
    row[5] = "None"  # another spelling of the missing brand of RAW[4]
    assert cleaning.clean_events(raw_frame(spark, [RAW[4], tuple(row)])).count() == 1


def test_extra_columns_keep_copies_apart(spark):
    both = raw_frame(spark, RAW[:1] * 2)
    marked = both.withColumn("extra", F.monotonically_increasing_id().cast("string"))
    assert cleaning.clean_events(marked.repartition(1)).count() == 2
    assert cleaning.clean_events(both.withColumn("extra", F.lit("same"))).count() == 1


def test_cleaning_twice_changes_nothing(spark, rows):
    once = cleaning.clean_events(raw_frame(spark))
    assert rows(cleaning.clean_events(once.drop("date"))) == rows(once)


def test_missing_columns_are_listed_in_order(spark):
    with pytest.raises(ValueError, match=r"\['brand', 'price'\]"):
        cleaning.clean_events(raw_frame(spark).drop("price", "brand"))


@pytest.mark.parametrize("allowed, kept", [(None, 10), ([], 10), (["view"], 5), (["wishlist"], 1)])
def test_allowed_types(spark, allowed, kept):
    assert cleaning.clean_events(raw_frame(spark), allowed).count() == kept


@pytest.mark.parametrize(
    "price, kept", [("0", 1), ("-0.01", 0), ("NaN", 0), ("inf", 0), ("1e999", 0), ("1.0d", 0), ("", 0)]
)
def test_prices(spark, price, kept):
    row = list(RAW[0])
    row[6] = price
    assert cleaning.clean_events(raw_frame(spark, [tuple(row)])).count() == kept


def test_missing_session_stays_null(spark):
    row = list(RAW[0])
    row[8] = "nan"
    out = cleaning.clean_events(raw_frame(spark, [tuple(row)])).first()
    assert out["user_session"] is None


def test_stats_credit_the_first_source(spark, rows):
    first = raw_frame(spark).withColumn("source_no", F.lit(0))
    second = raw_frame(spark, RAW[:2]).withColumn("source_no", F.lit(1))
    third = raw_frame(spark, RAW[3:4]).withColumn("source_no", F.lit(2))
    raw = first.unionByName(second).unionByName(third)
    cleaned = cleaning.clean_events(raw, keep_source=True)
    stats = cleaning.cleaning_stats(raw, cleaned, ["m.csv", "m.csv"])  # the third has no name
    assert rows(stats) == [(0, "m.csv", 12, 10), (1, "m.csv", 2, 0), (2, None, 1, 0)]


def test_each_cell_is_parsed_once(spark):
    plan = cleaning.normalise(raw_frame(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("as timestamp)") == 1
    assert plan.count("Generate inline") == 1
