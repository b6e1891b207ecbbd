from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from basketry.functions import cells
from basketry.settings import NA_TOKENS


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in out]


def test_event_time_layouts(spark):
    good = {
        "2024-03-01 10:00:00 UTC": dt.datetime(2024, 3, 1, 10),
        "2024-03-01 10:00:00": dt.datetime(2024, 3, 1, 10),
        "2024-03-01 10:00:00.25": dt.datetime(2024, 3, 1, 10, 0, 0, 250000),
        "2024-03-01T10:00:00Z": dt.datetime(2024, 3, 1, 10),
        "2024-03-01T10:00:00+02:00": dt.datetime(2024, 3, 1, 8),
    }
    df = spark.createDataFrame([(k,) for k in good], "v string")
    out = df.select("v", cells.event_time(F.col("v")).cast("string").alias("t")).collect()
    assert {r["v"]: dt.datetime.fromisoformat(r["t"]) for r in out} == good


def test_event_time_rejects_partial_and_impossible_times(spark):
    bad = ["bad-time", "10:00", "2019", "2024-03-01", "2024-02-30 10:00:00 UTC", "", None, "NaN"]
    assert apply(spark, cells.event_time, bad) == [None] * len(bad)


def test_number(spark):
    good = {"1": 1.0, " 12.5 ": 12.5, "1e2": 100.0, ".5": 0.5, "5.": 5.0, "+3": 3.0, "-4": -4.0}
    assert apply(spark, cells.number, list(good)) == list(good.values())
    bad = ["1.0d", "2f", "abc", "inf", "-Infinity", "NaN", "0x10", "1_000", "1,5", "", None, "e", "--1"]
    assert apply(spark, cells.number, bad) == [None] * len(bad)


def test_whole_number_is_exact_and_truncates(spark):
    values = ["2053013555631882655", "1.5", "-1.5", "1.0", " 7 ", "1e3", "9223372036854775807"]
    want = [2053013555631882655, 1, -1, 1, 7, 1000, 9223372036854775807]
    assert apply(spark, cells.whole_number, values) == want
    bad = ["9223372036854775808", "1e30", "-1e30", "x", "inf", "1e999", "", None]
    assert apply(spark, cells.whole_number, bad) == [None] * len(bad)


def test_strip_matches_python(spark):
    values = [" a ", "\tb\n", " c　", "d e", "\x1cf\x85", "", "   "]
    assert apply(spark, cells.strip, values) == [v.strip() for v in values]


def test_tokens_match_exactly(spark):
    assert apply(spark, cells.na_to_null, NA_TOKENS) == [None] * len(NA_TOKENS)
    near = [f"x{t}" for t in NA_TOKENS] + ["NAN", "Null", " NA", "none"]
    assert apply(spark, cells.na_to_null, near) == near


def test_present(spark):
    assert apply(spark, cells.present, ["", "nan", "None", "none", "x", None]) == [
        None,
        None,
        None,
        "none",
        "x",
        None,
    ]
