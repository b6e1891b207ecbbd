from __future__ import annotations

import random

import pandas as pd
import pytest

from basketry.operators import baselines, metrics, splits
from data import daily_frame, day

SCHEMA = "product_id long, date date, purchases long, purchases_next_day long"


def test_lag1_and_moving_average(spark):
    frame = daily_frame(spark, [(1, day(i), 0, 0, 0, n) for i, n in enumerate((1, 3, 5))])
    out = baselines.add_baselines(frame).orderBy("date").collect()
    assert [r["pred_lag1"] for r in out] == [1, 3, 5]
    assert [r["pred_ma7"] for r in out] == [1.0, 2.0, 3.0]


def test_historical_mean_uses_training_rows_only(spark, rows):
    train = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 10.0)], "product_id long, purchases double")
    test = spark.createDataFrame([(1,), (2,), (3,)], "product_id long")
    assert rows(baselines.historical_mean(train, test)) == [(1, 3.0), (2, 10.0), (3, 0.0)]


def test_split_baselines_against_pandas(spark):
    rng = random.Random(3)
    data = [
        (p, day(d), rng.randrange(9), rng.randrange(9))
        for p in range(1, 15)
        for d in range(20)
        if rng.random() < 0.6 and not (p > 12 and d < 14)
    ]
    gold = spark.createDataFrame(data, SCHEMA)
    split = splits.split_boundary(gold, day(9), day(12), 5)
    got = baselines.baseline_predictions(split).toPandas()
    got = got.sort_values(["product_id", "date"]).reset_index(drop=True)

    pdf = pd.DataFrame(data, columns=["p", "d", "n", "y"]).sort_values(["p", "d"])
    train = pdf[pdf.d <= day(9)]
    test = pdf[(pdf.d >= day(12)) & (pdf.d <= day(16))]
    both = pd.concat([train, test]).sort_values(["p", "d"])
    ma = both.groupby("p")["n"].rolling(7, min_periods=1).mean().droplevel(0)
    means = train.groupby("p")["n"].mean()
    assert got["y"].tolist() == test["y"].tolist()
    assert got["pred_lag1"].tolist() == test["n"].tolist()
    assert got["pred_ma7"].tolist() == pytest.approx(ma.loc[test.index].tolist())
    assert got["pred_hist_mean"].tolist() == pytest.approx(
        test["p"].map(means).fillna(0.0).tolist()
    )


def measure(spark, pairs, partitions=1):
    frame = spark.createDataFrame(pairs, "y double, p double").repartition(partitions)
    return metrics.regression_metrics(frame, "y", {"m": "p"}).first()


def test_perfect_forecast(spark):
    m = measure(spark, [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)])
    assert (m["mae"], m["rmse"], m["mape"], m["r2"]) == (0.0, 0.0, 0.0, 1.0)


def test_r2_is_not_a_correlation(spark):
    assert measure(spark, [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)])["r2"] == pytest.approx(-6.0)


def test_undefined_measures(spark):
    zeros = measure(spark, [(0.0, 1.0), (0.0, 2.0)])
    assert zeros["mape"] is None and zeros["r2"] == 0.0
    assert measure(spark, [(2.0, 2.0)])["r2"] is None
    assert measure(spark, [(2.0, 2.0), (2.0, 2.0)])["r2"] == 1.0
    assert measure(spark, [(0.0, 5.0), (2.0, 1.0)])["mape"] == pytest.approx(50.0)


def test_measures_do_not_depend_on_partitioning(spark):
    rng = random.Random(1)
    pairs = [(float(rng.randrange(5)), rng.random()) for _ in range(300)]
    one, many = measure(spark, pairs), measure(spark, pairs, 7)
    for name in ("mae", "rmse", "mape", "r2"):
        assert one[name] == pytest.approx(many[name], rel=1e-12)


def test_wide_and_long_agree(spark, rows):
    frame = spark.createDataFrame([(1.0, 2.0, 3.0), (4.0, 4.0, 2.0)], "y double, a double, b double")
    wide = metrics.regression_metrics(frame, "y", {"a": "a", "b": "b"})
    long = frame.unpivot(["y"], ["a", "b"], "model", "y_hat")
    assert rows(wide) == rows(metrics.regression_metrics_long(long), *wide.columns)


def test_best_model(spark):
    table = spark.createDataFrame(
        [("e", "ma7", 0.5), ("e", "lag1", 0.5), ("e", "hist_mean", None), ("e", "random_forest", 0.6)],
        "experiment string, model string, mae double",
    )
    assert metrics.best_model(table).first()["model"] == "lag1"
    assert metrics.best_model(table, among=["random_forest", "hist_mean"]).first()["mae"] == 0.6
    assert metrics.best_model(table.where("mae IS NULL")).first()["model"] == "hist_mean"
