from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

from basketry.operators import residuals

SCHEMA = "views long, purchases_next_day long, prediction double"


def frame(spark, seed=2, n=400):
    rng = random.Random(seed)
    rows = [
        (0 if rng.random() < 0.3 else rng.randrange(40), rng.randrange(6), rng.randrange(50) / 8)
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA), pd.DataFrame(rows, columns=["v", "y", "p"])


def test_summary_sign_is_actual_minus_predicted(spark):
    df = spark.createDataFrame([(1, 5, 2.0), (1, 1, 2.0)], SCHEMA)
    s = residuals.residual_summary(df, "m", "e1").first()
    assert (s["n_test"], s["mae"], s["mean_residual"]) == (2, 2.0, 1.0)
    assert s["rmse"] == pytest.approx(5**0.5)


@pytest.mark.parametrize("bins", [80, 7, 1])
def test_histogram_matches_numpy(spark, bins):
    df, pdf = frame(spark)
    counts, edges = np.histogram(pdf.y - pdf.p, bins=bins)
    got = residuals.residual_histogram(df, bins).orderBy("bin").collect()
    assert [r["residuals"] for r in got] == counts.tolist()
    assert [r["bin_start"] for r in got] == pytest.approx(edges[:-1].tolist())
    assert [r["bin_end"] for r in got] == pytest.approx(edges[1:].tolist())


def test_histogram_of_equal_residuals(spark):
    df = spark.createDataFrame([(1, 3, 1.0)] * 5, SCHEMA)
    got = residuals.residual_histogram(df, 80).orderBy("bin").collect()
    counts, _ = np.histogram([2.0] * 5, bins=80)
    assert [r["residuals"] for r in got] == counts.tolist()


def test_activity_groups_match_pandas(spark):
    df, pdf = frame(spark)
    cuts, top = residuals.activity_quantiles(df)
    assert cuts == pytest.approx(np.quantile(pdf.v, [0.33, 0.66]).tolist())
    groups = pd.cut(
        pdf.v, bins=[-0.1, *cuts, top + 1], labels=["low_views", "medium_views", "high_views"]
    )
    want = (pdf.y - pdf.p).abs().groupby(groups, observed=True).mean()
    got = {r["activity"]: r["mae"] for r in residuals.error_by_activity(df).collect()}
    assert got == pytest.approx(want.to_dict())


def test_empty_activity_groups_vanish(spark):
    df = spark.createDataFrame([(0, 1, 1.0)] * 9 + [(5, 1, 3.0)], SCHEMA)
    got = {r["activity"]: (r["n"], r["mae"]) for r in residuals.error_by_activity(df).collect()}
    assert got == {"low_views": (9, 0.0), "high_views": (1, 2.0)}


def test_comparison(spark, rows):
    table = spark.createDataFrame(
        [("e1", "lag1", 0.1), ("e2", "lag1", 0.2), ("e1", "ma7", 0.3), ("e9", "ma7", 0.4)],
        "experiment string, model string, mae double",
    )
    got = residuals.experiment_comparison(table, ["e1", "e2"])
    assert got.columns == ["model", "e1", "e2"]
    assert rows(got) == [("lag1", 0.1, 0.2), ("ma7", 0.3, None)]


def test_pairs(spark):
    df, pdf = frame(spark, n=5)
    got = residuals.pred_vs_actual(df, "m").collect()
    assert sorted((r["y"], r["y_hat"]) for r in got) == sorted(zip(pdf.y, pdf.p))
