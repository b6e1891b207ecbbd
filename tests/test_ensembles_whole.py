"""Ensembles at their defaults: what the query fits, trees from kinds of rows, forecasts of many trees."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import boosting, ensembles, models, scoring
from basketry.operators.boosting import Boosting, Growth
from basketry.operators.ensembles import Ensemble, Node
from basketry.plans import catalog, checks
from basketry.settings import FEATURES, KEYED_MODELS, MODEL_DEFAULTS, TARGET
from data import day

SF_DIR = "/root/testdata/sf0.001"


def test_the_query_fits_every_tree_of_the_defaults(spark, monkeypatch):
    fitted = {}

    def fit(model, rows, features, target, seed, params):
        fitted[model] = models._settings(model, params)
        return Ensemble(tuple(features), (), 0.0).pipeline()

    monkeypatch.setattr(models, "fit_rows", fit)
    catalog.queries()["evaluate_ensembles_lineitem"](spark, SF_DIR)
    assert fitted == {m: MODEL_DEFAULTS[m] for m in KEYED_MODELS}


def test_its_sql_grows_as_many():
    sql = checks.oracle_sql()["evaluate_ensembles_lineitem"]
    for model in KEYED_MODELS:
        assert f"WHERE tree = {MODEL_DEFAULTS[model]['n_estimators']} AND" in sql


def _rows(spark, high, number=400):
    """Keys repeat and may be missing, as in any table."""
    rng = random.Random(7)
    rows = []
    for k in range(number):
        f = [rng.randrange(high) for _ in FEATURES]
        rows.append((None if k % 50 == 1 else k % 90, day(k % 13), *map(float, f), float(f[3] + 2 * f[0] + rng.randrange(2))))
    columns = ", ".join(f"{c} double" for c in (*FEATURES, TARGET))
    return spark.createDataFrame(rows, "product_id long, date date, " + columns)


@pytest.mark.parametrize("high", [2, 9])
@pytest.mark.parametrize("growth", [Growth(max_depth=4), Growth(max_depth=6, max_leaves=7, l2=0.0, min_rows=5, min_weight=0.0)])
def test_kinds_of_rows_and_levels_give_the_same_trees(spark, monkeypatch, high, growth):
    rows = _rows(spark, high).cache()
    how = Boosting(4, 0.3, 0.8, 0.8, growth=growth)
    monkeypatch.setattr(boosting, "SAMPLES_AT_ONCE", 3)
    kinds = boosting.boost(rows, FEATURES, TARGET, 42, how)
    monkeypatch.setattr(boosting, "MOST_KINDS", 3)
    assert boosting.boost(rows, FEATURES, TARGET, 42, how) == kinds
    assert sum(map(len, kinds.trees)) > 8


def test_rows_are_read_once_for_many_rounds(spark, monkeypatch):
    passes = []
    sizes = boosting._sample_sizes
    monkeypatch.setattr(boosting, "_sample_sizes", lambda *a: passes.append(1) or sizes(*a))
    monkeypatch.setattr(boosting, "_tables", lambda *a: pytest.fail("a job for a level"))
    trees = boosting.boost(_rows(spark, 3), FEATURES, TARGET, 42, Boosting(60, 0.1, 0.8, 0.8, growth=Growth(max_depth=3)))
    assert len(trees.trees) == 60 and len(passes) == 2


@pytest.mark.parametrize("inclusive", [False, True])
def test_many_nodes_are_walked_to_the_same_forecast(spark, monkeypatch, inclusive):
    rng = random.Random(3)

    def tree(depth):
        if depth == 0 or rng.random() < 0.2:
            return [Node(rng.uniform(-1, 1), 1.0)]
        low, high = tree(depth - 1), tree(depth - 1)
        moved = [
            Node(n.value, n.cover, n.feature, n.cut, n.left + by if n.feature else -1, n.right + by if n.feature else -1)
            for part, by in ((low, 1), (high, 1 + len(low)))
            for n in part
        ]
        return [Node(0.0, 1.0, rng.choice(FEATURES), float(rng.randrange(5)), 1, 1 + len(low)), *moved]

    made = Ensemble(FEATURES, tuple(tuple(tree(5)) for _ in range(9)), 0.25, inclusive)
    rows = _rows(spark, 6, 60).withColumn("views", F.when(F.col("views") > 1, F.col("views")))

    def forecasts():
        return [r["prediction"] for r in scoring.with_prediction(rows, made.pipeline()).collect()]

    nested = forecasts()
    monkeypatch.setattr(ensembles, "MOST_CONDITIONS", 0)
    assert forecasts() == pytest.approx(nested, abs=1e-12)
    assert len(set(nested)) > 10
