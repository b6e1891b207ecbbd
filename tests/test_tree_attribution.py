"""Contributions along the trees against the sum over all coalitions."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest

from basketry.operators import models, scoring, tree_attribution as along
from basketry.operators.boosting import Boosting, Growth
from basketry.operators.ensembles import Ensemble, Node
from basketry.settings import FEATURES
from test_boosting import frame, made_rows


def made_tree(rng, features, depth):
    """A tree of random splits; a feature may come back further down."""
    nodes = []

    def add(level, cover):
        at = len(nodes)
        nodes.append(None)
        if level == 0 or cover < 2 or rng.random() < 0.15:
            nodes[at] = Node(rng.uniform(-5, 5), float(cover))
        else:
            left = rng.randint(1, cover - 1)
            cut = rng.randint(1, 8) + 0.5
            nodes[at] = Node(0.0, float(cover), rng.choice(features), cut, add(level - 1, left), add(level - 1, cover - left))
        return at

    add(depth, 500)
    return tuple(nodes)


def coalition_value(trees, row, known):
    def of(nodes, at):
        node = nodes[at]
        if node.feature is None:
            return node.value
        left, right = nodes[node.left], nodes[node.right]
        if node.feature in known:
            x = row[node.feature]
            goes_left = x <= node.cut if trees.inclusive else x < node.cut
            return of(nodes, node.left if goes_left else node.right)
        return (left.cover * of(nodes, node.left) + right.cover * of(nodes, node.right)) / node.cover

    return trees.base + sum(of(t, 0) for t in trees.trees)


def brute_force(trees, row, features):
    n, phi = len(features), {}
    for f in features:
        rest = [x for x in features if x != f]
        phi[f] = 0.0
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for own in itertools.combinations(rest, size):
                phi[f] += weight * (coalition_value(trees, row, {*own, f}) - coalition_value(trees, row, set(own)))
    return phi


@pytest.mark.parametrize("inclusive", [False, True])
def test_equals_the_sum_over_coalitions(inclusive):
    rng = random.Random(8)
    features = ("a", "b", "c", "d", "e")
    trees = Ensemble(features, tuple(made_tree(rng, features, 5) for _ in range(3)), 0.7, inclusive)
    explainer = along._Explainer(trees, features)
    rows = [{f: float(rng.choice([rng.randint(0, 9), rng.randint(1, 8) + 0.5])) for f in features} for _ in range(25)]
    found = explainer.contributions(np.array([[r[f] for f in features] for r in rows]))
    assert explainer.expected == pytest.approx(coalition_value(trees, rows[0], set()), abs=1e-10)
    for row, got in zip(rows, found):
        want = brute_force(trees, row, features)
        assert got.tolist() == pytest.approx([want[f] for f in features], abs=1e-10)


def test_forty_features_add_up(spark):
    rng = random.Random(9)
    features = tuple(f"f{k}" for k in range(40))
    trees = Ensemble(features, tuple(made_tree(rng, features, 9) for _ in range(6)), -1.0)
    rows = [(k, *(float(rng.randint(0, 9)) for _ in features)) for k in range(200)]
    sample = spark.createDataFrame(rows, "id long, " + ", ".join(f"{f} double" for f in features))
    got = along.tree_attribution(trees, sample, features, ["id"]).toPandas().set_index("id").sort_index()
    want = trees.pipeline().transform(sample).toPandas().set_index("id").sort_index()
    assert np.allclose(got.prediction, want.prediction, atol=1e-9)
    phi = got[[f"phi_{f}" for f in features]]
    assert np.allclose(phi.sum(axis=1) + got.base_value, want.prediction, atol=1e-9)
    assert (phi != 0).any().sum() > 30


def test_boosted_trees_and_mllib_models(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "gold")
    frame(spark, made_rows()).write.parquet(path)
    gold = spark.read.parquet(path)
    fitted = models.fit_random_forest(gold, params={"n_estimators": 3, "max_depth": 4})
    boosted = models.fit_gbt_depthwise(gold, params={"n_estimators": 3, "max_depth": 3})
    keyed = models.fit_forest_keyed(gold, params={"n_estimators": 2, "max_depth": 3})
    own = models.boosted_trees(gold, Boosting(2, growth=Growth(max_depth=3)))
    cases = [(along.mllib_trees(m), m) for m in (fitted, boosted, keyed)] + [(own, own.pipeline())]
    for trees, model in cases:
        got = along.tree_attribution(trees, gold).orderBy("product_id", "date").toPandas()
        want = scoring.with_prediction(gold, model).orderBy("product_id", "date").toPandas()
        assert np.allclose(got.prediction, want.prediction, atol=1e-9)
        phi = got[[f"phi_{c}" for c in FEATURES]]
        assert np.allclose(phi.sum(axis=1) + got.base_value, got.prediction, atol=1e-9)
        assert phi.abs().mean().idxmax() == "phi_purchases"
        row = {c: float(want.iloc[0][c]) for c in FEATURES}
        best = brute_force(trees, row, FEATURES)
        assert phi.iloc[0].tolist() == pytest.approx([best[c] for c in FEATURES], abs=1e-9)


def test_a_lone_leaf_and_other_features(spark):
    single = Ensemble(("views",), ((Node(2.0, 5.0),),), 1.0)
    sample = frame(spark, made_rows(products=1, days=2))
    got = along.tree_attribution(single, sample).collect()
    assert all(r["prediction"] == r["base_value"] == 3.0 and r["phi_views"] == 0 for r in got)
    assert along.tree_attribution(single, sample.limit(0)).collect() == []
    strange = Ensemble(("x",), ((Node(0.0, 2.0, "x", 1.0, 1, 2), Node(1.0, 1.0), Node(2.0, 1.0)),))
    with pytest.raises(ValueError, match="other features"):
        along.tree_attribution(strange, sample)


def test_rows_are_not_shuffled(spark):
    trees = Ensemble(("views",), ((Node(0.0, 2.0, "views", 1.0, 1, 2), Node(1.0, 1.0), Node(2.0, 1.0)),))
    plan = along.tree_attribution(trees, frame(spark, made_rows(products=1)))._jdf.queryExecution().toString()
    assert "Exchange" not in plan
