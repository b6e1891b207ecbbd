"""Boosted trees against a plain greedy search, and what their parameters do."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import boosting, models, scoring, splits
from basketry.operators.boosting import Boosting, Growth
from basketry.operators.ensembles import Ensemble
from basketry.settings import FEATURES, TARGET
from basketry.sources import tables
from data import day


def made_rows(seed=5, products=20, days=12, high=9):
    rng = random.Random(seed)
    rows = []
    for p, d in itertools.product(range(1, products + 1), range(days)):
        f = [rng.randrange(high) for _ in FEATURES]
        rows.append((p, day(d), *f, 3 * f[3] + f[0] * (f[1] > 4) + rng.randrange(2)))
    return rows


def frame(spark, rows):
    columns = ", ".join(f"{c} long" for c in (*FEATURES, TARGET))
    return spark.createDataFrame(rows, "product_id long, date date, " + columns)


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "gold")
    frame(spark, made_rows()).write.parquet(path)
    return spark.read.parquet(path)


def plain_boost(rows, rounds, rate, growth):
    """Exact greedy boosting over (features, y) rows; one node after the other."""
    steps = [math.floor(y * 65536 + 0.5) for _, y in rows]
    base = sum(steps) / 65536 / len(rows)
    cuts = []
    for j in range(len(FEATURES)):
        levels = sorted({x[j] for x, _ in rows})
        cuts.append([(a + b) / 2 for a, b in zip(levels, levels[1:])])
    margin = [base] * len(rows)
    trees = []

    def best(own, g):
        total, n = sum(g[i] for i in own) / 65536, len(own)
        found = None
        for j, cut in ((j, c) for j in range(len(FEATURES)) for c in cuts[j]):
            left = [i for i in own if rows[i][0][j] < cut]
            a, m = sum(g[i] for i in left) / 65536, len(left)
            b, k = total - a, n - m
            if min(m, k) < max(growth.min_rows, growth.min_weight, 1):
                continue
            gain = a * a / (m + growth.l2) + b * b / (k + growth.l2) - total * total / (n + growth.l2)
            if gain > 1e-9 and (found is None or gain > found[0]):
                found = (gain, j, cut)
        return found

    for _ in range(rounds):
        g = [math.floor((y - m) * 65536 + 0.5) for (_, y), m in zip(rows, margin)]
        leaves = [(list(range(len(rows))), 0)]
        open_ = {0: best(leaves[0][0], g)}
        limit = growth.max_leaves or 10**9
        while len(leaves) < limit:
            able = [(s[0], -k) for k, s in open_.items() if s and leaves[k][1] < growth.max_depth]
            if not able:
                break
            k = -max(able)[1]
            own, depth = leaves[k]
            _, j, cut = open_[k]
            sides = [i for i in own if rows[i][0][j] < cut], [i for i in own if rows[i][0][j] >= cut]
            leaves[k] = (sides[0], depth + 1)
            leaves.append((sides[1], depth + 1))
            open_[k], open_[len(leaves) - 1] = best(sides[0], g), best(sides[1], g)
        for own, _ in leaves:
            value = rate * (sum(g[i] for i in own) / 65536 / (len(own) + growth.l2))
            for i in own:
                margin[i] += value
        trees.append(len(leaves))
    return margin, trees


GROWTHS = {
    "by depth": Growth(max_depth=3, l2=1.0),
    "few leaves": Growth(max_depth=8, max_leaves=6, l2=0.0, min_rows=10, min_weight=0.0),
    "deep and narrow": Growth(max_depth=12, max_leaves=9, l2=0.5, min_rows=2, min_weight=0.0),
}


@pytest.mark.parametrize("name", GROWTHS)
def test_equals_plain_greedy_search(spark, gold, name):
    growth = GROWTHS[name]
    rounds = 3
    trees = models.boosted_trees(gold, Boosting(rounds, 0.3, growth=growth))
    data = [(tuple(float(x) for x in r[2:9]), float(r[9])) for r in sorted(made_rows())]
    want, sizes = plain_boost(data, rounds, 0.3, growth)
    scored = scoring.with_prediction(gold, trees.pipeline()).orderBy("product_id", "date").collect()
    assert [r["prediction"] for r in scored] == pytest.approx(want, abs=1e-9)
    assert [sum(n.feature is None for n in t) for t in trees.trees] == sizes


def test_leafwise_has_exactly_the_leaves_asked_for(gold):
    how = models.leafwise_settings({"n_estimators": 2, "num_leaves": 7, "min_child_samples": 3})
    trees = models.boosted_trees(gold, how)
    assert [sum(n.feature is None for n in t) for t in trees.trees] == [7, 7]
    assert models.leafwise_settings().growth.max_leaves == 31
    with pytest.raises(ValueError):
        models.leafwise_settings({"num_leaves": 1})
    with pytest.raises(ValueError):
        models.second_order_settings({"max_depth": 99})


def test_more_regularisation_means_smaller_leaves(gold):
    def largest(l2):
        trees = models.boosted_trees(gold, Boosting(1, 1.0, growth=Growth(max_depth=2, l2=l2)))
        return max(abs(leaf.value) for leaf in trees.leaves())

    sizes = [largest(l2) for l2 in (0.0, 1.0, 10.0, 100.0)]
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == 4


def test_child_weight_and_rows_bound_the_leaves(gold):
    for growth in (Growth(max_depth=6, min_weight=25.0), Growth(max_depth=6, min_rows=25, max_leaves=20)):
        trees = models.boosted_trees(gold, Boosting(2, growth=growth))
        assert all(n.cover >= 25 for t in trees.trees for n in t)


def test_same_trees_in_any_partitioning(gold):
    how = models.second_order_settings({"n_estimators": 4, "max_depth": 3})
    one = models.boosted_trees(gold, how)
    two = models.boosted_trees(gold.repartition(5, F.rand(3)), how)
    assert one == two
    assert one != models.boosted_trees(gold, how, seed=1)


def test_samples_follow_the_seed_and_the_round(spark, gold):
    assert boosting.sampled_columns(1, 0, 0.8, 7) == boosting.sampled_columns(1, 0, 0.8, 7)
    drawn = {tuple(boosting.sampled_columns(1, t, 0.8, 7)) for t in range(30)}
    assert {len(d) for d in drawn} == {5} and len(drawn) > 5
    taken = [
        {(r[0], r[1]) for r in gold.where(boosting.sampled_rows(4, t, 0.5)).select("product_id", "date").collect()}
        for t in range(3)
    ]
    assert all(80 < len(t) < 160 for t in taken) and len(taken[0] & taken[1]) < 0.7 * len(taken[0])


def test_many_values_are_cut_at_even_shares(spark):
    rows = spark.range(5000).select((F.col("id") * 1.5).alias("a"), F.lit(2.0).alias("b"))
    cuts = boosting.feature_cuts(rows, ["a", "b"], 16)
    assert cuts[1] == [] and len(cuts[0]) == 15
    counts = boosting.with_bins(rows, ["a", "b"], cuts).groupBy("_bin0").count().collect()
    assert {r["count"] for r in counts} <= set(range(300, 326)) and len(counts) == 16


def test_margins_are_stored_and_cleared(spark, gold, monkeypatch):
    how = Boosting(5, 0.5, growth=Growth(max_depth=2))
    want = models.boosted_trees(gold, how)
    monkeypatch.setattr(boosting, "ROUNDS_AT_ONCE", 2)
    got = models.boosted_trees(gold, how)
    assert [[(n.feature, n.cut) for n in t if n.feature] for t in got.trees] == [
        [(n.feature, n.cut) for n in t if n.feature] for t in want.trees
    ]
    from basketry import scratch

    assert not [p for p in scratch._made if "margin" in p]


def test_one_row_one_value_no_rows(spark, gold):
    how = Boosting(2, growth=Growth(max_depth=2))
    one = models.boosted_trees(gold.limit(1), how)
    assert [len(t) for t in one.trees] == [1, 1]
    flat = models.boosted_trees(gold.withColumn(TARGET, F.lit(4)), how)
    assert flat.base == 4.0 and all(leaf.value == 0 for leaf in flat.leaves())
    with pytest.raises(ValueError, match="no rows"):
        models.boosted_trees(gold.limit(0), how)


def test_tables_and_pipelines_go_round(spark, gold, tmp_path):
    trees = models.boosted_trees(gold, Boosting(3, growth=Growth(max_depth=3)))
    trees.save(spark, str(tmp_path / "trees"))
    assert Ensemble.load(spark, str(tmp_path / "trees")) == trees
    tables.save_model(trees.pipeline(), str(tmp_path / "model"))
    back = tables.load_model(str(tmp_path / "model"))
    one, two = (scoring.with_prediction(gold, m).orderBy("product_id", "date").collect() for m in (trees.pipeline(), back))
    assert one == two


def test_level_job_counts_before_it_shuffles(gold):
    rows = gold.select(
        F.lit(1).cast("long").alias("_g"), F.lit(1).cast("long").alias("_w"), *(F.lit(0).alias(f"_bin{j}") for j in range(2))
    )
    seen = {}
    original = type(rows).toArrow

    def spy(df):
        seen["plan"] = df._jdf.queryExecution().toString()
        return original(df)

    type(rows).toArrow, kept = spy, original
    try:
        boosting._tables(rows, [boosting._Open(0, None)], {0}, [0, 1], 2)
    finally:
        type(rows).toArrow = kept
    assert "partial_sum" in seen["plan"] and seen["plan"].count("Exchange hashpartitioning") <= 2
    assert "Python" not in seen["plan"]


def test_keyed_models_beat_the_baselines(gold):
    split = splits.split_first_n(gold, 8, 4)
    small = {
        "forest_keyed": {"n_estimators": 5, "max_depth": 4},
        "gbt_second_order": {"n_estimators": 6, "max_depth": 4, "learning_rate": 0.5},
        "gbt_leafwise": {"n_estimators": 6, "num_leaves": 8, "learning_rate": 0.5, "min_child_samples": 4},
    }
    table, fitted = models.evaluate_models(split, params=small, models=tuple(small))
    found = {r["model"]: r["mae"] for r in table.collect()}
    assert set(fitted) == set(small)
    assert all(found[m] < min(found[b] for b in ("lag1", "ma7", "hist_mean")) for m in small)


def test_bags_are_poisson_and_fixed_by_the_key(spark):
    from basketry.operators import bagging

    rows = spark.range(20_000).select(F.col("id").alias("product_id"), F.lit(day(0)).alias("date"))
    drawn = rows.select(
        *(bagging.draws(F.col("product_id"), F.col("date"), 42, t).alias(f"t{t}") for t in range(2))
    )
    shares = {r["t0"]: r["count"] / 20_000 for r in drawn.groupBy("t0").count().collect()}
    for k in range(4):
        assert shares[float(k)] == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.02)
    means = drawn.agg(F.avg("t0"), F.avg("t1"), F.corr("t0", "t1")).first()
    assert means[0] == pytest.approx(1, abs=0.03) and means[1] == pytest.approx(1, abs=0.03) and abs(means[2]) < 0.03


def test_keyed_forest_ignores_partitioning(gold):
    params = {"n_estimators": 3, "max_depth": 3}
    one, two = (
        scoring.with_prediction(gold, models.fit_forest_keyed(g, params=params)).orderBy("product_id", "date").collect()
        for g in (gold, gold.repartition(7, F.rand(1)))
    )
    assert [r["prediction"] for r in one] == pytest.approx([r["prediction"] for r in two], abs=1e-12)


def test_draws_hash_a_key_once(spark):
    from basketry.functions.ordering import SAMPLE_PRIME, key_hash, sample_factors
    from basketry.operators import bagging

    keys = [(0, day(0)), (-1, day(1)), (2**63 - 1, day(2)), (-(2**63), day(3)), (2**61 - 1, day(4)), (None, day(5)), (3, None)]
    rows = spark.createDataFrame(keys, "product_id long, date date")
    key, found = (F.col("product_id"), F.col("date")), []
    drawn = rows.select(*key, bagging.draws(*key, 42, 1).alias("n"), key_hash(*key, 42 * 1_000_003 + 1).alias("h"))
    plan = drawn.select("n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("unix_date") == 1  # the comparisons do not repeat the hash
    a, b, c, d = sample_factors(42 * 1_000_003 + 1)
    for r in drawn.collect():
        if r["product_id"] is None or r["date"] is None:
            assert r["h"] is None and r["n"] is None
            continue
        days = (r["date"] - day(0, "1970-01-01")).days + 1_000_000
        first = (r["product_id"] % SAMPLE_PRIME * a + days * b + c) % SAMPLE_PRIME
        assert r["h"] == first * first * d % SAMPLE_PRIME
        assert r["n"] == sum(r["h"] >= bound for bound in bagging.poisson_bounds())
        found.append(r["n"])
    assert len(found) == 5
