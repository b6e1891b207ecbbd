from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import attribution as attr, models, scoring, splits, tuning
from basketry.plans import analysis, experiments
from basketry.settings import FEATURES, MODEL_DEFAULTS, MODELS, SEARCH_SPACES, TARGET
from basketry.sources import tables
from data import day

SMALL = {
    "random_forest": {"n_estimators": 5, "max_depth": 4},
    "gbt_depthwise": {"n_estimators": 3, "max_depth": 3},
    "gbt_leafcap": {"n_estimators": 3, "num_leaves": 8},
}


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    """A target that follows purchases and views, which no baseline sees."""
    rng = random.Random(11)
    rows = []
    for p in range(1, 31):
        for d in range(20):
            f = [rng.randrange(10) for _ in FEATURES]
            rows.append((p, day(d), *f, 3 * f[3] + f[0] + rng.randrange(2)))
    columns = ", ".join(f"{c} long" for c in (*FEATURES, TARGET))
    path = str(tmp_path_factory.mktemp("gold") / "gold")
    spark.createDataFrame(rows, "product_id long, date date, " + columns).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def split(gold):
    return splits.split_first_n(gold, 14, 6)


def predictions(model, df):
    rows = scoring.with_prediction(df, model).select("product_id", "date", "prediction").collect()
    return sorted(tuple(r) for r in rows)


def test_trees_beat_the_baselines(split):
    table, fitted = models.evaluate_models(split, params=SMALL)
    found = {r["model"]: r for r in table.collect()}
    assert list(r["model"] for r in table.collect()) == list(MODELS)
    assert set(fitted) == set(SMALL)
    assert found["random_forest"]["mae"] < min(found[b]["mae"] for b in ("lag1", "ma7", "hist_mean"))
    assert all(r["n"] == split.test_rows for r in found.values())


def test_unlabelled_rows_are_left_out(split, gold):
    holes = gold.withColumn(TARGET, F.when(F.col("product_id") > 3, F.col(TARGET)))
    table = models.evaluate_baselines(splits.split_first_n(holes, 14, 6))
    assert {r["n"] for r in table.collect()} == {27 * 6}


def test_a_seed_fixes_the_forest(split):
    params = SMALL["random_forest"]
    one = models.fit_random_forest(split.train, params=params)
    two = models.fit_random_forest(split.train.repartition(5), params=params)
    other = models.fit_random_forest(split.train, seed=7, params=params)
    assert predictions(one, split.test) == predictions(two, split.test)
    assert predictions(one, split.test) != predictions(other, split.test)


def test_save_and_load(split, tmp_path):
    model = models.fit_gbt_leafcap(split.train, params=SMALL["gbt_leafcap"])
    tables.save_model(model, str(tmp_path / "m"))
    loaded = tables.load_model(str(tmp_path / "m"))
    assert predictions(loaded, split.test) == predictions(model, split.test)


def test_parameters_reach_the_trees(split):
    def regressor(model):
        return model.stages[-1]

    forest = regressor(
        models.fit_random_forest(
            split.train, params={"n_estimators": 2, "max_depth": None, "max_features": 0.5}
        )
    )
    assert forest.getNumTrees == 2 and forest.getMaxDepth() == models.DEEPEST
    assert forest.getFeatureSubsetStrategy() == "0.5" and forest.getMinInstancesPerNode() == 5
    leaf = regressor(
        models.fit_gbt_leafcap(
            split.train, params={"n_estimators": 1, "num_leaves": 31, "subsample": 0.7}
        )
    )
    assert leaf.getMaxDepth() == 5 and leaf.getSubsamplingRate() == 1.0
    deep = regressor(models.fit_gbt_depthwise(split.train, params={"n_estimators": 1}))
    assert deep.getMaxDepth() == 8 and deep.getSubsamplingRate() == 0.8


def test_features_are_used_as_they_are(spark):
    # shares of 0.01 and 0.1 tell the two groups apart
    frame = spark.range(400).select(
        F.col("id").alias("product_id"),
        F.lit(day(0)).alias("date"),
        *[F.lit(1.0).alias(c) for c in FEATURES[1:]],
        F.when(F.col("id") % 2 == 0, 0.01).otherwise(0.1).alias(FEATURES[0]),
        (F.col("id") % 2 * 10.0).alias(TARGET),
    )
    forest = models.fit_random_forest(frame, params={"n_estimators": 1, "max_depth": 1, "bootstrap": False})
    got = {r[0] for r in scoring.with_prediction(frame, forest).select("prediction").collect()}
    assert got == {0.0, 10.0}
    # the same rows twice give the same split
    twice = models.fit_random_forest(
        frame.union(frame), params={"n_estimators": 1, "max_depth": 1, "bootstrap": False}
    )
    assert twice.stages[-1].toDebugString.splitlines()[2:] == forest.stages[-1].toDebugString.splitlines()[2:]


def test_a_depth_beyond_the_engine_is_an_error(split):
    with pytest.raises(ValueError, match="max_depth"):
        models.fit_random_forest(split.train, params={"max_depth": 40})


def test_a_rare_giant_does_not_spoil_the_others(spark):
    # 12 of 120,000 rows are a thousand times larger than the rest
    giant = F.col("id") % 10_000 == 0
    size = F.when(giant, 50_000 + F.col("id") % 7).otherwise(F.xxhash64("id") % 5 + 5)
    frame = spark.range(120_000).select(
        F.col("id").alias("product_id"),
        F.lit(day(0)).alias("date"),
        *[size.cast("double").alias(c) for c in FEATURES],
        (size / 10).alias(TARGET),
    )
    params = {"n_estimators": 3, "max_depth": 4, "min_samples_leaf": 2}
    forest = models.fit_random_forest(frame, params=params)
    assert forest.stages[-1].getMaxBins() ** 2 >= 120_000
    error = F.abs(F.col(TARGET) - F.col("prediction"))
    scored = scoring.with_prediction(frame.where(f"{TARGET} < 100"), forest)
    assert scored.agg(F.max(error)).first()[0] < 0.5


def test_unknown_parameters_are_an_error(split):
    with pytest.raises(ValueError, match="num_leaves"):
        models.fit_random_forest(split.train, params={"num_leaves": 3})


def test_search_space_fits_the_models():
    extra = {"gbt_leafcap": {"num_leaves", "min_child_samples", "subsample"}}
    for model, space in SEARCH_SPACES.items():
        assert set(space) <= set(MODEL_DEFAULTS[model]) | extra.get(model, set())
        assert len(tuning.draw_params(space, 10_000)) == {"random_forest": 135}.get(model, 243)


def test_draws_are_distinct_and_repeatable():
    draws = tuning.draw_params(SEARCH_SPACES["random_forest"], 12)
    assert draws == tuning.draw_params(SEARCH_SPACES["random_forest"], 12)
    assert len({json.dumps(d) for d in draws}) == 12


def test_tuning_prefers_the_useful_setting(split):
    spaces = {"random_forest": {"n_estimators": [5], "max_depth": [1, 6], "max_features": ["all"]}}
    found = tuning.tune(split.train, spaces, n_iter=5, n_splits=2)
    trials = found.trials.collect()
    assert len(trials) == 2 and sum(t["is_best"] for t in trials) == 1
    assert found.best["random_forest"]["max_depth"] == 6
    for t in trials:
        assert t["cv_mae"] == pytest.approx(sum(t["fold_mae"]) / 2)


def test_attribution_of_a_linear_scorer(split):
    weights = [0.5, -1.0, 2.0, 0.0, 0.25, 1.5, -0.75]
    scorer = sum((F.col(c) * w for c, w in zip(FEATURES, weights)), F.lit(0.0))
    sample, background = attr.attribution_sample(split.test, 25), attr.background_rows(split.train, 9)
    centre = {c: background.agg(F.avg(c)).first()[0] for c in FEATURES}
    inputs = {(r["product_id"], r["date"]): r for r in sample.collect()}
    got = attr.attribution(scorer, sample, background).collect()
    assert len(got) == 25
    for row in got:
        x = inputs[(row["product_id"], row["date"])]
        for c, w in zip(FEATURES, weights):
            assert row[f"phi_{c}"] == pytest.approx(w * (x[c] - centre[c]), abs=1e-9)


def test_attribution_of_a_forest_adds_up(split):
    forest = models.fit_random_forest(split.train, params=SMALL["random_forest"])
    background = attr.background_rows(split.train, 6)
    got = attr.attribution(forest, attr.attribution_sample(split.test, 12), background)
    base = scoring.with_prediction(background, forest).agg(F.avg("prediction")).first()[0]
    for row in got.collect():
        total = sum(row[f"phi_{c}"] for c in FEATURES)
        assert row["base_value"] == pytest.approx(base)
        assert total == pytest.approx(row["prediction"] - base, abs=1e-9)
    ranking = attr.attribution_ranking(got).collect()
    assert ranking[0]["feature"] == "purchases"
    assert [r["mean_abs"] for r in ranking] == sorted((r["mean_abs"] for r in ranking), reverse=True)


def test_attribution_sample_is_exact_and_stable(split, rows):
    hashed = split.test.select("product_id", "date")
    sample = attr.attribution_sample(hashed, 30)
    assert sample.count() == 30
    assert rows(sample) == rows(attr.attribution_sample(hashed.repartition(7), 30))
    assert attr.attribution_sample(hashed, 10_000).count() == hashed.count()
    want = hashed.orderBy(attr.key_hash(F.col("product_id"), F.col("date"), 42), "product_id", "date")
    assert rows(sample) == rows(want.limit(30))


def test_background_size_is_checked(split):
    with pytest.raises(ValueError, match="background"):
        attr.attribution(F.col("views"), split.test, split.train, most_background=5)


CONFIGS = {
    "e1": {"train_days": 14, "test_days": 6},
    "e2": {"train_end": day(9), "test_start": day(11), "test_days": 4},
    "e_final": {"train_end": day(11), "test_start": day(12), "test_days": 8},
}


def test_experiments(gold, tmp_path, spark, rows):
    run = experiments.run_experiments(
        gold, CONFIGS, params=SMALL, models=("random_forest", "gbt_leafcap")
    )
    table = run.results.collect()
    assert len(table) == 15 and not run.skipped
    best = {r["experiment"]: r["model"] for r in table if r["is_best"]}
    assert set(best) == set(CONFIGS)
    e2 = next(r for r in table if r["experiment"] == "e2")
    assert e2["train_dates"][-1] == day(9) and e2["test_dates"][0] == day(11)
    assert (e2["train_rows"], e2["test_rows"]) == (300, 120)
    assert run.serving["experiment"] == "e_final"
    assert run.serving["model_name"] in ("random_forest", "gbt_leafcap")
    assert run.serving_model is run.fitted["e_final"][run.serving["model_name"]]

    experiments.save_run(run, str(tmp_path))
    back = tables.read_results(spark, f"{tmp_path}/results")
    assert rows(back, "experiment", "model", "mae") == rows(run.results, "experiment", "model", "mae")
    served = tables.load_model(f"{tmp_path}/models/e_final/{run.serving['model_name']}")
    assert predictions(served, gold) == predictions(run.serving_model, gold)
    info = experiments.load_serving(spark, str(tmp_path))
    assert info["model_name"] == run.serving["model_name"]
    assert (info["feature_columns"], info["target"]) == (list(FEATURES), TARGET)


def test_a_saved_run_is_analysed_on_its_window(gold, tmp_path, spark):
    root, log = str(tmp_path / "run"), str(tmp_path / "log")
    late = {**CONFIGS["e_final"], "train_end": "2030-01-01", "test_start": "2030-01-02"}
    configs = {"e1": CONFIGS["e1"], "e_final": late}
    run = experiments.run_experiments(
        gold, configs, params=SMALL, models=("random_forest",), attribute="random_forest",
        attribution_rows=20, background=3,
    )
    assert run.attribution.count() == 20
    experiments.save_run(run, root, log)
    reports = analysis.analyse(gold, root, configs, log)
    summary = reports["summary"].first()
    assert summary["split"] == "e1" and summary["n_test"] == reports["pairs"].count()
    forest = next(r for r in run.results.collect() if r["model"] == "random_forest")
    assert summary["mae"] == pytest.approx(forest["mae"])
    assert reports["histogram"].agg(F.sum("residuals")).first()[0] == summary["n_test"]
    assert set(reports) == {"summary", "histogram", "activity", "pairs", "comparison"}
    assert {r[0] for r in spark.read.json(log).select("stage").collect()} == {"train", "analyze"}


def test_best_parameters_are_read_back(split, tmp_path, spark):
    space = {"random_forest": {"n_estimators": [2], "max_depth": [1, 2]}}
    found = tuning.tune(split.train, space, n_iter=2, n_splits=2)
    experiments.save_search(found, str(tmp_path), f"{tmp_path}/log")
    assert experiments.load_best_params(spark, str(tmp_path)) == found.best
    assert spark.read.json(f"{tmp_path}/log").where("stage = 'tune'").count() == 2


def test_missing_dates_skip_or_fall_back(gold):
    late = {**CONFIGS["e_final"], "train_end": "2030-01-01", "test_start": "2030-01-02"}
    configs = {"e1": CONFIGS["e1"], "e_final": late}
    run = experiments.run_experiments(gold, configs, params=SMALL, models=("random_forest",))
    assert set(run.skipped) == {"e_final"}
    assert run.serving["experiment"] == "e1" and "e_final" in run.serving["note"]
    with pytest.raises(ValueError, match="training window|test window"):
        experiments.run_experiments(gold, configs, tuned_params={})
    with pytest.raises(ValueError, match="not 99"):
        experiments.run_experiments(gold, {"e1": {"train_days": 99, "test_days": 1}})


def test_tuned_run_uses_the_given_parameters(gold):
    run = experiments.run_experiments(
        gold, CONFIGS, tuned_params=SMALL, models=("random_forest",)
    )
    assert {r["experiment"] for r in run.results.collect()} == {"e_final_tuned"}
    assert all(r["tuned"] for r in run.results.collect())
    assert run.serving["params"] == SMALL["random_forest"] and run.serving["tuned"]
    assert run.serving_model.stages[-1].getNumTrees == 5
