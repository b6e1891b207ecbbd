"""The registered search makes every draw from the real spaces on every fold."""

from __future__ import annotations

import json
import threading

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer

import __spark_entry__ as contract
from basketry.operators import tuning
from basketry.settings import SEARCH_DRAWS, SEARCH_FOLDS, SEARCH_SPACES

SF_DIR = "/root/testdata/sf0.001"


def _forecast(params) -> float:
    # another one for each set, the best of them neither first nor last
    return float(sum(map(ord, json.dumps(params, sort_keys=True))) % 97) / 10


def test_the_registered_search_is_the_whole_one(spark, monkeypatch):
    fits, lock = [], threading.Lock()

    def fit(model, rows, features, target, seed, params):
        with lock:
            fits.append((model, json.dumps(params, sort_keys=True)))
        return PipelineModel([SQLTransformer(statement=f"SELECT *, {_forecast(params)}D AS prediction FROM __THIS__")])

    monkeypatch.setattr(tuning, "fit_rows", fit)
    trials = contract.queries()["tune_models"](spark, SF_DIR).collect()
    assert (SEARCH_DRAWS, SEARCH_FOLDS) == (12, 3)
    drawn = {
        (m, k): json.dumps(p, sort_keys=True)
        for m, space in SEARCH_SPACES.items()
        for k, p in enumerate(tuning.draw_params(space, SEARCH_DRAWS))
    }
    assert len(drawn) == 36
    assert {(r["model"], r["trial"]): r["params"] for r in trials} == drawn
    assert sorted(fits) == sorted((m, p) for (m, _), p in drawn.items() for _ in range(SEARCH_FOLDS))
    for model in SEARCH_SPACES:
        own = [r for r in trials if r["model"] == model]
        best = [r for r in own if r["is_best"]]
        assert len(best) == 1 and best[0]["cv_mae"] == min(r["cv_mae"] for r in own)
