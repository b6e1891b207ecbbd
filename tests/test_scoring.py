from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketry.operators import scoring
from basketry.settings import FEATURES
from data import day

GOLD = [
    # product, day, views, carts, removals, purchases, next, views_7d, carts_7d, purchases_7d
    (1, 0, 5, 1, 0, 2, 3, 5, 1, 2),
    (1, 1, 4, 1, 0, 3, None, 9, 2, 5),
    (2, 0, 9, 0, 0, 4, 1, 9, 0, 4),
    (3, 0, None, 0, 0, 4, 4, None, 0, 4),
    (4, 0, 1, 0, 0, 0, 0, 1, 0, 0),
]


@pytest.fixture
def gold(spark):
    columns = "views carts removals purchases purchases_next_day views_7d carts_7d purchases_7d".split()
    return spark.createDataFrame(
        [(r[0], day(r[1]), *r[2:]) for r in GOLD],
        "product_id long, date date, " + ", ".join(f"{c} long" for c in columns),
    )


def asked(spark, *pairs):
    return spark.createDataFrame(list(pairs), "product_id long, date string")


def test_lookup(spark, gold):
    wanted = asked(spark, (1, str(day(0))), (-1, str(day(0))), (1, "2024-1-1"), (1, str(day(1))))
    out = {(r["product_id"], r["date"]): r for r in scoring.score(gold, wanted).collect()}
    hit = out[(1, str(day(0)))]
    assert hit["predicted_purchases_next_day"] == 2.0
    assert hit["actual_purchases_next_day"] == 3.0
    assert hit["prediction_error"] == -1.0
    assert hit["features_used"] == dict(zip(FEATURES, (5.0, 1.0, 0.0, 2.0, 5.0, 1.0, 2.0)))
    assert hit["note"] is None and hit["model_used"] == "lag1"
    last = out[(1, str(day(1)))]
    assert last["actual_purchases_next_day"] is None and last["prediction_error"] is None
    for key in ((-1, str(day(0))), (1, "2024-1-1")):
        assert out[key]["predicted_purchases_next_day"] == 0.0
        assert out[key]["features_used"] == {}
        assert "no data" in out[key]["note"]


def test_repeated_requests_are_all_answered(spark, gold):
    wanted = asked(spark, *[(2, str(day(0)))] * 50, (9, str(day(0))))
    answers = scoring.score(gold, wanted)
    assert answers.count() == 51
    assert answers.where("note IS NULL").count() == 50


def test_a_key_is_scored_once_however_often_it_is_asked(spark, gold, rows):
    wanted = asked(spark, *[(1, str(day(0)))] * 3, (2, str(day(1))))
    out = scoring.score(gold, wanted)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "strategy=broadcast" not in plan
    assert out.count() == 4 and len(set(rows(out.drop("features_used")))) == 2


def test_requests_without_a_usable_key(spark, gold):
    out = scoring.score(gold, asked(spark, (1, "soon"), (None, None))).collect()
    assert [r["predicted_purchases_next_day"] for r in out] == [0.0, 0.0]


def test_missing_features_score_as_zero_and_stay_missing(spark, gold):
    scorer = F.col("views") + F.col("purchases") * 10
    out = scoring.with_prediction(gold.where("product_id = 3"), scorer).first()
    assert out["prediction"] == 40.0 and out["views"] is None


def test_top_products(spark, gold):
    got = [tuple(r) for r in scoring.top_products(gold, 3).collect()]
    assert got == [(1, 5), (2, 4), (3, 4)]


def test_top_predicted(spark, gold):
    got = scoring.top_predicted(gold, str(day(0)), limit=3).orderBy("rank").collect()
    assert [r["rank"] for r in got] == [1, 2, 3]
    assert [r["product_id"] for r in got] == [2, 3, 1]
    predictions = [r["predicted_purchases_next_day"] for r in got]
    assert predictions == sorted(predictions, reverse=True)
    assert [r["prediction_error"] for r in got] == [3.0, 0.0, -1.0]
    busy = scoring.top_predicted(gold, str(day(0)), min_views=2).collect()
    assert {r["product_id"] for r in busy} == {1, 2}
    for other in ("2099-01-01", "2024-1-1", "20240101", "soon"):
        assert scoring.top_predicted(gold, other).count() == 0


def test_top_predicted_limit(gold):
    with pytest.raises(ValueError, match="at least one row"):
        scoring.top_predicted(gold, str(day(0)), limit=0)
    assert scoring.top_predicted(gold, str(day(0)), limit=500).count() > 0


def test_status_notes(spark, gold):
    status = lambda *a: scoring.top_predicted_status(gold, *a).first()
    note = lambda *a: status(*a)["note"]
    assert note(str(day(0))) is None
    assert note("2099-01-01") == "no gold rows for date 2099-01-01"
    assert status("2099-01-01")[-2:] == ("2024-01-01", "2024-01-02")
    assert note(str(day(0)), 50.0) == "no products with views >= 50.0 on 2024-01-01"


def test_date_range(gold):
    assert tuple(scoring.gold_date_range(gold).first()) == ("2024-01-01", "2024-01-02")
