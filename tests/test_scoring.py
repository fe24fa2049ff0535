import pytest
from pyspark.sql import functions as F

from frames import column, features
from paywarden.functions.scores import risk_bucket
from paywarden.operators.scoring import compute_risk_score, feature_min_max


def test_scores_by_hand(spark):
    rows = features(spark, [("a", 1, 1, 1), ("b", 3, 2, 1), ("c", 2, 1, 3)])
    scored = compute_risk_score(rows)
    half, full = 1 / (2 + 1e-6), 2 / (2 + 1e-6)
    one = 1 / (1 + 1e-6)
    expected = [0.0, 0.4 * full + 0.3 * one, 0.4 * half + 0.3 * full]
    assert column(scored, "risk_score") == pytest.approx(expected, abs=1e-12)
    assert column(scored, "risk_level") == ["LOW", "MEDIUM", "MEDIUM"]


def test_constant_features_score_zero(spark):
    scored = compute_risk_score(features(spark, [("a", 4, 2, 2), ("b", 4, 2, 2)]))
    assert column(scored, "risk_score") == [0.0, 0.0]
    assert column(scored, "risk_level") == ["LOW", "LOW"]


def test_three_sources_of_bounds_agree(spark):
    rows = features(spark, [("a", 1, 1, 1), ("b", 9, 4, 2), ("c", 5, 2, 2)])
    bounds = feature_min_max(rows)
    results = [
        compute_risk_score(rows, stats).orderBy("transaction_id").collect()
        for stats in (None, bounds, bounds.first(), bounds.first().asDict())
    ]
    assert all(r == results[0] for r in results)


def test_saved_bounds_make_scores_independent_of_the_batch(spark):
    rows = features(spark, [("a", 1, 1, 1), ("b", 9, 4, 2), ("c", 5, 2, 2)])
    bounds = feature_min_max(rows)
    whole = column(compute_risk_score(rows, bounds), "risk_score")
    alone = column(compute_risk_score(rows.where("transaction_id = 'c'"), bounds), "risk_score")
    assert alone == whole[2:]


def test_highest_score_stays_below_one(spark):
    top = compute_risk_score(features(spark, [("a", 1, 1, 1), ("b", 2, 2, 2)])).agg(F.max("risk_score"))
    assert 0.99 < top.first()[0] < 1.0


def test_empty_batch(spark):
    nothing = features(spark, [])
    assert compute_risk_score(nothing).count() == 0
    assert compute_risk_score(nothing, feature_min_max(nothing).first()).count() == 0


def test_level_thresholds(spark):
    scores = spark.createDataFrame(
        [(0.29999987,), (0.3,), (0.69999,), (0.7,), (None,)], "s double"
    )
    levels = [r[0] for r in scores.select(risk_bucket(F.col("s"))).collect()]
    assert levels == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


def test_scoring_joins_nothing(spark):
    rows = features(spark, [("a", 1, 1, 1)])
    plan = compute_risk_score(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    known = compute_risk_score(rows, feature_min_max(rows).first())
    assert "Exchange" not in known._jdf.queryExecution().executedPlan().toString()
