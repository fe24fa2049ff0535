import datetime as dt

from frames import after, silver
from paywarden.operators import marts, metrics, rules
from paywarden.operators.features import behaviour
from paywarden.operators.scoring import compute_risk_score
from paywarden.schema import RUN_LOG_SCHEMA


def pairs(df):
    return [tuple(r) for r in df.collect()]


def gold(spark, rows):
    return compute_risk_score(behaviour(silver(spark, rows)))


def test_value_counts_order_limit_and_nulls(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", "b", "a", None, "d"]], "v string")
    assert pairs(marts.value_counts(df, "v")) == [("a", 2), ("b", 2), ("c", 2), ("d", 1)]
    assert pairs(marts.value_counts(df, "v", 2)) == [("a", 2), ("b", 2)]


def test_daily_counts_leave_out_unreadable_dates_and_null_ids(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01 10:00:00"), (None, "2024-01-01 11:00:00"), ("2", "soon"),
         ("3", "2024-01-02 00:00:00")],
        "transaction_id string, timestamp string",
    )
    assert pairs(marts.daily_counts(df, "day")) == [
        (dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 1)
    ]


def test_kpis(spark):
    rows = rules.with_alert_count(
        gold(spark, [{"amount": 9000.0}, {"timestamp": after(9)}, {"location": "y", "timestamp": after(10)}])
    )
    got = marts.kpis(rows).first()
    alerts = rules.detect_fraud_rules(rows)
    flagged = alerts.select("transaction_id").distinct().count()
    assert got.transactions_processed == 3 and got.fraud_alerts == alerts.count()
    assert got.fraud_rate == round(alerts.count() / 3, 4)
    assert got.fraud_rate_distinct == round(flagged / 3, 4)


def test_kpis_of_nothing(spark):
    got = marts.kpis(rules.with_alert_count(gold(spark, []))).first()
    assert tuple(got) == (0, 0, 0.0, 0.0)


def test_table_kpis_with_the_latest_run(spark):
    log = spark.createDataFrame(
        [("r1", "2024-01-01 00:00:00", "2024-01-01 00:05:00", 3, "SUCCESS", "uploaded"),
         ("r2", "2024-01-02 00:00:00", "2024-01-02 00:05:00", 3, "SUCCESS", "uploaded")],
        RUN_LOG_SCHEMA,
    )
    scored = gold(spark, [{"amount": 9000.0}, {"timestamp": after(9)}])
    got = marts.table_kpis(scored, rules.detect_fraud_rules(scored), log).first()
    assert got.transactions_processed == 2 and got.last_run_end == "2024-01-02 00:05:00"
    assert marts.table_kpis(scored.limit(0), rules.detect_fraud_rules(scored.limit(0))).first().fraud_rate == 0.0


def test_alerts_table_is_sorted_and_ranked(spark):
    scored = gold(spark, [{"location": l, "amount": 9000.0, "timestamp": after(i)} for i, l in enumerate("xyz")])
    table = marts.alerts_table(rules.detect_fraud_rules(scored)).collect()
    scores = [r.risk_score for r in table]
    assert scores == sorted(scores, reverse=True)
    assert table[0].__fields__ == marts.DISPLAY_COLUMNS + ["severity_rank"]
    ranks = {"LOW": 1, "MEDIUM": 2, "HIGH": 3}
    assert all(r.severity_rank == ranks[r.risk_level] for r in table)


def test_alerts_table_without_display_columns_shows_all(spark):
    df = spark.createDataFrame([("t", 1.0)], "transaction_id string, other double")
    assert marts.alerts_table(df).columns == ["transaction_id", "other"]


def test_amount_histogram(spark):
    rows = silver(spark, [{"amount": float(a)} for a in (0, 1, 29.9, 30, 15)])
    assert pairs(marts.amount_histogram(rows)) == [(0, 1), (1, 1), (15, 1), (29, 2)]
    same = silver(spark, [{"amount": 5.0}] * 3)
    assert pairs(marts.amount_histogram(same)) == [(0, 3)]


def test_preview_is_the_same_every_time(spark):
    rows = silver(spark, [{"transaction_id": f"{i:04d}"} for i in range(700)]).repartition(7)
    assert [r.transaction_id for r in marts.preview(rows).collect()] == [f"{i:04d}" for i in range(500)]


def test_top_reports_do_not_sort_everything(spark):
    plan = marts.top_users(silver(spark, [{}]))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan


def test_run_metrics(spark):
    good, alerts, bad = (silver(spark, [{}] * n) for n in (4, 6, 1))
    row = metrics.run_metrics(good, alerts, bad, 10.0, 11.239).first().asDict()
    assert row == {
        "total_transactions_processed": 4, "fraud_alert_count": 6, "fraud_rate": 1.5,
        "invalid_records": 1, "pipeline_runtime_seconds": 1.24,
    }
    counted = metrics.run_metrics_from_counts(spark, 4, 6, 1, 10.0, 11.239).first().asDict()
    assert counted == row
    empty = good.limit(0)
    assert metrics.run_metrics(empty, empty, empty, 0.0, 0.0).first().fraud_rate == 0.0
