import os

import pytest

from frames import bronze, column
from paywarden.operators import rules
from paywarden.operators.features import fraud_features
from paywarden.operators.quality import routed
from paywarden.operators.scoring import compute_risk_score
from paywarden.plans import medallion, steps
from paywarden.schema import (
    ALERT_COLUMNS, CONTEXT_COLUMNS, FEATURE_COLUMNS, SCORED_COLUMNS, TRANSACTION_COLUMNS,
)
from paywarden.sources.run_log import read_run_log
from paywarden.sources.tables import read_parquet, write_csv


@pytest.fixture(scope="module")
def incoming(spark):
    rows = [
        {"transaction_id": f"t{i:02d}", "user_id": "uv"[i % 2], "location": "xyz"[i % 3],
         "device_id": "de"[i % 5 == 0], "amount": 900.0 * (i % 4),
         "timestamp": f"2024-03-01 12:{i * 7 % 60:02d}:00"}
        for i in range(20)
    ]
    rows += [rows[3], {"transaction_id": "bad", "timestamp": "soon", "amount": -1.0}]
    return bronze(spark, rows)


@pytest.fixture(scope="module")
def run(spark, incoming, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    uploads = base / "uploads"
    uploads.mkdir()
    write_csv(incoming, str(uploads))
    return base, medallion.run_medallion(spark, str(uploads), str(base / "out"))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_tables_match_the_transforms(run, incoming):
    _, result = run
    rows = routed(incoming)
    silver = rows.where("layer = 'silver'").drop("layer")
    assert same(result.silver, silver)
    assert same(result.quarantine, rows.where("layer = 'quarantine'").drop("layer"))
    scored = compute_risk_score(fraud_features(silver))
    assert same(result.gold.scored.select(*scored.columns), scored)
    assert same(result.gold.alerts, rules.detect_fraud_rules(scored))


def test_table_columns(spark, run):
    base, result = run
    assert result.gold.scored.columns == SCORED_COLUMNS
    assert result.gold.alerts.columns == ALERT_COLUMNS
    features = read_parquet(spark, str(base / "out/gold/features_gold.parquet"))
    assert features.columns == TRANSACTION_COLUMNS + FEATURE_COLUMNS + CONTEXT_COLUMNS


def test_metrics_and_log(spark, run):
    base, result = run
    metrics = result.metrics.first()
    assert metrics.total_transactions_processed == result.silver.count() == result.gold.rows
    assert metrics.fraud_alert_count == result.gold.alerts.count() > 0
    assert metrics.invalid_records == result.quarantine.count()
    log = read_run_log(spark, str(base / "out/gold/pipeline_metadata.parquet")).collect()
    assert [(r.pipeline_run_id, r.pipeline_status, r.data_source, r.records_processed) for r in log] == [
        (result.run_id, "SUCCESS", "uploaded", result.gold.rows)
    ]
    paths = [steps.layer_path(str(base / "out/cleansed"), n) for n in ("silver", "quarantine")]
    again = steps.compute_pipeline_metrics(
        spark, paths[0], str(base / "out/gold/fraud_alerts.parquet"), paths[1], 0.0, 1.0
    )
    assert again["fraud_rate"] == metrics.fraud_rate and again["invalid_records"] == metrics.invalid_records


def test_kpis_of_the_stored_tables(spark, run):
    base, result = run
    kpis, alerts, features = steps.load_kpis(spark, str(base / "out/gold"))
    row = kpis.first()
    assert row.transactions_processed == features.count() and row.fraud_alerts == alerts.count()
    assert row.last_run_end


def test_running_again_gives_the_same_tables_and_a_longer_log(spark, run):
    base, first = run
    scores = column(first.gold.scored, "risk_score")
    second = medallion.run_medallion(spark, str(base / "uploads"), str(base / "out"))
    assert column(second.gold.scored, "risk_score") == scores
    assert read_run_log(spark, str(base / "out/gold/pipeline_metadata.parquet")).count() == 2


def test_failed_run_is_logged(spark, incoming, tmp_path):
    uploads = tmp_path / "none"
    uploads.mkdir()
    with pytest.raises(ValueError):
        medallion.run_medallion(spark, str(uploads), str(tmp_path / "out"), incoming.drop("user_id"))
    log = read_run_log(spark, str(tmp_path / "out/gold/pipeline_metadata.parquet")).first()
    assert log.pipeline_status == "FAILED" and log.data_source == "synthetic"


def test_nothing_rejected_and_nothing_left(spark, tmp_path):
    for name, rows in (("good", [{}]), ("bad", [{"amount": -1.0}]), ("none", [])):
        silver, rejected, counts = steps.write_cleansed(bronze(spark, rows), str(tmp_path / name))
        assert (silver.count(), rejected.count()) == (counts["silver"], counts["quarantine"])
        gold = steps.write_gold(silver, str(tmp_path / f"{name}-gold"))
        assert gold.features.count() == gold.rows == counts["silver"]
        assert gold.alerts.count() == gold.alert_rows


def test_steps_on_paths(spark, incoming, tmp_path):
    uploads = tmp_path / "up"
    uploads.mkdir()
    bronze_path = steps.run_bronze_layer(spark, str(uploads), str(tmp_path / "bronze"), incoming)
    assert read_parquet(spark, bronze_path).count() == incoming.count()
    silver_path, quarantine_path = steps.run_silver_layer(spark, bronze_path, str(tmp_path / "clean"))
    assert os.path.isdir(silver_path) and os.path.isdir(quarantine_path)
    seen = steps.generate_fraud_features(spark, silver_path, str(tmp_path / "features"))
    assert seen["rows"] == read_parquet(spark, silver_path).count()
    gold = steps.run_gold_layer(spark, silver_path, str(tmp_path / "gold"))
    assert gold.rows == seen["rows"]


def test_path_steps_on_clean_and_on_all_bad_input(spark, tmp_path):
    from paywarden.plans.steps import compute_pipeline_metrics, run_gold_layer, run_silver_layer
    from paywarden.schema import BRONZE_SCHEMA

    row = ("t", "u", "m", 5.0, "x", "d", "card", "2024-01-01 00:00:00", "ok")
    for name, amount, expected in (("good", 5.0, (1, 0)), ("bad", -5.0, (0, 1))):
        bronze = str(tmp_path / name / "bronze")
        spark.createDataFrame([(*row[:3], amount, *row[4:])], BRONZE_SCHEMA).write.parquet(bronze)
        silver_path, rejected_path = run_silver_layer(spark, bronze, str(tmp_path / name / "cleansed"))
        gold = str(tmp_path / name / "gold")
        run_gold_layer(spark, silver_path, gold)
        got = compute_pipeline_metrics(spark, silver_path, f"{gold}/fraud_alerts.parquet", rejected_path, 0.0, 1.0)
        assert (got["total_transactions_processed"], got["invalid_records"]) == expected


def test_a_malformed_record_fails_no_run(spark, incoming, tmp_path):
    (tmp_path / "up").mkdir()
    header = ",".join(TRANSACTION_COLUMNS)
    good = "t1,u,m,12.5,here,d,upi,2024-03-01 12:00:00,success"
    (tmp_path / "up" / "a.csv").write_text("\n".join([header, good, good + ",,lost", good.replace("t1", "t2")]) + "\n")
    done = medallion.run_medallion(spark, str(tmp_path / "up"), str(tmp_path / "out"))
    assert done.silver.columns == TRANSACTION_COLUMNS
    assert column(done.silver, "transaction_id") == ["t1", "t2"]
    row = done.malformed.first()
    assert row["_corrupt_record"] == good + ",,lost" and row["_source_file"].endswith("/up/a.csv")
    assert done.metrics.first().invalid_records == 1
    bronze_table = read_parquet(spark, str(tmp_path / "out/bronze/transactions_bronze.parquet"))
    assert bronze_table.where("_source_file is not null and _ingested_at is not null").count() == 3


def test_bronze_takes_no_wrong_types(spark, incoming, tmp_path):
    wrong = incoming.selectExpr("* except (amount, user_id)", "'x' as amount")
    with pytest.raises(ValueError, match="missing column user_id; column amount is string, expected double"):
        steps.write_bronze(wrong, str(tmp_path / "b"))
    assert not (tmp_path / "b").exists()
    assert steps.write_bronze(incoming.selectExpr("* except (timestamp)", "try_cast(timestamp as timestamp) as timestamp"), str(tmp_path / "b")) == incoming.count()
