import pytest
from pyspark.sql import functions as F

from frames import after, silver
from paywarden.operators import rules
from paywarden.operators.features import behaviour, fraud_features
from paywarden.operators.scoring import compute_risk_score
from paywarden.schema import (
    ALERT_COLUMNS,
    BURST_ALERT,
    LOCATION_ALERT,
    NEW_DEVICE_ALERT,
    RISK_ALERT,
    RuleConfig,
)


def scored(spark, rows):
    return compute_risk_score(fraud_features(silver(spark, rows)))


def raised(alerts):
    return sorted((r.transaction_id, r.alert_type) for r in alerts.collect())


def of_type(alerts, name):
    return [i for i, t in raised(alerts) if t == name]


def test_only_the_eleventh_in_ten_minutes_is_a_burst(spark):
    rows = scored(
        spark, [{"transaction_id": f"t{i:02d}", "timestamp": after(60 * i)} for i in range(11)]
    )
    assert of_type(rules.detect_fraud_rules(rows), BURST_ALERT) == ["t10"]
    assert len(of_type(rules.detect_fraud_rules(rows, RuleConfig(burst_count=9)), BURST_ALERT)) == 2


def test_large_amount_on_a_new_device(spark):
    rows = scored(
        spark,
        [
            {"device_id": "a", "amount": 2000.0},
            {"device_id": "b", "amount": 2000.01},
            {"device_id": "b", "amount": 5000.0, "timestamp": after(1)},
            {"device_id": "c", "amount": 5000.0, "timestamp": after(2)},
            {"device_id": "c", "amount": 6000.0, "timestamp": after(2)},
        ],
    )
    assert of_type(rules.detect_fraud_rules(rows), NEW_DEVICE_ALERT) == ["t1", "t3", "t4"]


def test_two_locations_in_an_hour(spark):
    rows = scored(
        spark,
        [
            {"location": "x"},
            {"location": "y", "timestamp": after(3600)},
            {"location": "x", "timestamp": after(7201)},
        ],
    )
    assert of_type(rules.detect_fraud_rules(rows), LOCATION_ALERT) == ["t1"]


def test_risk_alerts_cover_medium_and_high(spark):
    rows = scored(spark, [{"location": l, "timestamp": after(i)} for i, l in enumerate("xyzw")])
    levels = {r.transaction_id: r.risk_level for r in rows.collect()}
    expected = sorted(i for i, level in levels.items() if level != "LOW")
    assert of_type(rules.detect_fraud_rules(rows), RISK_ALERT) == expected
    assert {"MEDIUM", "HIGH"} & set(levels.values())


def test_one_transaction_can_raise_all_four(spark):
    rows = [
        {"transaction_id": f"t{i:02d}", "location": "x", "timestamp": after(i)} for i in range(11)
    ]
    rows.append({"transaction_id": "z", "location": "y", "device_id": "n", "amount": 9000.0,
                 "timestamp": after(20)})
    alerts = rules.detect_fraud_rules(scored(spark, rows))
    assert [t for i, t in raised(alerts) if i == "z"] == sorted(
        [BURST_ALERT, NEW_DEVICE_ALERT, LOCATION_ALERT, RISK_ALERT]
    )
    assert alerts.columns == ALERT_COLUMNS


def test_single_rules_add_up_to_all_alerts(spark):
    rows = scored(
        spark,
        [{"location": "xy"[i % 2], "amount": 900.0 * i, "device_id": "de"[i // 2],
          "timestamp": after(700 * i)} for i in range(4)],
    )
    names = (RISK_ALERT, BURST_ALERT, NEW_DEVICE_ALERT, LOCATION_ALERT)
    parts = [pair for n in names for pair in raised(rules.alerts_of(rows, n))]
    assert sorted(parts) == raised(rules.detect_fraud_rules(rows)) and parts


def test_context_in_the_input_is_used(spark):
    table = silver(spark, [{"timestamp": after(60 * i), "location": "xy"[i % 2]} for i in range(6)])
    with_context = compute_risk_score(behaviour(table))
    without = compute_risk_score(fraud_features(table))
    assert raised(rules.detect_fraud_rules(with_context)) == raised(rules.detect_fraud_rules(without))


def test_duplicates_by_id_and_type_are_removed(spark):
    rows = scored(spark, [{"transaction_id": "same", "amount": 9000.0}] * 2)
    alerts = rules.detect_fraud_rules(rows)
    assert alerts.count() > rules.unique_alerts(alerts).count()
    pairs = raised(rules.unique_alerts(alerts))
    assert len(pairs) == len(set(pairs))


def test_no_rows_no_alerts(spark):
    assert rules.detect_fraud_rules(scored(spark, [])).count() == 0


def test_unscored_input_is_an_error(spark):
    rows = silver(spark, [{}]).withColumn("transaction_velocity", F.lit(11))
    with pytest.raises(ValueError, match="risk_level"):
        rules.detect_fraud_rules(rows)
