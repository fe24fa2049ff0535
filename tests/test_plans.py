"""The shape of the plans: what is shuffled, scanned and joined."""

import re

from pyspark.sql import functions as F

from frames import silver
from paywarden.operators import marts, rules
from paywarden.operators.features import behaviour, first_seen_by_join, fraud_features
from paywarden.operators.hot_users import hot_user_columns
from paywarden.operators.scoring import compute_risk_score
from paywarden.plans.steps import stage_features
from workload.queries import all_queries
from workload.views import transactions

SF = "/root/testdata/sf0.001"


def plan(df, executed=False):
    if executed:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_features_cost_one_shuffle_and_four_sorts(spark):
    text = plan(behaviour(transactions(spark, SF)))
    assert text.count("Exchange") == 1 and "hashpartitioning(user_id" in text
    assert text.count("Window [") == 4 and text.count("Sort [") == 4
    assert "collect_set" not in text and "Python" not in text


def test_no_feature_frame_slides(spark):
    text = plan(behaviour(transactions(spark, SF)))
    frames = set(re.findall(r"specifiedwindowframe\(RangeFrame, ([^,]+),", text))
    assert frames == {"unboundedpreceding$()"}


def test_unused_columns_are_not_read(spark):
    text = plan(all_queries()["transaction_velocity"](spark, SF))
    read = re.search(r"ReadSchema: (struct<[^>]*>)", text).group(1)
    assert read == "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>"


def test_alerts_of_stored_features_only_map(spark):
    features, bounds = stage_features(transactions(spark, SF))
    text = plan(rules.detect_fraud_rules(compute_risk_score(features, bounds)))
    assert "Exchange" not in text and "Window" not in text and text.count("Scan parquet") == 1


def test_split_path_shares_its_shuffle(spark):
    text = plan(hot_user_columns(transactions(spark, SF)), executed=True)
    assert text.count("Union") == 1
    assert "ReusedExchange" in text


def test_split_path_has_no_window_over_raw_rows(spark):
    text = plan(hot_user_columns(transactions(spark, SF)))
    users_only = re.findall(r"Exchange hashpartitioning\(user_id#\d+, \d+\)", text)
    # The one shuffle by user alone carries a row per user and minute.
    assert len(users_only) == 1


def test_split_path_reads_the_rows_twice_and_sums_them_up_once(spark):
    text = plan(hot_user_columns(transactions(spark, SF)), executed=True)
    # One scan of the rows to join to; all else comes from the stored sums.
    assert len(re.findall(r"FileScan parquet .*events\.parquet", text)) == 1
    # Stays are windowed by hour blocks, never by single visits.
    assert re.findall(r"lag\([^)]*\) windowspecdefinition\(user_id#\d+L?, location#\d+, (\w+)#", text) == ["_hour"]
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", text)) <= 12


# Streams with timers run Python beside Spark's own state store.
STREAMS_IN_PYTHON = {"stream_transaction_velocity"}


def test_no_cross_joins_and_no_python(spark):
    for name, query in all_queries().items():
        if name in STREAMS_IN_PYTHON:
            continue
        text = plan(query(spark, SF))
        assert not re.search(r"Cartesian|BroadcastNestedLoop|PythonUDF|ArrowEval|MapInPandas", text), name


def test_filters_on_stored_tables_reach_the_scan(spark):
    scored = compute_risk_score(*stage_features(transactions(spark, SF)))
    text = plan(scored.where("amount > 2000").select("transaction_id"))
    assert "GreaterThan(amount,2000.0)" in text


def test_counts_combine_before_the_shuffle(spark):
    rows = silver(spark, [{}])
    for mart in (marts.top_users(rows), marts.daily_volume(rows), marts.amount_histogram(rows)):
        assert "partial_count" in plan(mart)


def test_lazy_score_needs_two_shuffles_at_most_per_pass(spark):
    text = plan(compute_risk_score(fraud_features(transactions(spark, SF))))
    assert "Join" not in text


def test_skewed_keys_are_split_at_run_time(spark, tmp_path):
    """A third of the rows with one user, device, location and instant."""
    hot = F.col("id") % 3 == 0
    other = F.pmod(F.hash("id"), F.lit(5000))
    rows = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("u"), other)).alias("user_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("merchant_id"),
        F.lit(1.5).alias("amount"),
        F.lit("x").alias("location"),
        F.lit("d").alias("device_id"),
        F.lit("upi").alias("payment_method"),
        F.timestamp_seconds(F.when(hot, 0).otherwise(other)).alias("timestamp"),
        F.lit("success").alias("transaction_status"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        for compute, joins in ((first_seen_by_join, 1), (hot_user_columns, 2)):
            result = compute(stored)
            count = result.toArrow().num_rows
            text = result._jdf.queryExecution().executedPlan().toString()
            assert text.split("== Initial Plan ==")[0].count("skew=true") == joins
            assert count == 200_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_running_totals_of_big_users_take_one_sort(spark):
    text = plan(hot_user_columns(transactions(spark, SF), ["transaction_velocity", "daily_transaction_count"]))
    sorts = [s for s in re.findall(r"Sort \[([^\]]*)\]", text) if "_block" in s and ("timestamp" in s or "_second" in s)]
    assert len(sorts) == 1
