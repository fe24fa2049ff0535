"""All queries: name -> function of (spark, folder of tables)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywarden.functions.times import without_time_zone
from paywarden.operators import features as feat, hot_users, marts, metrics, quality, rules, scoring
from paywarden.operators.first_seen import with_first_seen
from paywarden.plans import incremental
from paywarden.plans.steps import stage_features, write_cleansed
from paywarden.schema import (
    BURST_ALERT,
    CONTEXT_COLUMNS,
    CORRUPT_RECORD,
    FEATURE_COLUMNS,
    LOCATION_ALERT,
    NEW_DEVICE_ALERT,
    RISK_ALERT,
    SILVER_SCHEMA,
    TRANSACTION_COLUMNS,
    RuleConfig,
    SkewConfig,
)
from paywarden.sources.dated import read_days, write_days
from paywarden.sources.tables import shared_folder, stage
from paywarden.sources.uploads import read_csv
from paywarden.streaming import silver as cleansing, velocity
from workload.views import bronze, rough_bronze, transactions, uploaded_lines

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

# The data never has more than ten transactions of a user in ten minutes.
_BURST_RULE = RuleConfig(burst_count=1)


def _query(make: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(make(spark, sf_dir))

    _QUERIES[make.__name__] = run
    return make


def _comparable(df: DataFrame) -> DataFrame:
    """Wall-clock times, and means rounded beyond the order of their sums."""
    means = [c for c in ("average_transaction_amount", "avg_risk_score") if c in df.columns]
    rounded = df.withColumns({c: F.round(c, 6) for c in means}) if means else df
    return without_time_zone(rounded)


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- stored features -------------------------------------------------------


def _fingerprint(spark: SparkSession, path: str) -> tuple:
    """Size and time of the table, so a table that changed is read anew."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    content = files.getContentSummary(place)
    return content.getLength(), content.getFileCount(), files.getFileStatus(place).getModificationTime()


def _features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    """Features, rule context and score bounds of all transactions.

    Computed once per session and table and stored, as in a run: reports read
    the gold tables, they do not build them.
    """
    seen = _fingerprint(spark, f"{sf_dir}/events.parquet")
    return _stored(spark, spark.sparkContext.applicationId, sf_dir, seen)


@lru_cache(maxsize=8)
def _stored(spark: SparkSession, app: str, sf_dir: str, seen: tuple) -> tuple[DataFrame, dict]:
    return stage_features(transactions(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    features, bounds = _features(spark, sf_dir)
    return scoring.compute_risk_score(features, bounds)


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.detect_fraud_rules(_scored(spark, sf_dir))


# --- scan, validation, quarantine ------------------------------------------


@_query
def parquet_scan(spark, sf_dir):
    return transactions(spark, sf_dir)


@_query
def bronze_passthrough(spark, sf_dir):
    return bronze(spark, sf_dir)


@_query
def preview_500(spark, sf_dir):
    return marts.preview(transactions(spark, sf_dir), 500)


@_query
def dedup_transactions(spark, sf_dir):
    return quality.deduplicate(bronze(spark, sf_dir))


@_query
def timestamp_normalize(spark, sf_dir):
    return quality.normalize_timestamp(bronze(spark, sf_dir))


def _clean(spark, sf_dir):
    return quality.normalize_timestamp(quality.deduplicate(bronze(spark, sf_dir)))


@_query
def null_filter(spark, sf_dir):
    return quality.complete_rows(_clean(spark, sf_dir))


@_query
def positive_amount(spark, sf_dir):
    return quality.positive_amount(quality.complete_rows(_clean(spark, sf_dir)))


@_query
def nonpositive_amount(spark, sf_dir):
    return quality.nonpositive_amount(_clean(spark, sf_dir))


@_query
def quarantine_except(spark, sf_dir):
    return quality.incomplete_rows(_clean(spark, sf_dir))


def _layer(spark, sf_dir, layer):
    rows = quality.routed(bronze(spark, sf_dir))
    return rows.where(F.col("layer") == layer).drop("layer")


@_query
def silver(spark, sf_dir):
    return _layer(spark, sf_dir, quality.SILVER)


@_query
def quarantine(spark, sf_dir):
    return _layer(spark, sf_dir, quality.QUARANTINE)


@_query
def quarantine_reasons(spark, sf_dir):
    reasons = quality.quarantine_reasons(bronze(spark, sf_dir))
    return reasons.withColumn("quarantine_reasons", F.array_join("quarantine_reasons", "; "))


def _uploaded(spark, sf_dir):
    """The events as uploaded CSV, malformed lines and all, routed to silver and quarantine."""
    path = _new_path(spark, "upload")
    uploaded_lines(spark, sf_dir).write.text(path)
    return quality.routed(read_csv(spark, path, audit=True, columns=TRANSACTION_COLUMNS))


@_query
def quarantine_malformed(spark, sf_dir):
    """Records of an upload that cannot be read whole, with their text."""
    rows = _uploaded(spark, sf_dir).where(F.col("layer") == quality.QUARANTINE)
    return rows.where(quality.malformed(rows)).select("transaction_id", F.col(CORRUPT_RECORD).alias("record"))


@_query
def upload_roundtrip(spark, sf_dir):
    """What of the same upload is fit for silver."""
    rows = _uploaded(spark, sf_dir).where(F.col("layer") == quality.SILVER)
    return rows.select(*TRANSACTION_COLUMNS)


@_query
def dq_counts(spark, sf_dir):
    return quality.stage_counts(bronze(spark, sf_dir))


# --- features --------------------------------------------------------------


def _behaviour_query(name: str, column: str, **options) -> None:
    def run(spark, sf_dir):
        rows = feat.behaviour(transactions(spark, sf_dir), [column], **options)
        return rows.select("transaction_id", column)

    run.__name__ = name
    _query(run)


_behaviour_query("transaction_velocity", "transaction_velocity")
_behaviour_query("avg_transaction_amount", "average_transaction_amount")
_behaviour_query("device_switch_frequency", "device_switch_frequency")
_behaviour_query("location_change_rate", "location_change_rate")
_behaviour_query("daily_transaction_count", "daily_transaction_count")
_behaviour_query("txn_count_10min", "txn_count_10min")
_behaviour_query("loc_count_1hr", "loc_count_1hr")
_behaviour_query("first_seen_device_window", "first_seen_device_ts")


@_query
def fraud_features(spark, sf_dir):
    return feat.fraud_features(transactions(spark, sf_dir))


@_query
def rule_context(spark, sf_dir):
    rows = feat.with_rule_context(transactions(spark, sf_dir))
    return rows.select("transaction_id", *CONTEXT_COLUMNS)


@_query
def fraud_features_hot_users(spark, sf_dir):
    """The features with every user on the path for users too big for a task."""
    rows = hot_users.hot_user_columns(transactions(spark, sf_dir))
    return rows.select("transaction_id", *FEATURE_COLUMNS, *CONTEXT_COLUMNS)


@_query
def fraud_features_mixed(spark, sf_dir):
    """The features with the busiest users split and the others plain."""
    rows = feat.behaviour(transactions(spark, sf_dir), skew=SkewConfig(hot_rows=75))
    return rows.select("transaction_id", *FEATURE_COLUMNS, *CONTEXT_COLUMNS)


@_query
def first_seen_lookup(spark, sf_dir):
    return hot_users.first_seen_lookup(transactions(spark, sf_dir))


@_query
def first_seen_device(spark, sf_dir):
    rows = feat.first_seen_by_join(transactions(spark, sf_dir))
    return rows.select("transaction_id", "user_id", "device_id", "timestamp", "first_seen_device_ts")


# --- rows that put every choice to the test --------------------------------


def _rough_layer(spark, sf_dir, layer=quality.SILVER):
    rows = quality.routed(rough_bronze(spark, sf_dir))
    return rows.where(F.col("layer") == layer).drop("layer")


@_query
def rough_dedup(spark, sf_dir):
    """Copies that differ, NaN among them, and rows without an id."""
    return quality.deduplicate(rough_bronze(spark, sf_dir))


@_query
def rough_silver(spark, sf_dir):
    return _rough_layer(spark, sf_dir)


@_query
def rough_quarantine(spark, sf_dir):
    return _rough_layer(spark, sf_dir, quality.QUARANTINE)


@_query
def rough_features(spark, sf_dir):
    """The features of users with bursts, many locations and many devices."""
    rows = feat.behaviour(_rough_layer(spark, sf_dir))
    return rows.select("transaction_id", *FEATURE_COLUMNS, *CONTEXT_COLUMNS)


@_query
def rough_features_hot_users(spark, sf_dir):
    # They are read twice.
    layer, _ = stage(_rough_layer(spark, sf_dir), "rough-layer")
    rows = hot_users.hot_user_columns(layer)
    return rows.select("transaction_id", *FEATURE_COLUMNS, *CONTEXT_COLUMNS)


@_query
def rough_first_seen(spark, sf_dir):
    """First times where users and devices may be NULL, which have none."""
    rows = quality.normalize_timestamp(quality.deduplicate(rough_bronze(spark, sf_dir)))
    return feat.first_seen_by_join(rows).select("transaction_id", "user_id", "device_id", "timestamp", "first_seen_device_ts")


def _rough_alerts(spark, sf_dir):
    features = feat.behaviour(_rough_layer(spark, sf_dir))
    return rules.detect_fraud_rules(scoring.compute_risk_score(features))


@_query
def rough_alerts(spark, sf_dir):
    """All four rules at their default thresholds."""
    return _rough_alerts(spark, sf_dir)


@_query
def rough_alert_types(spark, sf_dir):
    return marts.alert_type_breakdown(_rough_alerts(spark, sf_dir))


@_query
def rough_alerts_by_merchant(spark, sf_dir):
    """The 20 first of hundreds of merchants, ties at the cut among them."""
    return marts.alerts_by_merchant(_rough_alerts(spark, sf_dir))


@_query
def rough_alerts_by_location(spark, sf_dir):
    return marts.alerts_by_location(_rough_alerts(spark, sf_dir))


@_query
def rough_top_devices(spark, sf_dir):
    return marts.top_devices(_rough_layer(spark, sf_dir))


# --- batch by batch, day by day --------------------------------------------


def _new_path(spark, name):
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@_query
def first_seen_two_batches(spark, sf_dir):
    """First times from a stored state that two batches were merged into."""
    rows, state = transactions(spark, sf_dir), _new_path(spark, "first-seen")
    early = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    batches = [rows.where(early), rows.where(~early)]
    parts = [with_first_seen(b, incremental.advance_first_seen(b, state)) for b in batches]
    seen = parts[0].unionByName(parts[1])
    return seen.select("transaction_id", "user_id", "device_id", "timestamp", "first_seen_device_ts")


@_query
def feature_days_rerun(spark, sf_dir):
    """A dated features table of which two days were wrong and are computed anew."""
    rows, path, state = transactions(spark, sf_dir), _new_path(spark, "features"), _new_path(spark, "first-seen")
    days = [dt.date(2024, 1, 10), dt.date(2024, 1, 20)]
    faulty = F.when(F.to_date("timestamp").isin(days), -F.col("amount")).otherwise(F.col("amount"))
    wrong = feat.behaviour(rows.withColumn("amount", faulty)).where("amount > -50")
    write_days(wrong, path)
    incremental.refresh_feature_days(rows, path, days, incremental.advance_first_seen(rows, state))
    return read_days(spark, path).select("transaction_id", *FEATURE_COLUMNS, *CONTEXT_COLUMNS)


@_query
def day_slice(spark, sf_dir):
    """Two days of a dated table; files of other days are not opened."""
    path = _new_path(spark, "silver-days")
    write_days(transactions(spark, sf_dir), path)
    return read_days(spark, path, dt.date(2024, 1, 10), dt.date(2024, 1, 11)).select(*TRANSACTION_COLUMNS)


# --- streams ---------------------------------------------------------------


def _streamed_bronze(spark, sf_dir):
    """The faulty rows as files that a stream reads in several batches."""
    folder = _new_path(spark, "bronze-stream")
    bronze(spark, sf_dir).repartition(4).write.parquet(folder)
    return cleansing.read_bronze_stream(spark, folder, files_per_batch=2)


def _finished(*running):
    for query in running:
        query.awaitTermination()
        if query.exception():
            raise query.exception()


def _streamed_layer(spark, sf_dir, layer):
    out = _new_path(spark, "streamed")
    # The rows of a month come in any order.
    config = cleansing.StreamConfig(copies_within="60 days")
    _finished(*cleansing.start_cleansing(_streamed_bronze(spark, sf_dir), out, uuid.uuid4().hex, config).values())
    return cleansing.read_streamed(spark, out, layer).select(*TRANSACTION_COLUMNS)


@_query
def stream_silver(spark, sf_dir):
    """Silver of a stream that read everything there was."""
    return _streamed_layer(spark, sf_dir, quality.SILVER)


@_query
def stream_quarantine(spark, sf_dir):
    return _streamed_layer(spark, sf_dir, quality.QUARANTINE)


@contextmanager
def _state_on_disk(spark):
    """Streams that start meanwhile keep their state in RocksDB, without looking up what is there only to count it."""
    state = "spark.sql.streaming.stateStore"
    settings = {
        f"{state}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        f"{state}.rocksdb.trackTotalNumberOfRows": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@_query
def stream_velocity(spark, sf_dir):
    """Sliding window counts of a stream."""
    folder, out = _new_path(spark, "silver-stream"), _new_path(spark, "windows")
    transactions(spark, sf_dir).repartition(4).write.parquet(folder)
    stream = spark.readStream.schema(SILVER_SCHEMA).option("maxFilesPerTrigger", 2).parquet(folder)
    with _state_on_disk(spark):
        _finished(velocity.start_window_counts(stream, out, uuid.uuid4().hex, late_by="60 days"))
    return velocity.read_window_counts(spark, out)


@_query
def stream_transaction_velocity(spark, sf_dir):
    """The exact count of each transaction's last hour, from a stream."""
    folder, out = _new_path(spark, "silver-stream"), _new_path(spark, "velocity")
    rows = transactions(spark, sf_dir)
    rows.repartition(4).write.parquet(folder)
    # A row of a later time lets the last ones out.
    end = rows.limit(1).withColumns({"user_id": F.lit("end"), "timestamp": F.lit("2025-01-01").cast("timestamp")})
    end.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SILVER_SCHEMA).parquet(folder)
    with _state_on_disk(spark):
        writer = velocity.velocity_stream(stream, "60 days").writeStream.outputMode("append").format("parquet")
        state = f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}"
        _finished(writer.option("checkpointLocation", state).trigger(availableNow=True).start(out))
    return spark.read.parquet(out).select("transaction_id", "transaction_velocity")


# --- scores ----------------------------------------------------------------


@_query
def feature_min_max(spark, sf_dir):
    return scoring.feature_min_max(_features(spark, sf_dir)[0])


@_query
def normalized_features(spark, sf_dir):
    features, bounds = _features(spark, sf_dir)
    rows = scoring.normalized_features(features, bounds)
    return rows.select("transaction_id", "tv_norm", "ds_norm", "lr_norm")


@_query
def risk_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("transaction_id", "risk_score")


@_query
def risk_level(spark, sf_dir):
    return _scored(spark, sf_dir).select("transaction_id", "risk_score", "risk_level")


@_query
def risk_score_self_bounded(spark, sf_dir):
    """Scores of one lazy plan, the bounds as a scalar subquery in it."""
    scored = scoring.compute_risk_score(feat.fraud_features(transactions(spark, sf_dir)))
    return scored.select("transaction_id", "risk_score", "risk_level")


# --- alerts ----------------------------------------------------------------


@_query
def alerts_base(spark, sf_dir):
    return rules.alerts_of(_scored(spark, sf_dir), RISK_ALERT)


@_query
def rule_velocity(spark, sf_dir):
    return rules.alerts_of(_scored(spark, sf_dir), BURST_ALERT, _BURST_RULE)


@_query
def rule_new_device(spark, sf_dir):
    return rules.alerts_of(_scored(spark, sf_dir), NEW_DEVICE_ALERT)


@_query
def rule_multi_location(spark, sf_dir):
    return rules.alerts_of(_scored(spark, sf_dir), LOCATION_ALERT)


@_query
def alerts(spark, sf_dir):
    return rules.detect_fraud_rules(_scored(spark, sf_dir), _BURST_RULE)


@_query
def alerts_dedup(spark, sf_dir):
    """Alerts of rows delivered twice, reduced to one per id and type."""
    scored = _scored(spark, sf_dir)
    twice = scored.withColumn("_delivery", F.explode(F.sequence(F.lit(1), F.lit(2)))).drop("_delivery")
    return rules.unique_alerts(rules.detect_fraud_rules(twice, _BURST_RULE))


@_query
def flagship(spark, sf_dir):
    """The gold step: features in one shuffle, then scores and alerts."""
    features, bounds = stage_features(transactions(spark, sf_dir))
    return rules.detect_fraud_rules(scoring.compute_risk_score(features, bounds))


@_query
def bronze_to_alerts(spark, sf_dir):
    """Every step in a row: raw rows to silver, features, scores and alerts."""
    rows = quality.routed(bronze(spark, sf_dir))
    clean = rows.where(F.col("layer") == quality.SILVER).drop("layer")
    features, bounds = stage_features(stage(clean, "silver")[0])
    return rules.detect_fraud_rules(scoring.compute_risk_score(features, bounds))


# --- reports ---------------------------------------------------------------


@_query
def kpis(spark, sf_dir):
    return marts.kpis(rules.with_alert_count(_scored(spark, sf_dir)))


@_query
def avg_risk_score(spark, sf_dir):
    return marts.average_risk_score(_alerts(spark, sf_dir))


@_query
def risk_distribution(spark, sf_dir):
    return marts.risk_distribution(_alerts(spark, sf_dir))


@_query
def alerts_by_location(spark, sf_dir):
    return marts.alerts_by_location(_alerts(spark, sf_dir), 10)


@_query
def alerts_by_location_top20(spark, sf_dir):
    return marts.alerts_by_location(_alerts(spark, sf_dir), 20)


@_query
def alerts_by_merchant(spark, sf_dir):
    return marts.alerts_by_merchant(_alerts(spark, sf_dir))


@_query
def alert_type_breakdown(spark, sf_dir):
    return marts.alert_type_breakdown(_alerts(spark, sf_dir))


@_query
def fraud_trend(spark, sf_dir):
    return marts.fraud_trend(_alerts(spark, sf_dir))


@_query
def alerts_table(spark, sf_dir):
    return marts.alerts_table(_alerts(spark, sf_dir))


@_query
def payment_method_distribution(spark, sf_dir):
    return marts.payment_method_distribution(_features(spark, sf_dir)[0])


@_query
def amount_histogram(spark, sf_dir):
    return marts.amount_histogram(_features(spark, sf_dir)[0])


@_query
def daily_volume(spark, sf_dir):
    return marts.daily_volume(_features(spark, sf_dir)[0])


@_query
def top_users(spark, sf_dir):
    return marts.top_users(_features(spark, sf_dir)[0])


@_query
def top_devices(spark, sf_dir):
    return marts.top_devices(_features(spark, sf_dir)[0])


@_query
def run_metrics(spark, sf_dir):
    """Counts of a run over the faulty rows, with a runtime that is given."""
    rows = stage(quality.routed(bronze(spark, sf_dir)), "cleansed")[0]
    good, bad = (rows.where(F.col("layer") == n).drop("layer") for n in (quality.SILVER, quality.QUARANTINE))
    features, bounds = stage_features(good)
    raised = rules.detect_fraud_rules(scoring.compute_risk_score(features, bounds))
    return metrics.run_metrics(good, raised, bad, 100.0, 112.344)


@_query
def pipeline_metrics(spark, sf_dir):
    """The same counts from layers written apart, so that each is read alone."""
    path = _new_path(spark, "cleansed")
    good, bad, _ = write_cleansed(bronze(spark, sf_dir), path)
    features, bounds = stage_features(good)
    raised = rules.detect_fraud_rules(scoring.compute_risk_score(features, bounds))
    return metrics.run_metrics(good, raised, bad, 100.0, 112.344)
