"""Table schemas and the tunable settings of every step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("location", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("transaction_status", T.StringType()),
    ]
)

# Bronze keeps the timestamp as the text that arrived.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
        for f in SILVER_SCHEMA.fields
    ]
)

TRANSACTION_COLUMNS = SILVER_SCHEMA.fieldNames()

# What bronze may carry besides: the text of a record that could not be read
# whole, the file each row came from, and when it came in.
CORRUPT_RECORD = "_corrupt_record"
LINEAGE_COLUMNS = ["_source_file", "_ingested_at"]
AUDIT_COLUMNS = [CORRUPT_RECORD, *LINEAGE_COLUMNS]

FEATURE_TYPES = {
    "transaction_velocity": T.LongType(),
    "average_transaction_amount": T.DoubleType(),
    "device_switch_frequency": T.IntegerType(),
    "location_change_rate": T.IntegerType(),
    "daily_transaction_count": T.LongType(),
}
FEATURE_COLUMNS = list(FEATURE_TYPES)

# What the alert rules need besides the features.  It comes out of the same
# shuffle as the features, so the features table carries it along.
CONTEXT_TYPES = {
    "txn_count_10min": T.LongType(),
    "loc_count_1hr": T.IntegerType(),
    "first_seen_device_ts": T.TimestampType(),
}
CONTEXT_COLUMNS = list(CONTEXT_TYPES)

SCORE_COLUMNS = ["tv_norm", "ds_norm", "lr_norm", "risk_score", "risk_level"]

# Column order of the scored and alerts tables.
SCORED_COLUMNS = TRANSACTION_COLUMNS + FEATURE_COLUMNS + SCORE_COLUMNS
ALERT_COLUMNS = SCORED_COLUMNS + ["alert_type"]

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_run_id", T.StringType(), False),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("pipeline_status", T.StringType()),
        T.StructField("data_source", T.StringType()),
    ]
)


@dataclass(frozen=True)
class FeatureConfig:
    """Lengths, in whole seconds, of the look-back frames."""

    velocity_seconds: int = 3600
    burst_seconds: int = 600
    location_seconds: int = 3600


@dataclass(frozen=True)
class SkewConfig:
    """When a user is too big for one task.

    A user with more than ``hot_rows`` rows takes the split path, which gives
    the same values.
    """

    hot_rows: int = 5_000_000


@dataclass(frozen=True)
class ScoreConfig:
    velocity_weight: float = 0.4
    device_weight: float = 0.3
    location_weight: float = 0.3
    epsilon: float = 1e-6
    medium_from: float = 0.3
    high_from: float = 0.7


@dataclass(frozen=True)
class RuleConfig:
    """Alert thresholds; all comparisons are strict."""

    burst_count: int = 10
    large_amount: float = 2000.0
    location_count: int = 1


# The alert names consumers filter on.
RISK_ALERT = "Risk threshold alert"
BURST_ALERT = "High transaction velocity (10min)"
NEW_DEVICE_ALERT = "Large transaction from new device"
LOCATION_ALERT = "Multiple locations in 1 hour"
