"""Monitoring figures of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywarden.functions.rows import side_by_side
from paywarden.operators.marts import ratio


def _rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _completed(counts: DataFrame, started: float, ended: float) -> DataFrame:
    return counts.select(
        "total_transactions_processed",
        "fraud_alert_count",
        ratio(F.col("fraud_alert_count"), F.col("total_transactions_processed")).alias("fraud_rate"),
        "invalid_records",
        F.bround(F.lit(float(ended) - float(started)), 2).alias("pipeline_runtime_seconds"),
    )


def run_metrics(
    silver: DataFrame, alerts: DataFrame, quarantine: DataFrame, started: float, ended: float
) -> DataFrame:
    """One row of counts from the stored tables; times are epoch seconds."""
    counts = side_by_side(
        _rows(silver, "total_transactions_processed"),
        _rows(alerts, "fraud_alert_count"),
        _rows(quarantine, "invalid_records"),
    )
    return _completed(counts, started, ended)


def run_metrics_from_counts(
    spark: SparkSession, silver: int, alerts: int, quarantine: int, started: float, ended: float
) -> DataFrame:
    """The same row from counts that were observed while writing."""
    counts = spark.createDataFrame(
        [(silver, alerts, quarantine)],
        "total_transactions_processed long, fraud_alert_count long, invalid_records long",
    )
    return _completed(counts, started, ended)
