"""Reporting aggregates over the features (or scored) and alerts tables.

Counts are combined inside the map tasks, so a value with a third of all rows
is no heavier for its reducer than any other.  "Top n" reports keep n rows by
definition and never sort more than that per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paywarden.functions.rows import side_by_side
from paywarden.functions.scores import severity_rank
from paywarden.functions.times import parsed_timestamp

# The columns an alerts table shows.
DISPLAY_COLUMNS = [
    "transaction_id", "user_id", "merchant_id", "amount",
    "location", "device_id", "risk_score", "risk_level",
]


def value_counts(df: DataFrame, name: str, top: int | None = None) -> DataFrame:
    """Rows per non-NULL value, most frequent first, ties by value."""
    counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("count"))
    ranked = counts.orderBy(F.desc("count"), name)
    return ranked if top is None else ranked.limit(top)


def daily_counts(df: DataFrame, day: str) -> DataFrame:
    """Transactions per day; rows without a readable timestamp are left out."""
    when = parsed_timestamp(df)
    return (
        df.select(F.to_date(when).alias(day), "transaction_id")
        .where(F.col(day).isNotNull())
        .groupBy(day)
        .agg(F.count("transaction_id").alias("count"))
        .orderBy(day)
    )


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0.0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def kpis(counted_rows: DataFrame) -> DataFrame:
    """Totals and alert rate, from one pass over rows with their alert counts.

    The rate counts alerts, so it can exceed 1; ``fraud_rate_distinct`` counts
    transactions with at least one alert.
    """
    raised = F.col("alert_count")
    counted = counted_rows.agg(
        F.count(F.lit(1)).alias("transactions_processed"),
        F.coalesce(F.sum(raised), F.lit(0)).cast("long").alias("fraud_alerts"),
        F.count_if(raised > 0).alias("_flagged"),
    )
    processed = F.col("transactions_processed")
    return counted.select(
        "transactions_processed",
        "fraud_alerts",
        F.bround(ratio(F.col("fraud_alerts"), processed), 4).alias("fraud_rate"),
        F.bround(ratio(F.col("_flagged"), processed), 4).alias("fraud_rate_distinct"),
    )


def table_kpis(features: DataFrame, alerts: DataFrame, run_log: DataFrame | None = None) -> DataFrame:
    """The same totals from stored tables, with the end of the latest run."""
    totals = side_by_side(
        features.agg(F.count(F.lit(1)).alias("transactions_processed")),
        alerts.agg(F.count(F.lit(1)).alias("fraud_alerts")),
    )
    rate = F.bround(ratio(F.col("fraud_alerts"), F.col("transactions_processed")), 4)
    result = totals.withColumn("fraud_rate", rate)
    if run_log is None:
        return result
    return result.withColumn("last_run_end", latest_run(run_log).select("end_time").scalar())


def latest_run(run_log: DataFrame) -> DataFrame:
    return run_log.orderBy(F.desc("end_time"), F.desc("pipeline_run_id")).limit(1)


def average_risk_score(alerts: DataFrame) -> DataFrame:
    """Mean over alert rows: a transaction with two alerts counts twice."""
    return alerts.agg(F.avg("risk_score").alias("avg_risk_score"))


def risk_distribution(alerts: DataFrame) -> DataFrame:
    return value_counts(alerts, "risk_level")


def alerts_by_location(alerts: DataFrame, top: int = 10) -> DataFrame:
    return value_counts(alerts, "location", top)


def alerts_by_merchant(alerts: DataFrame, top: int = 20) -> DataFrame:
    return value_counts(alerts, "merchant_id", top)


def alert_type_breakdown(alerts: DataFrame) -> DataFrame:
    return value_counts(alerts, "alert_type")


def payment_method_distribution(features: DataFrame) -> DataFrame:
    return value_counts(features, "payment_method")


def top_users(features: DataFrame, top: int = 10) -> DataFrame:
    return value_counts(features, "user_id", top)


def top_devices(features: DataFrame, top: int = 10) -> DataFrame:
    return value_counts(features, "device_id", top)


def fraud_trend(alerts: DataFrame) -> DataFrame:
    return daily_counts(alerts, "alert_date")


def daily_volume(features: DataFrame) -> DataFrame:
    return daily_counts(features, "date")


def alerts_table(alerts: DataFrame) -> DataFrame:
    """Alerts for display, riskiest first, with a sortable severity.

    If a display column is missing, all columns are shown.
    """
    shown = DISPLAY_COLUMNS if set(DISPLAY_COLUMNS) <= set(alerts.columns) else alerts.columns
    ordered = [F.desc("risk_score")] if "risk_score" in alerts.columns else []
    ordered += [F.col(c) for c in ("transaction_id", "alert_type") if c in alerts.columns]
    table = alerts.orderBy(*ordered) if ordered else alerts
    if "risk_level" not in shown:
        return table.select(*shown)
    return table.select(*shown, severity_rank(F.col("risk_level")).alias("severity_rank"))


def preview(df: DataFrame, rows: int = 500, order_by: str = "transaction_id") -> DataFrame:
    """The first rows in a fixed order."""
    return df.orderBy(order_by).limit(rows)


def amount_histogram(features: DataFrame, bins: int = 30) -> DataFrame:
    """Rows per equal-width amount bin; empty bins are absent.

    The range comes from a scalar subquery over the amount column.
    """
    amounts = features.where(F.col("amount").isNotNull() & ~F.isnan("amount")).select("amount")
    span = amounts.agg(F.min("amount").alias("low"), F.max("amount").alias("high"))
    one = span.select(F.struct("low", "high")).scalar()
    low, high = one["low"], one["high"]
    share = F.when(high > low, (F.col("amount") - low) / (high - low)).otherwise(F.lit(0.0))
    bucket = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
    return amounts.groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("count")).orderBy("bin")
