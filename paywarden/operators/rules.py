"""Alert rules: every rule is a predicate on one scored row and its context.

All four are tested in the same projection and unfolded from an array, so the
alerts cost one pass over the scored rows instead of one per rule.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, functions as F

from paywarden.operators.features import with_rule_context
from paywarden.operators.quality import keep_one
from paywarden.schema import (
    ALERT_COLUMNS,
    BURST_ALERT,
    LOCATION_ALERT,
    NEW_DEVICE_ALERT,
    RISK_ALERT,
    SCORED_COLUMNS,
    RuleConfig,
)


def rule_conditions(config: RuleConfig = RuleConfig()) -> dict[str, Column]:
    """Condition of each alert type."""
    return {
        RISK_ALERT: F.col("risk_level").isin("MEDIUM", "HIGH"),
        BURST_ALERT: F.col("txn_count_10min") > config.burst_count,
        NEW_DEVICE_ALERT: (F.col("amount") > config.large_amount)
        & (F.col("timestamp") == F.col("first_seen_device_ts")),
        LOCATION_ALERT: F.col("loc_count_1hr") > config.location_count,
    }


def _require_scored(scored: DataFrame) -> None:
    absent = [c for c in SCORED_COLUMNS if c not in scored.columns]
    if absent:
        raise ValueError(f"the alert rules need the columns {', '.join(absent)}")


def with_alert_count(
    scored: DataFrame, config: RuleConfig = RuleConfig(), **options
) -> DataFrame:
    """Scored rows with the number of alerts each one raises."""
    _require_scored(scored)
    raised = [F.when(cond, 1).otherwise(0) for cond in rule_conditions(config).values()]
    return with_rule_context(scored, **options).withColumn("alert_count", reduce(add, raised))


def detect_fraud_rules(
    scored: DataFrame, config: RuleConfig = RuleConfig(), **options
) -> DataFrame:
    """One row per transaction and alert type.

    Unique when transaction ids are; use ``unique_alerts`` where they are not.
    """
    _require_scored(scored)
    conditions = rule_conditions(config)
    context = with_rule_context(scored, **options)
    raised = F.array(*[F.when(cond, F.lit(name)) for name, cond in conditions.items()])
    return (
        context.where(reduce(or_, conditions.values()))
        .withColumn("alert_type", F.explode(raised))
        .where(F.col("alert_type").isNotNull())
        .select(*ALERT_COLUMNS)
    )


def alerts_of(
    scored: DataFrame, alert_type: str, config: RuleConfig = RuleConfig(), **options
) -> DataFrame:
    """The alerts of a single rule."""
    _require_scored(scored)
    context = scored if alert_type == RISK_ALERT else with_rule_context(scored, **options)
    hits = context.where(rule_conditions(config)[alert_type])
    return hits.withColumn("alert_type", F.lit(alert_type)).select(*ALERT_COLUMNS)


def unique_alerts(alerts: DataFrame) -> DataFrame:
    """One row per transaction id and alert type."""
    return keep_one(alerts, ["transaction_id", "alert_type"])
