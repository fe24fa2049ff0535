"""Scaling and bucketing expressions of the risk score."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paywarden.schema import ScoreConfig


def min_max_scaled(value: Column, low: Column, high: Column, epsilon: float) -> Column:
    """``value`` on [0, 1); epsilon keeps a constant feature at 0."""
    return (value - low) / ((high - low) + F.lit(epsilon))


def risk_bucket(score: Column, config: ScoreConfig = ScoreConfig()) -> Column:
    """LOW / MEDIUM / HIGH; a NULL score counts as HIGH."""
    return (
        F.when(score < config.medium_from, F.lit("LOW"))
        .when(score < config.high_from, F.lit("MEDIUM"))
        .otherwise(F.lit("HIGH"))
    )


def severity_rank(level: Column) -> Column:
    """1, 2, 3 for LOW, MEDIUM and anything else."""
    return F.when(level == "LOW", 1).when(level == "MEDIUM", 2).otherwise(3)
