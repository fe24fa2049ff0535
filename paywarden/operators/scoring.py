"""Risk score relative to the batch: min-max scaling, weights, three levels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row, functions as F

from paywarden.functions.scores import min_max_scaled, risk_bucket
from paywarden.schema import ScoreConfig

_SCALED = {
    "tv_norm": ("transaction_velocity", "min_tv", "max_tv"),
    "ds_norm": ("device_switch_frequency", "min_ds", "max_ds"),
    "lr_norm": ("location_change_rate", "min_lr", "max_lr"),
}


def score_bounds() -> dict[str, Column]:
    """The six aggregates the scaling needs, by name."""
    bounds = {}
    for feature, low, high in _SCALED.values():
        bounds[low] = F.min(feature)
        bounds[high] = F.max(feature)
    return bounds


def feature_min_max(features: DataFrame) -> DataFrame:
    """One row with the smallest and greatest value of each scored feature."""
    return features.agg(*[column.alias(name) for name, column in score_bounds().items()])


def _bound_columns(features: DataFrame, stats) -> Mapping[str, Column]:
    names = list(score_bounds())
    if isinstance(stats, Row):
        stats = stats.asDict()
    if isinstance(stats, Mapping):
        types = {n: features.schema[f].dataType for f, lo, hi in _SCALED.values() for n in (lo, hi)}
        return {n: F.lit(stats[n]).cast(types[n]) for n in names}
    table = feature_min_max(features) if stats is None else stats
    one = table.select(F.struct(*names)).scalar()
    return {n: one[n] for n in names}


def normalized_features(
    features: DataFrame, stats: DataFrame | Mapping | Row | None = None,
    config: ScoreConfig = ScoreConfig(),
) -> DataFrame:
    """Scale the three scored features to [0, 1).

    ``stats`` are the bounds: known values (as collected while the features
    were written), or a one-row table (scores that stay comparable between
    batches), or None for the bounds of ``features`` itself.  A table is read
    by a scalar subquery: no join, and an empty batch just gives no rows.
    """
    bound = _bound_columns(features, stats)
    return features.withColumns(
        {
            out: min_max_scaled(F.col(feature), bound[low], bound[high], config.epsilon)
            for out, (feature, low, high) in _SCALED.items()
        }
    )


def with_risk_score(normalized: DataFrame, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    velocity = F.lit(config.velocity_weight) * F.col("tv_norm")
    devices = F.lit(config.device_weight) * F.col("ds_norm")
    locations = F.lit(config.location_weight) * F.col("lr_norm")
    return normalized.withColumn("risk_score", velocity + devices + locations)


def with_risk_level(scored: DataFrame, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    return scored.withColumn("risk_level", risk_bucket(F.col("risk_score"), config))


def compute_risk_score(
    features: DataFrame, stats: DataFrame | Mapping | Row | None = None,
    config: ScoreConfig = ScoreConfig(),
) -> DataFrame:
    """Features plus normalised features, score and level; no shuffle."""
    normalized = normalized_features(features, stats, config)
    return with_risk_level(with_risk_score(normalized, config), config)
