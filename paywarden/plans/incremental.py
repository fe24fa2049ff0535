"""Work on one batch or on a few days at a time, instead of on all history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywarden.functions.times import with_timestamp
from paywarden.operators.features import behaviour
from paywarden.operators.first_seen import merged_first_seen, with_first_seen
from paywarden.operators.user_windows import BEHAVIOUR_COLUMNS
from paywarden.plans.steps import Settings
from paywarden.schema import FeatureConfig
from paywarden.sources.dated import write_days
from paywarden.sources.releases import publish, read_published


def known_first_seen(spark: SparkSession, state_path: str) -> DataFrame | None:
    """The stored first times, None before the first batch."""
    return read_published(spark, state_path)


def advance_first_seen(batch: DataFrame, state_path: str) -> DataFrame:
    """Merge a batch into the stored first times and return them.

    The new state is written beside the old one and takes its place at once: a
    run that dies leaves the old state, and running it again changes nothing.
    """
    spark = batch.sparkSession
    publish(merged_first_seen(batch, known_first_seen(spark, state_path)), state_path)
    return known_first_seen(spark, state_path)


def history_seconds(config: FeatureConfig = FeatureConfig()) -> int:
    """How far before a day its features look back."""
    return max(config.velocity_seconds, config.burst_seconds, config.location_seconds)


def feature_days(
    silver: DataFrame, days: Collection[dt.date], known: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Features and rule context of the rows of some days.

    Per-day features need the day itself and look-back frames the hour before;
    first times come from ``known``, which must include these days.  So only
    those rows are read and shuffled, not the history.
    """
    days = sorted(set(days))
    silver = with_timestamp(silver)
    if not days:
        return with_first_seen(behaviour(silver.where("false"), config=settings.features, skew=settings.skew), known)
    second, day = F.col("timestamp").cast("long"), F.to_date("timestamp")
    near = F.lit(False)
    for d in days:
        begin = F.unix_timestamp(F.lit(d).cast("timestamp"))
        near = near | (day == F.lit(d)) | second.between(begin - history_seconds(settings.features), begin - 1)
    wanted = [c for c in BEHAVIOUR_COLUMNS if c != "first_seen_device_ts"]
    computed = behaviour(silver.where(near), wanted, settings.features, settings.skew)
    return with_first_seen(computed.where(F.to_date("timestamp").isin(days)), known)


def refresh_feature_days(
    silver: DataFrame,
    features_path: str,
    days: Collection[dt.date],
    known: DataFrame,
    settings: Settings = Settings(),
) -> list[dt.date]:
    """Compute some days of a dated features table anew; the others stay as they are."""
    return write_days(feature_days(silver, days, known, settings), features_path, days=days)
