"""Timestamp expressions that hold under ANSI mode and for NTZ input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from paywarden.schema import TIMESTAMP_FORMAT


def parsed_timestamp(df: DataFrame, name: str = "timestamp") -> Column:
    """``name`` as a timestamp; text in any other format becomes NULL."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(F.col(name), F.lit(TIMESTAMP_FORMAT))
    return F.col(name).cast("timestamp")


def with_timestamp(df: DataFrame, name: str = "timestamp") -> DataFrame:
    """``df`` with ``name`` as TimestampType, unchanged where it already is."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return df
    return df.withColumn(name, parsed_timestamp(df, name))


def epoch_second(name: str = "timestamp") -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.col(name).cast("long")


def without_time_zone(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock times of the session's time zone."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df
