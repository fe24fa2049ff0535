"""First times that are carried from batch to batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paywarden.functions.joins import join_lookup
from paywarden.functions.times import with_timestamp
from paywarden.operators.hot_users import first_seen_lookup

KEYS = ["user_id", "device_id"]


def merged_first_seen(batch: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """When each user was first seen on each device, in ``batch`` or before.

    A minimum, so it does not matter in which order batches come, nor whether
    one comes twice.  The batch is reduced to one row a key in each task before
    anything is shuffled.  Keys with a NULL match no row and are not kept.
    """
    found = first_seen_lookup(with_timestamp(batch)).where("user_id is not null and device_id is not null")
    if known is None:
        return found
    both = found.unionByName(known.select(*found.columns))
    return both.groupBy(*KEYS).agg(F.min("first_seen_device_ts").alias("first_seen_device_ts"))


def with_first_seen(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with the first time of their user and device in ``known``.

    The column is replaced where ``rows`` has it; a NULL key gets NULL.
    """
    return join_lookup(rows.drop("first_seen_device_ts"), known, KEYS)
