"""Small hand-made tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from paywarden.schema import BRONZE_SCHEMA, SILVER_SCHEMA

NOON = dt.datetime(2024, 3, 1, 12, 0, 0)


def silver(spark, rows):
    """``rows`` are dicts; what is left out gets a plain value."""
    full = []
    for number, row in enumerate(rows):
        values = {
            "transaction_id": f"t{number}", "user_id": "u", "merchant_id": "m", "amount": 10.0,
            "location": "here", "device_id": "d", "payment_method": "upi", "timestamp": NOON,
            "transaction_status": "success",
        }
        values.update(row)
        full.append(tuple(values[f] for f in SILVER_SCHEMA.fieldNames()))
    return spark.createDataFrame(full, SILVER_SCHEMA)


def bronze(spark, rows):
    full = []
    for row in rows:
        values = {
            "transaction_id": "t", "user_id": "u", "merchant_id": "m", "amount": 10.0,
            "location": "here", "device_id": "d", "payment_method": "upi",
            "timestamp": "2024-03-01 12:00:00", "transaction_status": "success",
        }
        values.update(row)
        full.append(tuple(values[f] for f in BRONZE_SCHEMA.fieldNames()))
    return spark.createDataFrame(full, BRONZE_SCHEMA)


def after(seconds: float) -> dt.datetime:
    return NOON + dt.timedelta(seconds=seconds)


def features(spark, rows):
    """(transaction_id, velocity, devices, locations) rows."""
    schema = T.StructType(
        [
            T.StructField("transaction_id", T.StringType()),
            T.StructField("transaction_velocity", T.LongType()),
            T.StructField("device_switch_frequency", T.IntegerType()),
            T.StructField("location_change_rate", T.IntegerType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def column(df, name, key="transaction_id"):
    """Values of ``name`` by transaction id, in the order of the ids."""
    rows = sorted((r[key], r[name]) for r in df.select(key, name).collect())
    return [value for _, value in rows]
