"""The event stream seen as transactions: clean, and with faults added."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywarden.schema import TIMESTAMP_FORMAT, TRANSACTION_COLUMNS
from paywarden.sources.tables import read_parquet


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/events.parquet").withColumn(
        "_k", F.get_json_object("props", "$.k").cast("int")
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clean transaction per event."""
    status = F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("success"))
    return _events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("MRC_"), F.col("_k") % 20).alias("merchant_id"),
        (F.col("value") * 10).alias("amount"),
        F.concat(F.lit("CITY_"), F.col("_k") % 6).alias("location"),
        F.concat(F.lit("DEV_"), F.col("_k") % 4).alias("device_id"),
        F.col("event_type").alias("payment_method"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        status.alias("transaction_status"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions with text timestamps, faults and repeated rows.

    Every event is there; by its id it may get one or more faults, and every
    fiftieth event is delivered twice.
    """
    number = F.col("transaction_id").cast("long")
    amount = (
        F.when(number % 101 == 0, F.lit(None))
        .when(number % 103 == 0, -F.col("amount") / 10)
        .when(number % 107 == 0, F.lit(0.0))
        .otherwise(F.col("amount"))
    )
    location = F.when((number % 109 != 0) & (number % 206 != 0), F.col("location"))
    text = F.date_format("timestamp", TIMESTAMP_FORMAT)
    deliveries = F.when(number % 50 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(
        F.sequence(F.lit(1), F.lit(1))
    )
    return (
        transactions(spark, sf_dir)
        .withColumns(
            {
                "amount": amount,
                "location": location,
                "timestamp": F.when(number % 113 == 0, F.lit("not-a-time")).otherwise(text),
                "_delivery": F.explode(deliveries),
            }
        )
        .select(*TRANSACTION_COLUMNS)
    )


def uploaded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of a CSV without a header per event; by its id a line may be malformed.

    Some go on after the last field, some with empty fields first, some open a
    quote and never close it, some lack their last field, which is no fault of
    form.  Others quote a field that has commas and quotes inside.
    """
    number = F.col("transaction_id").cast("long")
    location = (
        F.when(number % 83 == 0, F.concat(F.lit('"'), F.col("location")))
        .when(number % 79 == 0, F.concat(F.lit('"'), F.col("location"), F.lit(', the ""old"" town"')))
        .otherwise(F.col("location"))
    )
    fields = [
        F.col("transaction_id"), F.col("user_id"), F.col("merchant_id"), F.floor("amount").cast("string"), location,
        F.col("device_id"), F.col("payment_method"), F.date_format("timestamp", TIMESTAMP_FORMAT),
    ]
    end = (
        F.when(number % 97 == 0, F.concat(F.lit(","), F.col("transaction_status"), F.lit(",more")))
        .when(number % 89 == 0, F.concat(F.lit(","), F.col("transaction_status"), F.lit(",,lost")))
        .when(number % 73 == 0, F.lit(""))
        .otherwise(F.concat(F.lit(","), F.col("transaction_status")))
    )
    return transactions(spark, sf_dir).select(F.concat(F.concat_ws(",", *fields), end).alias("value"))


def rough_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with what the plain view lacks.

    Copies of a transaction differ, amounts are NaN, ids, users and devices are
    NULL, every fortieth event is a burst of 15 transactions 30 s apart, and
    there are hundreds of merchants and dozens of locations and devices.
    """
    number = F.col("_number")
    rows = transactions(spark, sf_dir).withColumn("_number", F.col("transaction_id").cast("long"))
    rows = rows.withColumn("_i", F.explode(F.sequence(F.lit(0), F.when(number % 40 == 0, 14).otherwise(0))))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.when(number % 7 == 3, 1).otherwise(0))))
    own_id = F.when(F.col("_i") > 0, F.concat_ws("-", number, F.col("_i"))).otherwise(number.cast("string"))
    late = F.timestamp_seconds(F.unix_timestamp("timestamp") + 30 * F.col("_i"))
    return rows.withColumns(
        {
            "transaction_id": F.when(number % 37 != 6, own_id),
            "user_id": F.when(number % 41 != 8, F.col("user_id")),
            "merchant_id": F.concat(F.lit("MRC_"), number * 7 % 500),
            "amount": F.when((number % 31 == 5) & (F.col("_copy") == 0), F.lit(float("nan"))).otherwise(F.col("amount") + F.col("_copy")),
            "location": F.concat(F.lit("CITY_"), (number + F.col("_copy")) % 60),
            "device_id": F.when(number % 43 != 9, F.concat(F.lit("DEV_"), number % 30)),
            "timestamp": F.date_format(late, TIMESTAMP_FORMAT),
        }
    ).select(*TRANSACTION_COLUMNS)
