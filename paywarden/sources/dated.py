"""Tables with one partition per day, of which single days can be replaced."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paywarden.sources.tables import read_parquet, write_parquet

DAY = "txn_date"


def write_days(df: DataFrame, path: str, time_col: str = "timestamp", days: Collection[dt.date] | None = None) -> list[dt.date]:
    """Write rows into the partitions of their days; other days stay as they are.

    ``days`` names the days that are replaced: rows of other days are left out,
    and a day without rows is emptied.  Without it every day that ``df`` has
    rows for is replaced.  Rows without a time are in the partition of no day.
    Returns the days that got rows.

    Rows are dealt out by day first, large days over several tasks, so that a
    day has few files.
    """
    rows = df.withColumn(DAY, F.to_date(time_col))
    if days is not None:
        days = sorted(set(days))
        rows = rows.where(F.col(DAY).isin(days))
    written = write_parquet(
        rows.hint("rebalance", DAY),
        path,
        partition_by=[DAY],
        only_touched=True,
        observed={"days": F.collect_set(DAY)},
    )["days"]
    spark = df.sparkSession
    for day in set(days or ()) - set(written):
        write_parquet(spark.createDataFrame([], df.schema), f"{path.rstrip('/')}/{DAY}={day.isoformat()}")
    return sorted(written)


def read_days(
    spark: SparkSession,
    path: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows of the days from ``first`` to ``last``, both included.

    The day is a partition column, so files of other days are not opened.
    """
    if schema is not None and DAY not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    table = read_parquet(spark, path, schema)
    if first is not None:
        table = table.where(F.col(DAY) >= F.lit(first))
    if last is not None:
        table = table.where(F.col(DAY) <= F.lit(last))
    return table
