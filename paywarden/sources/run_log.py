"""Append-only log of runs."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from paywarden.schema import RUN_LOG_SCHEMA
from paywarden.sources.tables import read_parquet, write_parquet

# Fixed value: how run times are written out.
_TIME = "%Y-%m-%d %H:%M:%S"


def log_pipeline_run(
    spark: SparkSession,
    metadata_path: str,
    records_processed: int,
    pipeline_status: str,
    data_source: str,
    start_time: datetime | None = None,
    end_time: datetime | None = None,
) -> str:
    """Add one row to the log and return the id of the run."""
    run_id = str(uuid.uuid4())
    start, end = (t or datetime.now() for t in (start_time, end_time))
    row = (run_id, start.strftime(_TIME), end.strftime(_TIME), records_processed,
           pipeline_status, data_source)
    entry = spark.createDataFrame([row], RUN_LOG_SCHEMA).coalesce(1)
    write_parquet(entry, metadata_path, mode="append")
    return run_id


def read_run_log(spark: SparkSession, metadata_path: str) -> DataFrame:
    return read_parquet(spark, metadata_path, RUN_LOG_SCHEMA)
