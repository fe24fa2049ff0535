"""Tables that are replaced whole or not at all.

``mode("overwrite")`` takes the old table away before the new one is there: a
run that dies in between leaves none.  Here a new version is written to a
folder of its own, and only when all of it is there one row of a log names it.
That row is one file, committed at once; readers take the folder that was named
last.  What a dead run wrote is named by nobody.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from paywarden.sources.tables import read_parquet, write_parquet

LOG_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("released_at", T.TimestampType()),
    ]
)


def _log_path(path: str) -> str:
    return f"{path.rstrip('/')}/release_log"


def releases(spark: SparkSession, path: str) -> DataFrame:
    """(version, folder, released_at) of all versions; empty if there are none."""
    try:
        return read_parquet(spark, _log_path(path), LOG_SCHEMA)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def _latest(spark: SparkSession, path: str, version: int | None = None):
    log = releases(spark, path)
    if version is not None:
        log = log.where(F.col("version") == version)
    # Of two writers that took the same number the later one wins.
    return log.orderBy(F.desc("version"), F.desc("released_at"), F.desc("folder")).first()


def current_folder(spark: SparkSession, path: str, version: int | None = None) -> str | None:
    """The folder of the current version, or of ``version``; None if there is none."""
    last = _latest(spark, path, version)
    return f"{path.rstrip('/')}/{last.folder}" if last else None


def new_folder(path: str) -> str:
    """A folder for the next version, which nobody reads yet."""
    return f"{path.rstrip('/')}/release-{uuid.uuid4().hex}"


def release(spark: SparkSession, path: str, folder: str) -> int:
    """Make ``folder``, made by ``new_folder``, the current version; returns its number."""
    last = _latest(spark, path)
    version = (last.version if last else 0) + 1
    row = spark.createDataFrame([(version, folder.rsplit("/", 1)[1])], "version long, folder string")
    row = row.withColumn("released_at", F.current_timestamp()).select(*LOG_SCHEMA.fieldNames())
    write_parquet(row.coalesce(1), _log_path(path), mode="append")
    return version


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    observed: Mapping[str, Column] | None = None,
) -> dict:
    """Replace the table at ``path`` by ``df``, which may read the old one.

    Returns the observed aggregates.  One writer at a time.
    """
    folder = new_folder(path)
    values = write_parquet(df, folder, mode="errorifexists", partition_by=partition_by, observed=observed)
    release(df.sparkSession, path, folder)
    return values


def read_published(
    spark: SparkSession, path: str, schema: T.StructType | None = None, version: int | None = None
) -> DataFrame | None:
    """The current version of a table, or an earlier one; None if there is none."""
    folder = current_folder(spark, path, version)
    return read_parquet(spark, folder, schema) if folder else None


def retire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Free the files of all but the last ``keep`` versions of a published table.

    An old version stays in the log as an empty table.  ``keep`` should be
    large enough for the longest reader.  Returns how many versions were freed.
    """
    if keep < 1:
        raise ValueError("the current version has to be kept")
    old = releases(spark, path).orderBy(F.desc("version"), F.desc("released_at"), F.desc("folder")).offset(keep).collect()
    for row in old:
        folder = f"{path.rstrip('/')}/{row.folder}"
        write_parquet(spark.createDataFrame([], read_parquet(spark, folder).schema), folder)
    return len(old)
