"""Parquet and CSV tables, and the shared folder for intermediate ones."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: int):
    """A session setting for the length of one write; 0 leaves it alone."""
    before = spark.conf.get(name)
    if value:
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    open_partitions: int = 0,
    observed: Mapping[str, Column] | None = None,
    only_touched: bool = False,
) -> dict:
    """Write and return the observed aggregates, taken from the same pass.

    With ``only_touched`` the partitions that ``df`` has rows for are replaced
    and all others stay; otherwise the whole table is replaced.

    With few partition values, ``open_partitions`` of them are written side by
    side by each task, which spares sorting the rows by partition.

    The aggregates sit above the last shuffle, in the tasks that write, so a
    task that is run again after a loss is counted once.
    """
    watch = None
    if observed:
        watch = Observation()
        df = df.observe(watch, *[column.alias(name) for name, column in observed.items()])
    writer = df.write.mode(mode)
    if partition_by:
        # Replacing the whole table takes partitions away that are now empty.
        scope = "dynamic" if only_touched else "static"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", scope)
    with _setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", open_partitions):
        writer.parquet(path)
    return dict(watch.get) if watch else {}


def write_csv(df: DataFrame, folder: str, prefix: str = "transactions") -> str:
    """CSV with a header, under a name that carries the time of writing."""
    path = f"{folder.rstrip('/')}/{prefix}_{int(time.time())}.csv"
    # Quotes are doubled, not escaped, as the reader expects.
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="paywarden-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(
    df: DataFrame, name: str, observed: Mapping[str, Column] | None = None
) -> tuple[DataFrame, dict]:
    """Write ``df`` to a new table in the shared folder and read it back.

    Later steps start from that table, so nothing upstream is computed twice
    and a lost executor costs no more than the task it was running.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/{app}/{name}-{uuid.uuid4().hex}"
    values = write_parquet(df, path, observed=observed)
    return read_parquet(spark, path, df.schema), values
