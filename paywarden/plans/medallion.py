"""The whole run: upload -> bronze -> silver and quarantine -> gold -> log."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from paywarden.operators.metrics import run_metrics_from_counts
from paywarden.operators.quality import QUARANTINE, SILVER
from paywarden.plans.steps import Gold, Settings, read_malformed, write_bronze, write_cleansed, write_gold
from paywarden.schema import AUDIT_COLUMNS
from paywarden.sources.releases import current_folder, new_folder, release
from paywarden.sources.run_log import log_pipeline_run
from paywarden.sources.tables import read_parquet
from paywarden.sources.uploads import ingest


@dataclass(frozen=True)
class Run:
    run_id: str
    source: str
    silver: DataFrame
    quarantine: DataFrame
    malformed: DataFrame
    gold: Gold
    metrics: DataFrame


def current_run(spark: SparkSession, out_dir: str) -> str | None:
    """The folder with the tables of the last atomic run that ended well."""
    return current_folder(spark, out_dir)


def run_medallion(
    spark: SparkSession,
    uploaded_dir: str,
    out_dir: str,
    fallback: DataFrame | None = None,
    settings: Settings = Settings(),
    fallback_source: str = "synthetic",
    multi_line: bool = False,
    atomic: bool = False,
) -> Run:
    """Run all steps and log the run, also when it fails.

    The newest CSV or JSON in ``uploaded_dir`` is taken; without one, ``fallback``,
    logged as ``fallback_source``.  ``multi_line`` allows line breaks in a CSV's quotes.
    A record that cannot be read whole ends in quarantine, its text and file in
    ``Run.malformed``; bronze tells each row's file and the time it came in.

    Tables go to ``bronze/``, ``cleansed/layer=silver|quarantine/`` and
    ``gold/`` below ``out_dir``; the log is ``gold/pipeline_metadata.parquet``.

    With ``atomic`` they go to a folder of this run below ``out_dir``, which
    takes the place of the last run's when all of them are there
    (``current_run``); a run that fails or dies changes none that are read.
    """
    home = out_dir.rstrip("/")
    root = new_folder(home) if atomic else home
    log_path = f"{home}/gold/pipeline_metadata.parquet"
    started, start_time = time.time(), datetime.now()
    source, records = "unknown", 0
    try:
        incoming, source = ingest(spark, uploaded_dir, fallback, fallback_source, multi_line, audit=True)
        bronze_path = f"{root}/bronze/transactions_bronze.parquet"
        write_bronze(incoming, bronze_path)
        bronze = read_parquet(spark, bronze_path, incoming.schema)
        silver, quarantine, counts = write_cleansed(bronze, f"{root}/cleansed")
        gold = write_gold(silver, f"{root}/gold", settings)
        records = gold.rows
        if atomic:
            release(spark, home, root)
    except Exception:
        log_pipeline_run(spark, log_path, records, "FAILED", source, start_time, datetime.now())
        raise
    run_id = log_pipeline_run(spark, log_path, records, "SUCCESS", source, start_time, datetime.now())
    metrics = run_metrics_from_counts(
        spark, counts[SILVER], gold.alert_rows, counts[QUARANTINE], started, time.time()
    )
    rejected = quarantine.drop(*AUDIT_COLUMNS)
    return Run(run_id, source, silver, rejected, read_malformed(quarantine), gold, metrics)
