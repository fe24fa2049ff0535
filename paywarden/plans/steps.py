"""The bronze, silver and gold steps on stored tables.

Each output table is written by one job, and every count or bound a later step
needs is observed in that job, so no table is read only to be counted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywarden.operators.features import behaviour
from paywarden.operators.marts import table_kpis
from paywarden.operators.metrics import run_metrics
from paywarden.operators.quality import QUARANTINE, SILVER, malformed, require_types, routed
from paywarden.operators.rules import detect_fraud_rules
from paywarden.operators.scoring import compute_risk_score, score_bounds
from paywarden.schema import (
    AUDIT_COLUMNS,
    CONTEXT_COLUMNS,
    FeatureConfig,
    RuleConfig,
    ScoreConfig,
    SkewConfig,
)
from paywarden.sources.run_log import read_run_log
from paywarden.sources.tables import read_parquet, stage, write_parquet
from paywarden.sources.uploads import ingest


@dataclass(frozen=True)
class Settings:
    features: FeatureConfig = field(default_factory=FeatureConfig)
    skew: SkewConfig = field(default_factory=SkewConfig)
    score: ScoreConfig = field(default_factory=ScoreConfig)
    rules: RuleConfig = field(default_factory=RuleConfig)


def _rows() -> dict:
    return {"rows": F.count(F.lit(1))}


def write_bronze(bronze: DataFrame, path: str) -> int:
    """Store the rows as they came; returns how many there are.

    Required columns must be there and of bronze's types, or nothing is written.
    """
    return write_parquet(require_types(bronze), path, observed=_rows())["rows"]


def run_bronze_layer(
    spark: SparkSession,
    uploaded_dir: str,
    bronze_dir: str,
    fallback: DataFrame | None = None,
    multi_line: bool = False,
) -> str:
    """Bring the newest upload (or the fallback) into bronze; returns its path."""
    source, _ = ingest(spark, uploaded_dir, fallback, multi_line=multi_line, audit=True)
    path = f"{bronze_dir.rstrip('/')}/transactions_bronze.parquet"
    write_bronze(source, path)
    return path


def layer_path(cleansed_path: str, layer: str) -> str:
    return f"{cleansed_path.rstrip('/')}/layer={layer}"


def read_layer(spark: SparkSession, cleansed_path: str, layer: str, like: DataFrame) -> DataFrame:
    """Silver or quarantine rows; empty, not an error, when there are none.

    The layer is a partition column, so the other layer's files are not read.
    """
    schema = like.schema if "layer" in like.columns else like.withColumn("layer", F.lit("")).schema
    table = read_parquet(spark, cleansed_path, schema)
    return table.where(F.col("layer") == layer).drop("layer")


def read_malformed(quarantine_table: DataFrame) -> DataFrame:
    """The malformed records among quarantined rows, with their text and file."""
    return quarantine_table.where(malformed(quarantine_table))


def write_cleansed(bronze: DataFrame, cleansed_path: str) -> tuple[DataFrame, DataFrame, dict]:
    """Silver and quarantine from one scan, one shuffle and one write.

    Returns both tables and their observed row counts by layer.  Quarantine
    keeps the audit columns that bronze may have, silver does without.
    """
    rows = routed(bronze)
    counts = write_parquet(
        rows,
        cleansed_path,
        partition_by=["layer"],
        open_partitions=2,
        observed={n: F.count_if(F.col("layer") == n) for n in (SILVER, QUARANTINE)},
    )
    spark = bronze.sparkSession
    silver, rejected = (read_layer(spark, cleansed_path, n, rows) for n in (SILVER, QUARANTINE))
    return silver.drop(*AUDIT_COLUMNS), rejected, counts


def run_silver_layer(spark: SparkSession, bronze_path: str, cleansed_path: str) -> tuple[str, str]:
    """Clean a bronze table; returns the paths of silver and quarantine."""
    silver, rejected, counts = write_cleansed(read_parquet(spark, bronze_path), cleansed_path)
    paths = {n: layer_path(cleansed_path, n) for n in (SILVER, QUARANTINE)}
    for layer, rows in ((SILVER, silver), (QUARANTINE, rejected)):
        if not counts[layer]:
            # A table without rows is still a table to the steps that read it by path.
            write_parquet(rows, paths[layer])
    return paths[SILVER], paths[QUARANTINE]


def _feature_columns(silver: DataFrame, settings: Settings) -> DataFrame:
    return behaviour(silver, config=settings.features, skew=settings.skew)


def _observed_features() -> dict:
    return _rows() | score_bounds()


def stage_features(silver: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, dict]:
    """Features and rule context as a table in the shared folder, with bounds."""
    return stage(_feature_columns(silver, settings), "features", _observed_features())


def generate_fraud_features(
    spark: SparkSession, silver_path: str, features_path: str, settings: Settings = Settings()
) -> dict:
    """Write the features table; returns its row count and score bounds."""
    silver = read_parquet(spark, silver_path).drop(*AUDIT_COLUMNS)
    return write_parquet(
        _feature_columns(silver, settings), features_path, observed=_observed_features()
    )


@dataclass(frozen=True)
class Gold:
    features: DataFrame
    scored: DataFrame
    alerts: DataFrame
    rows: int
    alert_rows: int


def write_gold(silver: DataFrame, gold_dir: str, settings: Settings = Settings()) -> Gold:
    """Features, scored rows and alerts as three tables.

    The features job shuffles once, by user.  It also observes the score bounds
    and carries the rules' context, so the two jobs after it only map rows.
    """
    spark = silver.sparkSession
    root = gold_dir.rstrip("/")
    features_path = f"{root}/features_gold.parquet"
    scored_path = f"{root}/scored_gold.parquet"
    alerts_path = f"{root}/fraud_alerts.parquet"

    computed = _feature_columns(silver, settings)
    observed = write_parquet(computed, features_path, observed=_observed_features())
    features = read_parquet(spark, features_path, computed.schema)

    scored = compute_risk_score(features, observed, settings.score)
    write_parquet(scored.drop(*CONTEXT_COLUMNS), scored_path)
    alerts = detect_fraud_rules(scored, settings.rules)
    alert_rows = write_parquet(alerts, alerts_path, observed=_rows())["rows"]
    return Gold(
        features=features,
        scored=read_parquet(spark, scored_path, scored.drop(*CONTEXT_COLUMNS).schema),
        alerts=read_parquet(spark, alerts_path, alerts.schema),
        rows=observed["rows"],
        alert_rows=alert_rows,
    )


def run_gold_layer(
    spark: SparkSession, silver_path: str, gold_dir: str, settings: Settings = Settings()
) -> Gold:
    return write_gold(read_parquet(spark, silver_path).drop(*AUDIT_COLUMNS), gold_dir, settings)


def compute_pipeline_metrics(
    spark: SparkSession, silver_path: str, alerts_path: str, quarantine_path: str,
    start_time: float, end_time: float,
) -> dict:
    """Run metrics of stored tables as a dictionary."""
    tables = (read_parquet(spark, p) for p in (silver_path, alerts_path, quarantine_path))
    return run_metrics(*tables, start_time, end_time).first().asDict()


def load_kpis(
    spark: SparkSession, gold_dir: str, log_path: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """KPIs, alerts and features of the last run; a missing table is an error.

    The run log lies beside the tables unless ``log_path`` names it.
    """
    root = gold_dir.rstrip("/")
    alerts = read_parquet(spark, f"{root}/fraud_alerts.parquet")
    features = read_parquet(spark, f"{root}/features_gold.parquet")
    log = read_run_log(spark, log_path or f"{root}/pipeline_metadata.parquet")
    return table_kpis(features, alerts, log), alerts, features
