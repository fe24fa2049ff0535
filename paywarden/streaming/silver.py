"""Bronze rows that keep coming, cleaned into silver and quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from paywarden.operators.quality import QUARANTINE, SILVER, complete, malformed, normalize_timestamp, require_columns
from paywarden.schema import AUDIT_COLUMNS, BRONZE_SCHEMA, LINEAGE_COLUMNS
from paywarden.sources.tables import read_parquet, shared_folder


@dataclass(frozen=True)
class StreamConfig:
    """How long a copy of a row may come after the first one."""

    copies_within: str = "1 day"


def read_bronze_stream(
    spark: SparkSession, folder: str, schema: T.StructType = BRONZE_SCHEMA, files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files of bronze as they appear in ``folder``, with file and time of arrival."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    lineage = {"_source_file": F.col("_metadata.file_path"), "_ingested_at": F.current_timestamp()}
    return rows.withColumns({c: v for c, v in lineage.items() if c not in schema.fieldNames()})


def _judged(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows fit for silver, and all others."""
    clean = normalize_timestamp(require_columns(bronze))
    fit = complete(clean) & (F.col("amount") > 0) & ~malformed(clean)
    fit = F.coalesce(fit, F.lit(False))
    return clean.where(fit), clean.where(~fit)


def silver_stream(bronze: DataFrame, config: StreamConfig = StreamConfig()) -> DataFrame:
    """Rows fit for silver, one for each id.

    Of copies the first that is fit stays.  State holds an id for as long as
    copies of it may still come, not for ever.  A row that comes later than
    that after newer ones is too late to be told from a copy and is left out
    (``late_rows`` counts them).
    """
    fit, _ = _judged(bronze)
    timed = fit.drop(*AUDIT_COLUMNS).withWatermark("timestamp", config.copies_within)
    return timed.dropDuplicatesWithinWatermark(["transaction_id"])


def quarantine_stream(bronze: DataFrame, config: StreamConfig = StreamConfig()) -> DataFrame:
    """Rejected rows, copies once; a row that is incomplete and has no positive amount twice.

    Their own times may be missing, so copies are told by the time of arrival.
    No row is too late for that.
    """
    _, rest = _judged(bronze)
    whole = [c for c in rest.columns if c not in LINEAGE_COLUMNS]
    once = rest.withWatermark("_ingested_at", config.copies_within).dropDuplicatesWithinWatermark(whole)
    twice = ~complete(once) & F.coalesce(F.col("amount") <= 0, F.lit(False)) & ~malformed(once)
    copies = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return once.withColumn("_copy", F.explode(copies)).drop("_copy")


def _start(rows: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start(path)


def start_cleansing(
    bronze: DataFrame,
    out_path: str,
    name: str,
    config: StreamConfig = StreamConfig(),
    trigger: dict | None = None,
) -> dict[str, StreamingQuery]:
    """Write both layers below ``out_path`` as rows come; by default all there are, then stop.

    Progress and state lie in the shared folder under ``name``: a query that is
    started again with the same name goes on where it stopped, and each row is
    in the tables once.
    """
    spark = bronze.sparkSession
    root, places = out_path.rstrip("/"), f"{shared_folder(spark)}/streams/{name}"
    trigger = trigger or {"availableNow": True}
    layers = {SILVER: silver_stream(bronze, config), QUARANTINE: quarantine_stream(bronze, config)}
    return {n: _start(rows, f"{root}/{n}", f"{places}/{n}", trigger) for n, rows in layers.items()}


def read_streamed(spark: SparkSession, out_path: str, layer: str) -> DataFrame:
    return read_parquet(spark, f"{out_path.rstrip('/')}/{layer}")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late, as far as the query's recent progress tells."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])

