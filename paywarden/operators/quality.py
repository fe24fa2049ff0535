"""Schema check, deduplication, validation and quarantine.

Every predicate here is a negation or conjunction on one deduplicated scan, so
a whole silver step costs a single shuffle: the one that deduplicates.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from paywarden.functions.arrays import without_nulls
from paywarden.functions.times import parsed_timestamp
from paywarden.schema import AUDIT_COLUMNS, BRONZE_SCHEMA, CORRUPT_RECORD, SILVER_SCHEMA, TRANSACTION_COLUMNS

SILVER = "silver"
QUARANTINE = "quarantine"


def schema_problems(df: DataFrame, expected: T.StructType = SILVER_SCHEMA) -> list[str]:
    """Missing columns, wrong types and unexpected columns, in that order."""
    found = {f.name: f.dataType for f in df.schema.fields}
    missing = [f"missing column {f.name}" for f in expected.fields if f.name not in found]
    wrong = [
        f"column {f.name} is {found[f.name].simpleString()}, expected {f.dataType.simpleString()}"
        for f in expected.fields
        if f.name in found and found[f.name] != f.dataType
    ]
    extra = [f"unexpected column {n}" for n in found if n not in expected.fieldNames()]
    return missing + wrong + extra


def validate_schema(df: DataFrame) -> bool:
    """True when all required columns are present, whatever their types."""
    return all(name in df.columns for name in TRANSACTION_COLUMNS)


def require_columns(df: DataFrame) -> DataFrame:
    if not validate_schema(df):
        absent = [c for c in TRANSACTION_COLUMNS if c not in df.columns]
        raise ValueError(f"required columns are missing: {', '.join(absent)}")
    return df


def keep_one(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the greatest by the remaining columns, NULL lowest.

    Asking for the first row of each key lets Spark drop all but one row per
    key inside each map task, so a key with a third of all rows reaches its
    reducer as one row per task.  The choice depends on values only: a task
    that runs again after an executor is lost picks the same row.
    """
    rest = [F.col(f"`{c}`").desc() for c in df.columns if c not in keys]
    best_first = W.partitionBy(*keys).orderBy(*(rest or [F.lit(1)]))
    ranked = df.withColumn("_rank", F.row_number().over(best_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def require_types(df: DataFrame) -> DataFrame:
    """``df`` if its required columns are there with bronze's types; times may be text or timestamps."""
    times = (T.StringType, T.TimestampType, T.TimestampNTZType)
    read = {f.name: f for f in df.schema.fields}
    if "timestamp" in read and isinstance(read["timestamp"].dataType, times):
        read["timestamp"] = BRONZE_SCHEMA["timestamp"]
    seen = df.sparkSession.createDataFrame([], T.StructType([read[c] for c in read if c in TRANSACTION_COLUMNS]))
    problems = schema_problems(seen, BRONZE_SCHEMA)
    if problems:
        raise ValueError(f"not the columns of bronze: {'; '.join(problems)}")
    return df


def malformed(df: DataFrame) -> Column:
    """Rows whose record could not be read whole; none where no record's text is kept."""
    return F.col(CORRUPT_RECORD).isNotNull() if CORRUPT_RECORD in df.columns else F.lit(False)


def deduplicate(df: DataFrame) -> DataFrame:
    """One row per transaction id; all NULL ids together count as one id.

    Malformed rows compete with no others: one stays for each id and record.
    """
    return keep_one(df, ["transaction_id", *(c for c in [CORRUPT_RECORD] if c in df.columns)])


def normalize_timestamp(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", parsed_timestamp(df))


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def absent(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    null = F.col(name).isNull()
    return null | F.isnan(name) if _is_float(df, name) else null


def complete(df: DataFrame) -> Column:
    """All required columns hold a value."""
    return reduce(and_, (~absent(df, name) for name in TRANSACTION_COLUMNS))


def complete_rows(df: DataFrame) -> DataFrame:
    return df.where(complete(df))


def incomplete_rows(df: DataFrame) -> DataFrame:
    """The rows ``complete_rows`` leaves out.

    On rows that are unique by id this equals ``df EXCEPT complete_rows(df)``
    without the anti join.
    """
    return df.where(~complete(df))


def positive_amount(df: DataFrame) -> DataFrame:
    return df.where(F.col("amount") > 0)


def nonpositive_amount(df: DataFrame) -> DataFrame:
    return df.where(F.col("amount") <= 0)


def silver_rows(deduplicated: DataFrame) -> DataFrame:
    return positive_amount(complete_rows(deduplicated))


def quarantine_rows(deduplicated: DataFrame) -> DataFrame:
    """Rejected rows; one that is incomplete *and* non-positive appears twice."""
    return incomplete_rows(deduplicated).unionByName(nonpositive_amount(deduplicated))


def routed(bronze: DataFrame) -> DataFrame:
    """Bronze in, silver and quarantine rows out, told apart by ``layer``.

    Scan, one shuffle for the ids, then everything else in one projection.
    Written with ``partitionBy("layer")`` this fills both tables in one job.
    Malformed rows are rejected once, whatever could be read of them.
    """
    clean = normalize_timestamp(deduplicate(require_columns(bronze)))
    ok, low = complete(clean), F.col("amount") <= 0
    rejected = F.lit(QUARANTINE)
    layers = (
        F.when(malformed(clean), F.array(rejected))
        .when(ok & (F.col("amount") > 0), F.array(F.lit(SILVER)))
        .when(~ok & low, F.array(rejected, rejected))
        .otherwise(F.array(rejected))
    )
    return clean.withColumn("layer", F.explode(layers))


def quarantine_reasons(bronze: DataFrame) -> DataFrame:
    """One row per rejected transaction with the list of its reasons."""
    unique = deduplicate(require_columns(bronze))
    parsed = parsed_timestamp(unique)
    checks = [
        F.when(absent(unique, c), F.lit(f"missing {c}"))
        for c in TRANSACTION_COLUMNS
    ]
    checks.insert(0, F.when(malformed(unique), F.lit("malformed record")))
    checks.append(
        F.when(F.col("timestamp").isNotNull() & parsed.isNull(), F.lit("unreadable timestamp"))
    )
    checks.append(F.when(F.col("amount") <= 0, F.lit("amount not positive")))
    return unique.withColumns(
        {"timestamp": parsed, "quarantine_reasons": without_nulls(F.array(*checks))}
    ).where(F.size("quarantine_reasons") > 0)


def stage_counts(bronze: DataFrame) -> DataFrame:
    """Row counts after each silver stage, all from one scan and one deduplication.

    The copies of an id are counted where the best of them is taken, so the
    number of raw rows needs no scan of its own, and a task that is run again
    counts once.
    """
    keys = ["transaction_id", *(c for c in [CORRUPT_RECORD] if c in bronze.columns)]
    rest = [c for c in require_columns(bronze).columns if c not in keys]
    # The greatest by the remaining columns, as in keep_one.
    best = F.max(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_best")
    unique = bronze.groupBy(*keys).agg(best, F.count(F.lit(1)).alias("_copies")).select(*keys, "_copies", "_best.*")
    unique = normalize_timestamp(unique)
    bad = malformed(unique)
    ok, low = complete(unique) & ~bad, (F.col("amount") <= 0) & ~bad
    return unique.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("bronze_rows"),
        F.count(F.lit(1)).alias("unique_rows"),
        F.count_if(ok).alias("complete_rows"),
        F.count_if(~ok).alias("incomplete_rows"),
        F.count_if(ok & (F.col("amount") > 0)).alias("silver_rows"),
        (F.count_if(~ok) + F.count_if(low)).alias("quarantine_rows"),
    )
