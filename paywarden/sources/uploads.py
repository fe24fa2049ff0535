"""Transactions as uploaded: newest CSV or JSON of a folder, or a fallback."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from paywarden.schema import AUDIT_COLUMNS, BRONZE_SCHEMA, CORRUPT_RECORD

# Texts that mean "no value" in an uploaded CSV.
NO_VALUE_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _typed(raw: DataFrame) -> DataFrame:
    """Bronze types by column name; other columns stay as they are."""
    types = {f.name: f.dataType for f in BRONZE_SCHEMA.fields}
    return raw.withColumns(
        {c: F.col(f"`{c}`").try_cast(types[c]) for c in raw.columns if c in types}
    )


def _unused(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _malformed(record: Column, fields: int) -> Column:
    """Does the text of a CSV record hold more than ``fields`` fields or a quote left open?

    Doubled quotes stand for one and go first; then a quoted field reaches from
    a separator to the next quote that a separator follows.
    """
    plain = F.regexp_replace(F.replace(record, F.lit('""')), r'(^|,)"[^"]*"(?=,|\r?\z)', "$1")
    separators = F.length(plain) - F.length(F.replace(plain, F.lit(",")))
    return (separators >= fields) | plain.rlike('(^|,)"')


def _audited(corrupt: Column) -> dict[str, Column]:
    """The audit columns of rows read from files."""
    return {
        CORRUPT_RECORD: corrupt,
        "_source_file": F.col("_metadata.file_path"),
        "_ingested_at": F.current_timestamp(),
    }


def read_csv(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    audit: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """CSV with a header; columns are matched by name, in any order.

    ``columns`` names the fields of files without a header line.  A number that
    cannot be read becomes NULL, which quarantine picks up.  Missing last fields
    are NULL.  ``multi_line`` is for quoted line breaks; such a file is read by
    one task.

    A record with more fields than columns, or with a quote that is never
    closed, is malformed: what it goes on with has no column to go to.  With
    ``audit`` it is kept, with its whole text in ``_corrupt_record``, and every
    row tells its file and the time it came in; otherwise reading it raises.
    """
    reader = spark.read.option("escape", '"').option("multiLine", multi_line)
    if columns is None:
        reader = reader.option("header", True)
    names = list(columns) if columns is not None else reader.csv(path).columns
    if not names:
        return reader.csv(path)
    corrupt = _unused(CORRUPT_RECORD, names)
    # All columns are parsed, or records would be judged by the wanted ones alone.
    reader = reader.option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False)
    raw = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in [*names, corrupt]])).csv(path)
    # Spark sets the text of every record with another number of fields, short ones too.
    record = F.col(corrupt)
    text = F.when(record.isNotNull(), F.when(_malformed(record, len(names)), record))
    stop = F.lit(None).cast("string")
    if audit:
        raw = raw.withColumns(_audited(text))
    else:
        problem = F.concat(F.lit("CSV record with too many fields or an open quote: "), text)
        stop = F.when(record.isNotNull(), F.when(text.isNotNull(), F.raise_error(problem).cast("string")))
    added = AUDIT_COLUMNS if audit else []
    cleaned = {
        c: F.coalesce(stop, F.when(~F.col(f"`{c}`").isin(NO_VALUE_TEXTS), F.col(f"`{c}`")))
        for c in names
        if c not in added
    }
    return _typed(raw.withColumns(cleaned).select(*[F.col(f"`{c}`") for c in cleaned], *added))


def _plain_time(text: Column) -> Column:
    """Text in bronze's format for ISO times and for numbers since 1970 in UTC.

    A number is in the largest unit (s, ms, us, ns) that puts it before 2262,
    numbers below one year are no times.  Fractions of a second are dropped,
    and so is a final Z.
    """
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?Z?$")
    number = F.when(text.rlike(r"^\d{8,19}$"), text.try_cast("long"))
    second = F.when(number < 31_536_000, None)
    for unit in (1, 10**3, 10**6, 10**9):
        second = second.when(number <= min(9_223_372_036 * unit, 2**63 - 1), (number - number % unit) / unit)
    second = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=second)
    since = F.substring(second.cast("string"), 1, 19)
    plain = F.translate(F.substring(text, 1, 19), "T", " ")
    return F.when(iso, plain).otherwise(F.coalesce(since, text))


def read_json(
    spark: SparkSession, path: str, lines: bool = False, extra_fields: bool = False, audit: bool = False
) -> DataFrame:
    """An array of records, or one record per line with ``lines``.

    An array is read by one task per file; large inputs should come as lines.
    ``extra_fields`` keeps fields beyond the bronze columns, as text where they
    are single values; finding their names reads the input once more.  Numbers
    may be given as texts.

    With ``audit`` a record that is no JSON keeps its text in
    ``_corrupt_record`` (of an array, the text of the file), and every row tells
    its file and the time it came in.
    """
    reader = spark.read.option("multiLine", not lines)
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in BRONZE_SCHEMA.fields])
    if extra_fields:
        known = {c.lower() for c in [*schema.fieldNames(), *AUDIT_COLUMNS]}
        found = reader.option("primitivesAsString", True).json(path).schema.fields
        schema = T.StructType([*schema.fields, *(f for f in found if f.name.lower() not in known)])
    names = schema.fieldNames()
    if audit:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
    raw = reader.schema(schema).json(path)
    if audit:
        raw = raw.withColumns(_audited(F.col(CORRUPT_RECORD)))
    rows = raw.select(*[F.col(f"`{c}`") for c in names], *(AUDIT_COLUMNS if audit else []))
    return _typed(rows.withColumn("timestamp", _plain_time(F.col("timestamp"))))


def _newest(spark: SparkSession, folder: str) -> tuple[str, bool] | None:
    """The upload in ``folder`` that changed last, and whether it is a folder itself."""
    folder = folder.rstrip("/")
    try:
        # The files that lie in ``folder`` and the part files right below; nothing deeper.
        listing = (
            spark.read.format("binaryFile")
            .load(f"{folder}/*.{{csv,json,jsonl}}")
            .select("path", "modificationTime")
        )
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    own = folder.rsplit("/", 1)[-1]
    own = "[^/]+" if own in ("", ".", "..") else re.escape(own)
    upload = F.regexp_extract("path", rf"^(.*?/{own}/[^/]+\.(?:csv|json|jsonl))(?:/[^/]+)?$", 1)
    newest = (
        listing.withColumn("upload", upload)
        .groupBy("upload")
        .agg(F.max("modificationTime").alias("changed"), F.max(F.col("path") != F.col("upload")).alias("parts"))
        .orderBy(F.desc("changed"), F.desc("upload"))
        .limit(1)
        .collect()
    )
    return (newest[0].upload, newest[0].parts) if newest else None


def latest_upload(spark: SparkSession, folder: str) -> str | None:
    """Path of the CSV or JSON in ``folder`` that changed last, None if there is none.

    An upload may be a file or a folder of part files, as Spark writes it;
    other folders are not looked into.  Only the listing is read, not the
    files; ties go to the greater name.  A folder that does not exist holds no
    uploads.
    """
    newest = _newest(spark, folder)
    return newest[0] if newest else None


def ingest(
    spark: SparkSession,
    upload_folder: str,
    fallback: DataFrame | None = None,
    fallback_source: str = "synthetic",
    multi_line: bool = False,
    audit: bool = False,
) -> tuple[DataFrame, str]:
    """The newest upload, else the fallback, and which of the two it was.

    ``.jsonl`` files and folders of part files hold one record per line, other
    JSON files an array.  ``multi_line`` allows quoted line breaks in a CSV.
    ``audit`` keeps malformed records and adds the audit columns; the fallback's
    rows come from no file.
    """
    newest = _newest(spark, upload_folder)
    if newest:
        path, parts = newest
        if path.endswith(".csv"):
            return read_csv(spark, path, multi_line, audit), "uploaded"
        lines = parts or path.endswith(".jsonl")
        return read_json(spark, path, lines, extra_fields=True, audit=audit), "uploaded"
    if fallback is None:
        raise ValueError(f"no CSV or JSON in {upload_folder} and no fallback given")
    if audit:
        none = F.lit(None).cast("string")
        known = {CORRUPT_RECORD: none, "_source_file": none, "_ingested_at": F.current_timestamp()}
        fallback = fallback.withColumns({c: v for c, v in known.items() if c not in fallback.columns})
    return fallback, fallback_source
