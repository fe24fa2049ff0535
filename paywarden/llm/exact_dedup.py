"""Exact deduplication with a split for texts that a large share of rows hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from paywarden.llm.tables import stage

#: A digest of this share of all rows or more is frequent: there are at most so many.
HOT_SHARE = 1000
#: Counters of the Misra-Gries sketch; its error, 3.5 / 4096 of the rows, is below a share.
_COUNTERS = 4096


def _digests(docs: DataFrame, text_col: str):
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical; of equal ones the row with the
    largest id stays.  A Misra-Gries sketch over all digests proposes frequent
    ones, an exact count verifies them, and the winners, at most HOT_SHARE rows,
    are broadcast: their rows are settled where they lie.  All other rows are
    shuffled by digest, where no group holds more than a small share of them.

    Null counts as empty text, and empty texts are equal.  A null id loses to
    any other.  Rows that repeat both id and text are one document, marked
    alike; each counts in ``group_size``.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), _digests(docs, text_col).alias("digest"))
    rows = stage(rows, "digests")
    sketch = rows.agg(F.expr(f"approx_top_k(digest, {HOT_SHARE}, {_COUNTERS})").alias("top"), F.count("*").alias("n"))
    found, n = sketch.first()
    spark = docs.sparkSession
    proposed = spark.createDataFrame([(x.item,) for x in found or []], "digest string")
    counted = (
        rows.join(F.broadcast(proposed), "digest")
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") * HOT_SHARE >= n)
    )
    schema = counted.schema
    winners = F.broadcast(spark.createDataFrame(counted.collect(), schema))
    hot = rows.join(winners, "digest").select("id", "keep_id", "group_size", "digest")
    own = Window.partitionBy("digest")
    rest = rows.join(winners.select("digest"), "digest", "left_anti").select(
        "id", F.max("id").over(own).alias("keep_id"), F.count("*").over(own).alias("group_size"), "digest"
    )
    return hot.union(rest).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; one of rows repeating id and text."""
    kept = (
        exact_dedup(docs, id_col, text_col)
        .where("kept")
        .groupBy(F.col("text_sha256").alias("digest"), F.col(id_col).alias("id"))
        .agg(F.count("*").alias("n_rows"))
    )
    # Columns travel under their places, so that no name can clash.
    names = [f"c{i}" for i in range(len(docs.columns))]
    id_name, text_name = (names[docs.columns.index(c)] for c in (id_col, text_col))
    rows = docs.toDF(*names)
    same = _digests(rows, text_name) == F.col("digest")
    own = rows.join(kept, F.col(id_name).eqNullSafe(F.col("id")) & same)
    once = own.where("n_rows = 1")
    repeated = own.where("n_rows > 1").dropDuplicates([id_name, "digest"])
    return once.union(repeated).select(*names).toDF(*docs.columns)
