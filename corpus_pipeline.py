"""The stages that turn raw documents into training tokens."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paywarden.llm.decontamination import find_leaks
from paywarden.llm.exact_dedup import drop_exact_copies
from paywarden.llm.jaccard_join import jaccard_components
from paywarden.llm.language_id import DIMENSIONS, UNKNOWN, learn, predict
from paywarden.llm.sentencepiece import encode
from paywarden.llm.tables import stage as _written


def _name() -> Column:
    """What rows are told apart by: ids may be null or repeated, so the text's digest as well."""
    digest = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), digest.alias("digest"))


def _rows_named(docs: DataFrame, names: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` whose name is among ``names``, or is not, with all their columns."""
    columns = docs.columns
    # Columns travel under their places, so that no name can clash.
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], _name().alias("own"))
    names = names.select("name").distinct()
    return rows.join(names, F.col("own").eqNullSafe(F.col("name")), how).drop("own").toDF(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts and texts without a letter.

    This also holds where no row has a label, and a label that says unknown
    takes no document with it.  Columns may have any name.
    """
    learned = {lang: v for lang, v in learn(docs).items() if lang != UNKNOWN}
    # With nothing learned, any language is as near as another.
    # Columns travel under their places, so that no name can clash.
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    rows = predict(docs.toDF(*names), learned or {"": np.zeros(DIMENSIONS)}, text_col=text)
    return rows.where(F.col("lang_pred") != UNKNOWN).select(*names).toDF(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the row with the largest id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 the one with the smallest id stays.

    Null ids come last, and of equal ids the smallest digest is taken.
    """
    named = docs.select(_name().alias("name"), "text")
    kept = jaccard_components(named, id_col="name", size=5, percent=80).where("name = component_id")
    return _rows_named(docs, kept, "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = find_leaks(docs.select(_name().alias("name"), "text"), items, id_col="name")
    return _rows_named(docs, leaks, "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left, with their number."""
    return encode(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", tokens),
]

#: Language profiles and byte-level tokens are beyond SQL; tests/llm has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = _written(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def pipeline_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
