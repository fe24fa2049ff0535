"""The operators applied to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paywarden.llm import language_id, personal_data, secrets
from paywarden.llm.chat_format import formatted_digests
from paywarden.llm.decontamination import find_leaks
from paywarden.llm.exact_dedup import exact_dedup
from paywarden.llm.html_extraction import extract_pages
from paywarden.llm.jaccard_join import jaccard_components
from paywarden.llm.license_scan import scan_licenses
from paywarden.llm.periodic_runs import periodic_runs
from paywarden.llm.personal_data import find_personal_data
from paywarden.llm.ranked_search import ranked_search
from paywarden.llm.sentencepiece import encode
from paywarden.llm.substring_dedup import remove_repeats

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _joined(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    one = lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])
    return F.array_join(F.transform(spans, one), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_documents(spark, sf_dir))


def held_out(docs: DataFrame) -> DataFrame:
    """The documents with a column that tells which ones nothing is learned from."""
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return docs.withColumn("held_out", F.coalesce(third, F.lit(False)))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = held_out(_documents(spark, sf_dir))
    prototypes = language_id.learn(docs.where("not held_out"))
    return language_id.predict(docs, prototypes, keep=["doc_id", "held_out"])


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(_documents(spark, sf_dir))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    probe = [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    return formatted_digests(rows.union(spark.createDataFrame(probe, rows.schema)))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_personal_data(_documents(spark, sf_dir))
    base = F.filter("spans", lambda x: x["kind"] < 4)
    return rows.select(
        "doc_id",
        *[_count(i).alias(f"n_{k}") for i, k in enumerate(personal_data.KINDS[:4])],
        F.sha2(_joined(base, personal_data.KINDS), 256).alias("base_sha256"),
        _joined(F.col("spans"), personal_data.KINDS).alias("spans"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(_documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.find_secrets(_documents(spark, sf_dir))
    base = F.filter("spans", lambda x: x["kind"] < 3)
    return rows.select(
        "doc_id",
        *[_count(i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS[:3])],
        F.sha2(_joined(base, secrets.KINDS), 256).alias("base_sha256"),
        _joined(F.col("spans"), secrets.KINDS).alias("spans"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(_documents(spark, sf_dir), items, least_chars=1)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf_dir))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def with_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten, by its id, ends in a periodic run of its own words."""
    h, n = crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [*words[:a], *(words[a + i % p] for i in range(n - a))]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(_documents(spark, sf_dir), prepare=with_repeats)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"], r["length"])))
    rows = rows.withColumn("longest", longest)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.expr("(1000 * longest.length) div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def llm_queries() -> dict[str, Query]:
    made = (
        op1_license_scan,
        op2_language_id,
        op3_sentencepiece,
        op4_chat_format,
        op5_personal_data,
        op6_exact_dedup,
        op7_substring_dedup,
        op8_secret_scan,
        op9_decontamination,
        op10_jaccard_join,
        op11_html_extraction,
        op12_ranked_search,
        op13_periodic_runs,
    )
    return {f.__name__: f for f in made}
