"""``python -m paywarden UPLOADS OUT``: one run with the session's settings."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from paywarden.plans.medallion import run_medallion
from paywarden.sources.tables import read_parquet


def main() -> None:
    parser = argparse.ArgumentParser(description="Run bronze, silver and gold once.")
    parser.add_argument("uploads", help="folder with uploaded CSV or JSON files")
    parser.add_argument("out", help="folder for the tables of the run")
    parser.add_argument("--fallback", help="parquet table to use when there is no upload")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("paywarden").getOrCreate()
    fallback = read_parquet(spark, args.fallback) if args.fallback else None
    run_medallion(spark, args.uploads, args.out, fallback).metrics.show(truncate=False)


if __name__ == "__main__":
    main()
