"""Array expressions that stay inside generated code (no lambdas)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def without_nulls(texts: Column) -> Column:
    """The distinct non-NULL texts of an array, in order."""
    return F.array_except(texts, F.array(F.lit(None).cast("string")))
