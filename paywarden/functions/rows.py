"""Putting one-row results together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """One row with the columns of all frames: a union and a maximum, no join."""
    names = [name for frame in one_row_frames for name in frame.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames)
    return stacked.agg(*[F.max(name).alias(name) for name in names])
