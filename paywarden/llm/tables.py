"""Intermediate tables in the shared folder, and filters of bounded size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

_SEGMENTS = 64
_LEAST_BITS = 1 << 16
#: A filter never takes more than 32 MB; with more keys it passes more rows on.
_MOST_BITS = 1 << 28


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a new one in local mode if unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Later steps start there, so a lost executor costs only its running tasks.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class KeyFilter:
    """A bitmap of 64-bit keys: no key is missed, a few others may pass."""

    def __init__(self, shared, bits: int):
        self._shared, self._bits = shared, bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = _bit(keys, self._bits)
        return (self._shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _bit(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.astype(np.uint64) >> np.uint64(65 - bits.bit_length())).astype(np.int64)


def key_filter(keys: DataFrame, column: str, n_keys: int) -> KeyFilter:
    """A filter over a column of evenly spread 64-bit keys, about 16 bits for each."""
    spark = keys.sparkSession
    bits = min(_MOST_BITS, max(_LEAST_BITS, 1 << int(16 * n_keys).bit_length()))
    size = bits // _SEGMENTS

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: dict[int, np.ndarray] = {}
        for batch in batches:
            at = _bit(np.asarray(batch.column(0), np.int64), bits)
            for segment in np.unique(at // size).tolist():
                own = segments.setdefault(segment, np.zeros(size, bool))
                own[at[at // size == segment] % size] = True
        for segment, own in segments.items():
            blob = np.packbits(own, bitorder="little").tobytes()
            yield pa.RecordBatch.from_pydict({"segment": [segment], "blob": [blob]})

    # Top six bits pick the segment; each is filled by one task.
    top = F.shiftrightunsigned(F.col(column), 58)
    rows = (
        keys.select(column)
        .repartition(16, top)
        .mapInArrow(fill, "segment long, blob binary")
        .collect()
    )
    whole = np.zeros(bits // 8, np.uint8)
    for row in rows:
        begin = row.segment * size // 8
        whole[begin : begin + size // 8] = np.frombuffer(row.blob, np.uint8)
    return KeyFilter(spark.sparkContext.broadcast(whole), bits)
