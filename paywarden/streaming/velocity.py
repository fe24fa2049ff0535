"""How often users transact, on a stream of clean transactions.

``window_counts`` counts in sliding windows of event time.  ``velocity_stream``
gives each transaction the exact count of its user's last hour, the same value
as the batch feature.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from paywarden.functions.times import epoch_second
from paywarden.schema import FeatureConfig
from paywarden.sources.tables import read_parquet, shared_folder, write_parquet

_COUNTS = "user_id string, window_start timestamp, window_end timestamp, txn_count long"


def window_counts(transactions: DataFrame, length: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Transactions of each user in each window; the same on a stream and on a table."""
    window = F.window("timestamp", length, slide)
    counts = transactions.groupBy("user_id", window).agg(F.count(F.lit(1)).alias("txn_count"))
    return counts.select("user_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "txn_count")


def start_window_counts(
    transactions: DataFrame,
    out_path: str,
    name: str,
    late_by: str = "1 hour",
    length: str = "1 hour",
    slide: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the counts up to date as rows come, open windows too.

    Rows may come ``late_by`` after newer ones and still change their windows;
    state of older windows is let go.  Each batch writes the counts it changed
    to a folder of its own, so a batch that is run again after a loss replaces
    what it wrote.

    Rows are dealt out before they are counted: a row is in several windows, and
    a task that counts all windows of the files it reads holds them all.  Keep
    many open windows in the RocksDB state store, the default one is in memory.
    """
    rows = transactions.select("user_id", "timestamp").repartition("user_id", "timestamp")
    counts = window_counts(rows.withWatermark("timestamp", late_by), length, slide)
    root = out_path.rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        write_parquet(batch, f"{root}/batch={number}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write).trigger(**(trigger or {"availableNow": True}))
    spark = transactions.sparkSession
    return writer.option("checkpointLocation", f"{shared_folder(spark)}/streams/{name}/windows").start()


def read_window_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The latest count of each user and window."""
    keys = ["user_id", "window_start", "window_end"]
    # A window's count only ever grows, so its latest is its greatest.  A number
    # of partitions that is named is not merged into fewer at run time.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = read_parquet(spark, out_path).repartition(parts, *keys)
    return rows.groupBy(*keys).agg(F.max("txn_count").alias("txn_count"))


#: Users are dealt out to so many keys of state; a checkpoint holds for one number only.
_BUCKETS = 1024


def _packed(rows: pd.DataFrame) -> tuple[bytes]:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(value: tuple[bytes]) -> pd.DataFrame:
    return pa.ipc.open_stream(value[0]).read_all().to_pandas()


def _passed(second: int) -> int:
    """The watermark, in ms, at which no row of ``second`` can come any more."""
    return (int(second) + 1) * 1000


class _LastHour(StatefulProcessor):
    """Rows wait until no earlier one can come, then get their count.

    State of a bucket of users: the waiting rows in chunks as they came, their
    ids apart; how many rows each user has in seconds that are out but still in
    a frame; and a timer for the earliest waiting second.  When the watermark
    passes waiting rows, all of these are counted together, and ids are read
    one chunk at a time.
    """

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "due long, chunks long")
        self.waiting = handle.getMapState("waiting", "chunk long", "rows binary")
        self.ids = handle.getMapState("ids", "chunk long", "ids binary")
        self.counted = handle.getValueState("counted", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        was, chunks = self.head.get() or (None, 0)
        due = was
        for batch in rows:
            # Ids that are NULL are rows, but not counted.
            n = batch["transaction_id"].notna().astype("int64")
            self.waiting.updateValue((chunks,), _packed(batch[["user_id", "second"]].assign(n=n)))
            self.ids.updateValue((chunks,), _packed(batch[["transaction_id"]]))
            chunks += 1
            first = _passed(batch["second"].min())
            due = first if due is None else min(due, first)
        if due != was:
            if was is not None:
                self.handle.deleteTimer(was)
            self.handle.registerTimer(due)
        self.head.update((due, chunks))
        return iter(())

    def _velocity(self, rows: pd.DataFrame) -> np.ndarray:
        """For each row, its user's ``n`` up to its second, as far back as the frame goes."""
        user, second = pd.factorize(rows["user_id"])[0], rows["second"].to_numpy()
        # Users in a row, each further from the next than a frame is long.
        place = second - second.min() + self.seconds + 1
        place = user * (place.max() + 1) + place
        places, at = np.unique(place, return_inverse=True)
        n = np.zeros(len(places), np.int64)
        np.add.at(n, at, rows["n"].to_numpy())
        upto = np.append(0, np.cumsum(n))
        return upto[at + 1] - upto[np.searchsorted(places, place - self.seconds)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Seconds before this one are whole.
        end = timerValues.getCurrentWatermarkInMs() // 1000
        waiting = {k[0]: _unpacked(v) for k, v in self.waiting.iterator()}
        counted = self.counted.get()
        # Those that are out already come first.
        ready = [] if counted is None else [_unpacked(counted)]
        done = sum(map(len, ready))
        ready = pd.concat([*ready, *[rows[rows["second"] < end] for rows in waiting.values()]], ignore_index=True)
        velocity = self._velocity(ready)[done:]
        due = None
        for chunk, rows in waiting.items():
            out = rows["second"] < end
            if not out.all():
                first = _passed(rows.loc[~out, "second"].min())
                due = first if due is None else min(due, first)
            if not out.any():
                continue
            ids = _unpacked(self.ids.getValue((chunk,)))
            if out.all():
                self.waiting.removeKey((chunk,))
                self.ids.removeKey((chunk,))
            else:
                self.waiting.updateValue((chunk,), _packed(rows[~out]))
                self.ids.updateValue((chunk,), _packed(ids[~out]))
            found = rows.loc[out, ["user_id"]].assign(transaction_id=ids["transaction_id"], second=rows["second"])
            own, velocity = velocity[: len(found)], velocity[len(found) :]
            yield found.assign(transaction_velocity=own).reset_index(drop=True)
        # What comes out later looks back no further than from the end.
        near = ready[ready["second"] >= end - self.seconds]
        if len(near):
            self.counted.update(_packed(near.groupby(["user_id", "second"], as_index=False)["n"].sum()))
        else:
            self.counted.clear()
        if due is None:
            self.head.clear()
        else:
            self.handle.registerTimer(due)
            self.head.update((due, max(waiting) + 1))

    def close(self) -> None:
        pass


def velocity_stream(transactions: DataFrame, late_by: str = "10 minutes", config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """(user_id, transaction_id, second, transaction_velocity) of a stream of transactions.

    A row comes out when the watermark, ``late_by`` behind the newest row, has
    passed its second: then all rows that count for it are there, in whatever
    order they came.  Rows that come later than that are left out and counted
    as such in the query's progress.  State spans the look-back frame and the
    waiting time; it is kept by buckets of users, so that its cost goes by rows
    and not by users.  Needs the RocksDB state store.
    """
    rows = transactions.select(
        "user_id", "transaction_id", "timestamp", epoch_second().alias("second"),
        F.pmod(F.xxhash64("user_id"), F.lit(_BUCKETS)).alias("bucket"),
    )
    rows = rows.where("user_id is not null and timestamp is not null")
    return (
        rows.withWatermark("timestamp", late_by)
        .groupBy("bucket")
        .transformWithStateInPandas(
            _LastHour(config.velocity_seconds),
            "user_id string, transaction_id string, second long, transaction_velocity long",
            "append",
            "eventTime",
        )
    )
