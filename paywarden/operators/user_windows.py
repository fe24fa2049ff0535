"""Behavioural columns from windows over each user's own rows.

All windows are partitioned by ``user_id`` or by ``user_id`` and more, so one
shuffle by ``user_id`` serves every column, and every frame only ever grows:

* a count over the last n seconds is the count up to now minus the count up to
  n + 1 seconds ago, so no frame has to be re-read row by row;
* a running distinct count is a running sum of "first time today" flags, so no
  set is built or copied;
* a distinct count over the last n seconds is the number of unbroken stays
  begun so far minus the number that had ended before the frame opened, where
  a stay at one location ends when it is not seen again within n seconds.

Time and memory are therefore linear in the rows of a user.  Users too big for
one task are the business of ``hot_users``.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from paywarden.functions.times import epoch_second
from paywarden.schema import CONTEXT_COLUMNS, FEATURE_COLUMNS, FeatureConfig

BEHAVIOUR_COLUMNS = FEATURE_COLUMNS + CONTEXT_COLUMNS

def _by_second():
    return W.partitionBy("user_id").orderBy("_second")


def _at_location():
    return W.partitionBy("user_id", "location").orderBy("timestamp")


def _on_device():
    return W.partitionBy("user_id", "device_id").orderBy(F.col("timestamp").asc_nulls_last())


def _until_now():
    return _by_second().rangeBetween(W.unboundedPreceding, 0)


def _before_frame(seconds: int):
    """Everything older than the last ``seconds`` seconds."""
    return _by_second().rangeBetween(W.unboundedPreceding, -(seconds + 1))


def _count_last(seconds: int) -> Column:
    older = F.count("transaction_id").over(_before_frame(seconds))
    return F.col("_so_far") - older


def _first_today(name: str, window: WindowSpec) -> Column:
    """1 on the row where ``name`` shows up for the first time that day."""
    new = F.coalesce(F.lag("_day").over(window) != F.col("_day"), F.lit(True))
    return F.when(F.col(name).isNotNull() & new, 1).otherwise(0)


def _stay_edge(neighbour: Column, seconds: int) -> Column:
    """1 where the neighbouring visit to the location is over ``seconds`` away."""
    apart = F.coalesce(F.abs(F.col("_second") - neighbour) > seconds, F.lit(True))
    return F.when(F.col("location").isNotNull() & apart, 1).otherwise(0)


def user_window_columns(
    transactions: DataFrame,
    wanted: Collection[str] = tuple(BEHAVIOUR_COLUMNS),
    config: FeatureConfig = FeatureConfig(),
) -> DataFrame:
    """``transactions`` plus the wanted columns, with one shuffle by user."""
    stay = config.location_seconds
    device, location = _on_device(), _at_location()
    in_day = W.partitionBy("user_id", "_day").orderBy("timestamp")
    flags = {
        "device_switch_frequency": {"_new_device": _first_today("device_id", device)},
        "location_change_rate": {"_new_location": _first_today("location", location)},
        "loc_count_1hr": {
            "_begins": _stay_edge(F.lag("_second").over(location), stay),
            "_ends": _stay_edge(F.lead("_second").over(location), stay),
        },
        # A row without a user or a device matches no earlier one.
        "first_seen_device_ts": {
            "first_seen_device_ts": F.when(
                F.col("user_id").isNotNull() & F.col("device_id").isNotNull(),
                F.min("timestamp").over(device),
            )
        },
    }
    columns = {
        "transaction_velocity": _count_last(config.velocity_seconds),
        "average_transaction_amount": F.avg("amount").over(in_day),
        "device_switch_frequency": F.sum("_new_device").over(in_day).cast("int"),
        "location_change_rate": F.sum("_new_location").over(in_day).cast("int"),
        "daily_transaction_count": F.count("transaction_id").over(in_day),
        "txn_count_10min": _count_last(config.burst_seconds),
        "loc_count_1hr": (
            F.sum("_begins").over(_until_now())
            - F.coalesce(F.sum("_ends").over(_before_frame(stay)), F.lit(0))
        ).cast("int"),
        "first_seen_device_ts": F.col("first_seen_device_ts"),
    }
    wanted = [c for c in BEHAVIOUR_COLUMNS if c in wanted]
    timed = transactions.repartition("user_id").withColumns(
        {"_second": epoch_second(), "_day": F.to_date("timestamp")}
    )
    helpers = {name: column for w in wanted for name, column in flags.get(w, {}).items()}
    flagged = timed.withColumns(helpers) if helpers else timed
    counted = flagged.withColumn("_so_far", F.count("transaction_id").over(_until_now()))
    # No frame around a row without a time.
    timeless = F.col("timestamp").isNull()
    values = {c: columns[c] for c in wanted}
    for c in set(wanted) - {"first_seen_device_ts"}:
        values[c] = F.when(~timeless, values[c])
    return counted.withColumns(values).select(
        *transactions.columns, *wanted
    )
