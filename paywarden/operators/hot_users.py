"""The same behavioural columns for users too big for one task.

One account (a test terminal, an aggregator, a default id) can hold a third of
all rows, and its window partition cannot be split.  But every behavioural
column except the first time on a device (an ordinary grouped minimum) is the
same for all rows of a user at one instant, and is a running sum of changes
over time.

The rows are read once and summed up per user, instant, device and location,
partly before the shuffle already.  All changes are made from that table.  They
are summed per user and instant, running totals are taken inside one-minute
blocks, and the totals of earlier blocks are added on top.  Stays at a location
are found inside one-hour blocks, whose first and last second are carried to
the blocks beside them.  The groups the windows see are the distinct instants of
one minute, one user's list of minutes, and a user's list of hours at one
location: all bounded by how much time the data spans, none by how many rows
there are.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paywarden.functions.joins import join_lookup
from paywarden.functions.times import epoch_second
from paywarden.operators.user_windows import BEHAVIOUR_COLUMNS
from paywarden.schema import FeatureConfig, SkewConfig
from paywarden.sources.tables import stage

_BLOCK_SECONDS = 60
_STAY_BLOCK_SECONDS = 3600

# Changes that add up from midnight, and changes that add up for ever because
# what enters a look-back frame is taken out again when the frame has passed.
_PER_DAY = ["_rows", "_amounts", "_amount_sum", "_devices", "_locations"]
_SLIDING = ["_velocity", "_burst", "_places"]

_FIRST_SEEN = {"device_switch_frequency": "device_id", "location_change_rate": "location"}


def find_hot_users(transactions: DataFrame, config: SkewConfig = SkewConfig()) -> DataFrame:
    """Ids with more than ``hot_rows`` rows, as a table of one row each.

    It reads the id column only and counts before it shuffles.  However many
    such users there are, none is collected: the table is joined to the rows.
    """
    return (
        transactions.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > config.hot_rows)
        .select("user_id")
    )


def split_hot(transactions: DataFrame, hot_users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows for the split path, and all others; rows without a user are among these."""
    hot = hot_users.select(F.col("user_id").alias("_hot_user"))
    own = F.col("user_id") == F.col("_hot_user")
    return transactions.join(hot, own, "left_semi"), transactions.join(hot, own, "left_anti")


def _change(at: Column, **amounts: Column) -> Column:
    """How much of what changes for a user at one instant."""
    filled = [
        amounts.get(c, F.lit(None)).cast("double" if c == "_amount_sum" else "long").alias(c)
        for c in _PER_DAY + _SLIDING
    ]
    return F.struct(at.alias("timestamp"), *filled)


def _changes(df: DataFrame, *changes: Column) -> DataFrame:
    """One row per non-NULL change of each row."""
    unfolded = df.select("user_id", F.inline(F.array(*changes)))
    return unfolded.where(F.col("timestamp").isNotNull())


def _after(second: Column, seconds: int) -> Column:
    """The first whole second whose look-back frame no longer holds ``second``."""
    return F.timestamp_seconds(second + seconds + 1)


def _summed_up(transactions: DataFrame) -> DataFrame:
    """Rows and amounts of each user, instant, device and location."""
    return transactions.groupBy("user_id", "timestamp", "device_id", "location").agg(
        F.count("transaction_id").alias("_n"),
        F.count("amount").alias("_m"),
        F.sum("amount").alias("_s"),
    )


def _counted(events: DataFrame, config: FeatureConfig) -> DataFrame:
    """Rows and amounts join at their instant and leave the frames later."""
    n, second = F.col("_n"), epoch_second()
    return _changes(
        events,
        _change(
            F.col("timestamp"),
            _rows=n, _amounts=F.col("_m"), _amount_sum=F.col("_s"), _velocity=n, _burst=n,
        ),
        _change(_after(second, config.velocity_seconds), _velocity=-n),
        _change(_after(second, config.burst_seconds), _burst=-n),
    )


def _first_today(events: DataFrame, kinds: Collection[str]) -> DataFrame:
    """Each value of the columns ``kinds`` counts from when it is first seen."""
    tagged = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in kinds]
    firsts = (
        events.select("user_id", "timestamp", F.inline(F.array(*tagged)))
        .where(F.col("value").isNotNull())
        .groupBy("user_id", F.to_date("timestamp"), "kind", "value")
        .agg(F.min("timestamp").alias("timestamp"))
    )
    return _changes(
        firsts,
        _change(
            F.col("timestamp"),
            _devices=F.when(F.col("kind") == "device_id", 1),
            _locations=F.when(F.col("kind") == "location", 1),
        ),
    )


def _stays(events: DataFrame, seconds: int) -> DataFrame:
    """+1 when a stay at a location begins, -1 when it has left the frame.

    A stay is unbroken while the location is seen again within ``seconds``.
    """
    hours = (
        events.where(F.col("location").isNotNull() & F.col("timestamp").isNotNull())
        .select("user_id", "location", epoch_second().alias("_second"))
        .groupBy("user_id", "location", F.floor(F.col("_second") / _STAY_BLOCK_SECONDS).alias("_hour"))
        .agg(F.array_sort(F.collect_set("_second")).alias("_seconds"))
    )
    by_hour = W.partitionBy("user_id", "location").orderBy("_hour")
    edges = hours.withColumns(
        {
            "_before": F.lag(F.element_at("_seconds", -1)).over(by_hour),
            "_next": F.lead(F.element_at("_seconds", 1)).over(by_hour),
        }
    )

    def begins(second: Column, i: Column) -> Column:
        before = F.when(i == 0, F.col("_before")).otherwise(F.get("_seconds", i - 1))
        return F.coalesce(second - before > seconds, F.lit(True))

    def ends(second: Column, i: Column) -> Column:
        following = F.coalesce(F.get("_seconds", i + 1), F.col("_next"))
        return F.coalesce(following - second > seconds, F.lit(True))

    come = F.transform(F.filter("_seconds", begins), lambda s: _change(F.timestamp_seconds(s), _places=F.lit(1)))
    gone = F.transform(F.filter("_seconds", ends), lambda s: _change(_after(s, seconds), _places=F.lit(-1)))
    return edges.select("user_id", F.inline(F.concat(come, gone)))


def _instant_values(
    events: DataFrame, wanted: Collection[str], config: FeatureConfig
) -> DataFrame:
    """One row per user and instant with the wanted columns."""
    changes = _counted(events, config)
    kinds = [column for feature, column in _FIRST_SEEN.items() if feature in wanted]
    if kinds:
        changes = changes.unionByName(_first_today(events, kinds))
    if "loc_count_1hr" in wanted:
        changes = changes.unionByName(_stays(events, config.location_seconds))

    totals = [F.sum(c).alias(c) for c in _PER_DAY + _SLIDING]
    block = ["user_id", "_day", "_block"]
    # Dealt out by minute once; sums per instant, running sums and sums per
    # block all find their rows together.
    instants = (
        changes.withColumns(
            {
                "_second": epoch_second(),
                "_day": F.to_date("timestamp"),
                "_block": F.floor(epoch_second() / _BLOCK_SECONDS),
            }
        )
        .repartition(*block)
        .groupBy(*block, "timestamp", "_second")
        .agg(*totals)
    )

    # Both windows are content with one sort, by second and instant.
    in_block = W.partitionBy(*block)
    running = instants.withColumns(
        {c: F.sum(c).over(in_block.orderBy("_second", "timestamp")) for c in _PER_DAY}
    ).withColumns({c: F.sum(c).over(in_block.orderBy("_second")) for c in _SLIDING})

    earlier = (W.unboundedPreceding, -1)
    same_day = W.partitionBy("user_id", "_day").orderBy("_block").rowsBetween(*earlier)
    all_days = W.partitionBy("user_id").orderBy("_day", "_block").rowsBetween(*earlier)
    carried = (
        instants.groupBy(*block)
        .agg(*totals)
        .repartition("user_id")
        .select(
            *block,
            *[F.sum(c).over(same_day).alias(f"{c}_before") for c in _PER_DAY],
            *[F.sum(c).over(all_days).alias(f"{c}_before") for c in _SLIDING],
        )
    )

    # Every block has its row in ``carried``.  An outer join infers no filters
    # on ``running``, so both sides keep one and the same shuffle below them.
    joined = running.join(carried, block, "left")

    def total(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"{name}_before"), F.lit(0))

    amounts = total("_amounts")
    columns = {
        "transaction_velocity": total("_velocity"),
        "average_transaction_amount": F.when(amounts > 0, total("_amount_sum") / amounts),
        "device_switch_frequency": total("_devices").cast("int"),
        "location_change_rate": total("_locations").cast("int"),
        "daily_transaction_count": total("_rows"),
        "txn_count_10min": total("_burst"),
        "loc_count_1hr": total("_places").cast("int"),
    }
    return joined.select(
        "user_id", "timestamp", *[c.alias(n) for n, c in columns.items() if n in wanted]
    )


def first_seen_lookup(transactions: DataFrame) -> DataFrame:
    """When each user was first seen on each device."""
    return transactions.groupBy("user_id", "device_id").agg(
        F.min("timestamp").alias("first_seen_device_ts")
    )


def join_first_seen(rows: DataFrame, transactions: DataFrame) -> DataFrame:
    """``rows`` with the first time of each user and device in ``transactions``."""
    return join_lookup(rows, first_seen_lookup(transactions), ["user_id", "device_id"])


def hot_user_columns(
    transactions: DataFrame,
    wanted: Collection[str] = tuple(BEHAVIOUR_COLUMNS),
    config: FeatureConfig = FeatureConfig(),
) -> DataFrame:
    """Same result as ``user_window_columns`` with no group bound to a user.

    The rows are read twice: to sum them up, which is stored, and to put the
    per-instant values back on them.  For that the rows are spread by instant
    and by device, and adaptive execution splits whatever is still skewed, since
    the other side has one row per key.
    """
    wanted = [c for c in BEHAVIOUR_COLUMNS if c in wanted]
    events, _ = stage(_summed_up(transactions), "instants")
    result = transactions
    if set(wanted) - {"first_seen_device_ts"}:
        values = _instant_values(events, wanted, config)
        result = join_lookup(result, values, ["user_id", "timestamp"])
    if "first_seen_device_ts" in wanted:
        result = join_first_seen(result, events)
    return result.select(*transactions.columns, *wanted)
