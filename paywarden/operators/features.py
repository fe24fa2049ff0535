"""Per-user behavioural features and the context the alert rules need.

Definitions (all per ``user_id``):

========================== ====================================================
transaction_velocity       transactions in the last 3600 s, both ends included
average_transaction_amount mean amount since midnight, up to this instant
device_switch_frequency    distinct devices since midnight, up to this instant
location_change_rate       distinct locations since midnight, up to this instant
daily_transaction_count    transactions since midnight, up to this instant
txn_count_10min            transactions in the last 600 s, both ends included
loc_count_1hr              distinct locations in the last 3600 s
first_seen_device_ts       first time this user was seen on this device
========================== ====================================================

Look-back frames work on whole seconds and include every row of the current
second.  "Since midnight" is a running value: it covers rows up to and
including the current timestamp, ties sharing one value, in the day of the
session time zone.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, functions as F

from paywarden.functions.times import with_timestamp
from paywarden.operators.hot_users import find_hot_users, hot_user_columns, join_first_seen, split_hot
from paywarden.operators.user_windows import BEHAVIOUR_COLUMNS, user_window_columns
from paywarden.schema import CONTEXT_COLUMNS, FEATURE_COLUMNS, FeatureConfig, SkewConfig
from paywarden.sources.tables import stage


def behaviour(
    transactions: DataFrame,
    wanted: Collection[str] = tuple(BEHAVIOUR_COLUMNS),
    config: FeatureConfig = FeatureConfig(),
    skew: SkewConfig = SkewConfig(),
    hot_users: DataFrame | None = None,
) -> DataFrame:
    """``transactions`` plus the wanted columns.

    Users over ``skew.hot_rows`` rows go through ``hot_user_columns``, all
    others through ``user_window_columns``; both give the same values.
    ``hot_users`` is the table of the former (column user_id) when it is known;
    by default one small job over the id column stores them, so
    ``transactions`` should be a stored table.
    """
    transactions = with_timestamp(transactions)
    if hot_users is None:
        hot_users, found = stage(find_hot_users(transactions, skew), "hot-users", {"n": F.count(F.lit(1))})
        if not found["n"]:
            return user_window_columns(transactions, wanted, config)
    hot, others = split_hot(transactions, hot_users)
    plain = user_window_columns(others, wanted, config)
    return plain.unionByName(hot_user_columns(hot, wanted, config))


def fraud_features(transactions: DataFrame, **options) -> DataFrame:
    """``transactions`` plus the five features."""
    return behaviour(transactions, FEATURE_COLUMNS, **options)


def with_rule_context(transactions: DataFrame, **options) -> DataFrame:
    """Add the rules' context, or nothing if the columns are there already."""
    if set(CONTEXT_COLUMNS) <= set(transactions.columns):
        return transactions
    return behaviour(transactions, CONTEXT_COLUMNS, **options)


def first_seen_by_join(transactions: DataFrame) -> DataFrame:
    """Attach the first-seen time by a left join on user and device.

    Rows with a NULL key get NULL.  A device with a third of all rows is split
    at run time.
    """
    return join_first_seen(transactions, transactions)
