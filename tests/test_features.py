"""Frames, ties and distinct counts on both paths, and against brute force."""

import datetime as dt
import random

import pytest

from frames import NOON, after, column, silver
from paywarden.operators.features import behaviour, first_seen_by_join, fraud_features
from paywarden.operators.hot_users import find_hot_users, hot_user_columns
from paywarden.operators.user_windows import BEHAVIOUR_COLUMNS, user_window_columns
from paywarden.schema import FEATURE_COLUMNS, FEATURE_TYPES, CONTEXT_TYPES, SkewConfig, SILVER_SCHEMA

PATHS = [user_window_columns, hot_user_columns]


@pytest.fixture(params=PATHS, ids=["plain", "split"])
def path(request):
    return request.param


def test_frame_includes_both_ends(spark, path):
    rows = silver(spark, [{"timestamp": after(s)} for s in (0, 3600, 3601)])
    assert column(path(rows), "transaction_velocity") == [1, 2, 2]


def test_rows_of_one_second_are_peers(spark, path):
    rows = silver(spark, [{"timestamp": after(0.2)}, {"timestamp": after(0.9)}])
    result = path(rows)
    assert column(result, "transaction_velocity") == [2, 2]
    # Running values go by the exact timestamp ...
    assert column(result, "daily_transaction_count") == [1, 2]


def test_equal_timestamps_share_running_values(spark, path):
    rows = silver(spark, [{"amount": 10.0}, {"amount": 30.0}, {"timestamp": after(1), "amount": 80.0}])
    result = path(rows)
    assert column(result, "daily_transaction_count") == [2, 2, 3]
    assert column(result, "average_transaction_amount") == [20.0, 20.0, 40.0]


def test_midnight_resets_the_day_but_not_the_hour(spark, path):
    late = dt.datetime(2024, 3, 1, 23, 59, 59)
    rows = silver(
        spark,
        [{"timestamp": late, "device_id": "a"}, {"timestamp": late + dt.timedelta(seconds=1), "device_id": "b"}],
    )
    result = path(rows)
    assert column(result, "transaction_velocity") == [1, 2]
    assert column(result, "daily_transaction_count") == [1, 1]
    assert column(result, "device_switch_frequency") == [1, 1]


def test_returning_to_a_device_is_not_counted_again(spark, path):
    rows = silver(spark, [{"device_id": d, "timestamp": after(i)} for i, d in enumerate("aba")])
    result = path(rows)
    assert column(result, "device_switch_frequency") == [1, 2, 2]
    assert column(result, "first_seen_device_ts") == [NOON, after(1), NOON]


def test_burst_count(spark, path):
    rows = silver(
        spark, [{"transaction_id": f"t{i:02d}", "timestamp": after(60 * i)} for i in range(12)]
    )
    assert column(path(rows), "txn_count_10min") == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 11]


def test_locations_of_the_last_hour(spark, path):
    rows = silver(
        spark,
        [
            {"location": "x", "timestamp": after(0)},
            {"location": "y", "timestamp": after(1800)},
            {"location": "y", "timestamp": after(5400)},
            {"location": "y", "timestamp": after(5401)},
            {"location": "x", "timestamp": after(7200)},
        ],
    )
    assert column(path(rows), "loc_count_1hr") == [1, 2, 1, 1, 2]


def test_missing_values_are_not_counted(spark, path):
    rows = silver(
        spark,
        [
            {"location": None, "device_id": None, "amount": None},
            {"timestamp": after(1), "location": "x", "amount": 4.0},
        ],
    )
    result = path(rows)
    assert column(result, "location_change_rate") == [0, 1]
    assert column(result, "loc_count_1hr") == [0, 1]
    assert column(result, "device_switch_frequency") == [0, 1]
    assert column(result, "average_transaction_amount") == [None, 4.0]


def test_types_and_columns(spark, path):
    result = path(silver(spark, [{}]))
    assert result.columns == SILVER_SCHEMA.fieldNames() + BEHAVIOUR_COLUMNS
    for name, kind in (FEATURE_TYPES | CONTEXT_TYPES).items():
        assert result.schema[name].dataType == kind, name


def test_empty_input(spark, path):
    assert path(silver(spark, [])).count() == 0


def brute_force(rows):
    """Quadratic evaluation of the definitions."""
    values = {}
    for r in rows:
        mine = [o for o in rows if o["user_id"] == r["user_id"]]
        second = int(r["timestamp"].timestamp())

        def last(seconds):
            return [o for o in mine if second - seconds <= int(o["timestamp"].timestamp()) <= second]

        today = [
            o for o in mine
            if o["timestamp"].date() == r["timestamp"].date() and o["timestamp"] <= r["timestamp"]
        ]
        values[r["transaction_id"]] = (
            len(last(3600)),
            # A mean of doubles depends on the order of their sum in its last digits.
            pytest.approx(sum(o["amount"] for o in today) / len(today), rel=1e-12),
            len({o["device_id"] for o in today if o["device_id"]}),
            len({o["location"] for o in today if o["location"]}),
            len(today),
            len(last(600)),
            len({o["location"] for o in last(3600) if o["location"]}),
            min(o["timestamp"] for o in mine if o["device_id"] == r["device_id"]),
        )
    return values


@pytest.mark.parametrize("seed", [1, 2])
def test_both_paths_match_brute_force(spark, seed):
    rng = random.Random(seed)
    start = dt.datetime(2024, 2, 28, 21, 0, 0, tzinfo=dt.timezone.utc)
    rows = []
    for i in range(300):
        # Whole, half and odd gaps around the frame lengths, over four days.
        base = rng.choice([0, 599, 600, 601, 3599, 3600, 3601, 86400, rng.randrange(4 * 86400)])
        shift = rng.choice([0, 0, 0.25, 0.5]) + rng.randrange(3)
        rows.append(
            {
                "transaction_id": f"t{i}",
                "user_id": rng.choice("aab"),
                "amount": round(rng.uniform(1, 500), 2),
                "location": rng.choice(["x", "y", "z", None]),
                "device_id": rng.choice(["d1", "d2", "d3"]),
                "timestamp": start + dt.timedelta(seconds=base + shift),
            }
        )
    expected = brute_force(rows)
    table = silver(spark, rows)
    for compute in (
        lambda t: user_window_columns(t),
        lambda t: hot_user_columns(t),
        lambda t: behaviour(t, skew=SkewConfig(hot_rows=150)),
        lambda t: behaviour(t, skew=SkewConfig(hot_rows=10)),
    ):
        got = {
            r["transaction_id"]: (
                r["transaction_velocity"], r["average_transaction_amount"],
                r["device_switch_frequency"], r["location_change_rate"],
                r["daily_transaction_count"], r["txn_count_10min"], r["loc_count_1hr"],
                r["first_seen_device_ts"].replace(tzinfo=dt.timezone.utc),
            )
            for r in compute(table).collect()
        }
        assert got == expected


def test_both_paths_agree_where_days_change_length(spark):
    """Clocks went forward on 10 March 2024 in New York."""
    rows = silver(
        spark,
        [
            {"transaction_id": f"t{i:03d}", "device_id": f"d{i % 7}", "location": "xyz"[i % 3],
             "timestamp": dt.datetime(2024, 3, 9, 22, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=17 * i)}
            for i in range(200)
        ],
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        plain, split = (compute(rows).drop("average_transaction_amount") for compute in PATHS)
        assert plain.exceptAll(split).count() == 0 and split.count() == 200
        days = plain.where("daily_transaction_count = 1").select("transaction_id").collect()
        assert len(days) == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hot_users_are_found_by_size(spark):
    rows = silver(spark, [{"user_id": u} for u in "aaaabbbcc"])
    found = find_hot_users(rows, SkewConfig(hot_rows=2)).collect()
    assert sorted(r.user_id for r in found) == ["a", "b"]
    assert find_hot_users(rows, SkewConfig(hot_rows=4)).isEmpty()
    assert find_hot_users(rows, SkewConfig(hot_rows=0)).count() == 3


def test_the_size_of_users_changes_no_value(spark):
    rng = random.Random(11)
    start = dt.datetime(2024, 5, 1, 22, tzinfo=dt.timezone.utc)
    rows = silver(
        spark,
        [
            {
                "transaction_id": f"t{i}",
                "user_id": rng.choice(["a", "a", "b", None]),
                "amount": rng.choice([float(rng.randrange(500)), None]),
                "location": rng.choice(["x", "y", None]),
                "device_id": rng.choice(["d1", "d2", None]),
                "timestamp": rng.choice([start + dt.timedelta(seconds=rng.randrange(9000)), None]) if i % 4 == 0
                else start + dt.timedelta(seconds=rng.randrange(9000)),
            }
            for i in range(300)
        ],
    )
    plain, *others = (behaviour(rows, skew=SkewConfig(hot_rows=n)) for n in (5_000_000, 75, 1))
    for other in others:
        assert plain.exceptAll(other).count() == 0 == other.exceptAll(plain).count()
    assert plain.where("device_id is null and first_seen_device_ts is not null").count() == 0


def test_rows_without_user_or_time_are_kept(spark):
    rows = silver(spark, [{"user_id": None}, {"timestamp": None}, {}, {}])
    for skew in (SkewConfig(), SkewConfig(hot_rows=1), SkewConfig(hot_rows=0)):
        assert behaviour(rows, skew=skew).count() == 4


def test_text_timestamps_are_parsed_first(spark):
    rows = silver(spark, [{}, {"timestamp": after(3600)}])
    text = rows.withColumn("timestamp", rows.timestamp.cast("string"))
    assert column(fraud_features(text), "transaction_velocity") == [1, 2]
    assert fraud_features(text).columns == SILVER_SCHEMA.fieldNames() + FEATURE_COLUMNS


def test_first_seen_join_leaves_null_keys_null(spark):
    rows = silver(spark, [{"device_id": None}, {"timestamp": after(5)}, {"timestamp": after(9)}])
    assert column(first_seen_by_join(rows), "first_seen_device_ts") == [None, after(5), after(5)]
