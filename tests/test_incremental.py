import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from frames import NOON, after, silver
from paywarden.operators.features import behaviour
from paywarden.operators.first_seen import merged_first_seen, with_first_seen
from paywarden.plans import incremental, medallion, steps
from paywarden.sources import dated, releases
from paywarden.sources.tables import read_parquet, write_csv

DAY1, DAY2, DAY3 = (dt.date(2024, 3, d) for d in (1, 2, 3))


def at(day, hour, minute=0):
    return dt.datetime.combine(day, dt.time(hour, minute))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def failing(df):
    """``df`` with a row that stops the job that reads it."""
    return df.withColumn("amount", F.when(F.col("transaction_id") == "t1", F.raise_error(F.lit("dies"))).otherwise(F.col("amount")))


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert releases.read_published(spark, path) is None
    old = silver(spark, [{}, {"amount": 5.0}])
    releases.publish(old, path)
    with pytest.raises(Exception, match="dies"):
        releases.publish(failing(silver(spark, [{}] * 9)), path)
    assert same(releases.read_published(spark, path), old)
    # What was written in part is named by nobody.
    assert [r.version for r in releases.releases(spark, path).collect()] == [1]


def test_a_table_can_be_replaced_by_what_is_made_of_it(spark, tmp_path):
    path = str(tmp_path / "t")
    releases.publish(silver(spark, [{}]), path)
    for n in (2, 3, 4):
        table = releases.read_published(spark, path)
        seen = releases.publish(table.union(silver(spark, [{"amount": float(n)}])), path, observed={"n": F.count(F.lit(1))})
        assert seen == {"n": n}
    assert releases.read_published(spark, path).count() == 4
    assert releases.read_published(spark, path, version=2).count() == 2
    assert releases.retire(spark, path, keep=2) == 2
    assert releases.read_published(spark, path).count() == 4
    assert [releases.read_published(spark, path, version=v).count() for v in (1, 2, 3)] == [0, 0, 3]
    with pytest.raises(ValueError):
        releases.retire(spark, path, keep=0)


def test_a_run_that_fails_changes_no_table_that_is_read(spark, tmp_path, monkeypatch):
    out, first = str(tmp_path / "out"), silver(spark, [{"user_id": f"u{i % 3}", "amount": 100.0 + i} for i in range(9)])
    (tmp_path / "up").mkdir()
    as_text = first.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    write_csv(as_text, str(tmp_path / "up"))
    done = medallion.run_medallion(spark, str(tmp_path / "up"), out, atomic=True)
    folder = medallion.current_run(spark, out)
    before = sorted(map(str, read_parquet(spark, f"{folder}/gold/scored_gold.parquet").collect()))
    assert done.gold.rows == len(before) == 9
    monkeypatch.setattr(steps, "detect_fraud_rules", lambda scored, rules: failing(scored))
    with pytest.raises(Exception, match="dies"):
        medallion.run_medallion(spark, str(tmp_path / "up"), out, atomic=True)
    assert medallion.current_run(spark, out) == folder
    assert sorted(map(str, read_parquet(spark, f"{folder}/gold/scored_gold.parquet").collect())) == before
    kpis, alerts, features = steps.load_kpis(spark, f"{folder}/gold", f"{out}/gold/pipeline_metadata.parquet")
    assert features.count() == 9 and kpis.count() == 1
    statuses = [r.pipeline_status for r in read_parquet(spark, f"{out}/gold/pipeline_metadata.parquet").collect()]
    assert sorted(statuses) == ["FAILED", "SUCCESS"]


def files_of(path, day):
    return sorted(os.listdir(f"{path}/txn_date={day}"))


def test_a_day_is_replaced_alone_and_read_alone(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = silver(spark, [{"timestamp": at(d, h)} for d in (DAY1, DAY2, DAY3) for h in (1, 2)])
    assert dated.write_days(rows, path) == [DAY1, DAY2, DAY3]
    kept = files_of(path, DAY1), files_of(path, DAY3)
    fresh = silver(spark, [{"transaction_id": "new", "timestamp": at(DAY2, 5)}, {"transaction_id": "other day", "timestamp": at(DAY1, 5)}])
    assert dated.write_days(fresh, path, days=[DAY2]) == [DAY2]
    assert (files_of(path, DAY1), files_of(path, DAY3)) == kept
    assert [r.transaction_id for r in dated.read_days(spark, path, DAY2, DAY2).collect()] == ["new"]
    assert dated.read_days(spark, path).count() == 5
    # A day that has no rows any more.
    assert dated.write_days(fresh, path, days=[DAY3]) == []
    assert dated.read_days(spark, path, DAY3).count() == 0 and dated.read_days(spark, path).count() == 3
    plan = dated.read_days(spark, path, DAY2, DAY2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_date" in plan
    assert len(dated.read_days(spark, path, DAY2, DAY2).where("amount > 0").inputFiles()) >= 1


def test_rows_without_a_time_are_of_no_day(spark, tmp_path):
    path = str(tmp_path / "days")
    dated.write_days(silver(spark, [{}, {"timestamp": None}]), path)
    assert dated.read_days(spark, path).count() == 2
    assert dated.read_days(spark, path, DAY1, DAY3).count() == 1
    assert dated.write_days(silver(spark, []), path) == [] and dated.read_days(spark, path).count() == 2


def test_state_of_batches_in_any_order_equals_one_pass(spark, tmp_path):
    rows = [
        {"user_id": u, "device_id": d, "timestamp": after(s)}
        for s, u, d in [(5, "a", "x"), (1, "a", "x"), (9, "a", "y"), (3, "b", "x"), (2, None, "x"), (4, "b", None), (0, "a", "y")]
    ]
    whole = merged_first_seen(silver(spark, rows))
    for order in ([rows[:3], rows[3:]], [rows[3:], rows[:3]], [rows[:3], rows[3:], rows[:3]]):
        path = str(tmp_path / f"state{len(os.listdir(tmp_path))}")
        for part in order:
            known = incremental.advance_first_seen(silver(spark, part), path)
        assert same(known, whole)
    assert {(r.user_id, r.device_id): r.first_seen_device_ts for r in whole.collect()} == {
        ("a", "x"): after(1), ("a", "y"): NOON, ("b", "x"): after(3)
    }
    seen = with_first_seen(silver(spark, rows), whole).collect()
    assert len(seen) == 7 and {r.first_seen_device_ts for r in seen if r.user_id is None or r.device_id is None} == {None}


def test_a_batch_that_dies_leaves_the_state(spark, tmp_path):
    path = str(tmp_path / "state")
    first = silver(spark, [{"timestamp": after(5)}])
    incremental.advance_first_seen(first, path)
    bad = silver(spark, [{"timestamp": after(1)}] * 3).withColumn(
        "timestamp", F.when(F.col("transaction_id") == "t1", F.raise_error(F.lit("dies")).cast("timestamp")).otherwise(F.col("timestamp"))
    )
    with pytest.raises(Exception, match="dies"):
        incremental.advance_first_seen(bad, path)
    assert incremental.known_first_seen(spark, path).first().first_seen_device_ts == after(5)


def test_days_computed_apart_equal_a_whole_run(spark, tmp_path):
    times = [at(d, h, m) for d in (DAY1, DAY2, DAY3) for h in (0, 12, 23) for m in (0, 5, 30, 59)]
    rows = silver(
        spark,
        [
            {"user_id": "uv"[i % 2], "device_id": "xyz"[i % 3], "location": "abcd"[i % 4], "timestamp": t, "amount": 1.0 + i}
            for i, t in enumerate(times)
        ],
    )
    whole = behaviour(rows)
    known = incremental.advance_first_seen(rows, str(tmp_path / "state"))
    for days in ([DAY2], [DAY1, DAY3], [DAY1, DAY2, DAY3], []):
        got = incremental.feature_days(rows, days, known).select(*whole.columns)
        assert same(got, whole.where(F.to_date("timestamp").isin(days) if days else F.lit(False)))
    path = str(tmp_path / "features")
    dated.write_days(whole.withColumn("amount", F.lit(0.0)), path)
    assert incremental.refresh_feature_days(rows, path, [DAY2], known) == [DAY2]
    table = dated.read_days(spark, path).drop(dated.DAY)
    assert same(table.where("amount > 0"), whole.where(F.to_date("timestamp") == F.lit(DAY2)))
    assert table.count() == len(times)
