import json
import os

import pytest

from frames import bronze
from paywarden.operators.quality import quarantine_reasons, routed, stage_counts
from paywarden.schema import BRONZE_SCHEMA, RUN_LOG_SCHEMA
from paywarden.sources import run_log, tables, uploads

HEADER = "transaction_id,user_id,merchant_id,amount,location,device_id,payment_method,timestamp,transaction_status"
LINE = "t1,u,m,12.5,here,d,upi,2024-03-01 12:00:00,success"


def put(path, *lines, mtime=None):
    path.write_text("\n".join(lines) + "\n")
    if mtime:
        os.utime(path, (mtime, mtime))
    return str(path)


def test_csv_is_read_by_name(spark, tmp_path):
    path = put(
        tmp_path / "a.csv",
        "amount,transaction_id,note,user_id,merchant_id,location,device_id,payment_method,timestamp,transaction_status",
        '3.5,001,"said ""hi"", left",u,m,here,d,upi,2024-03-01 12:00:00,success',
        "lots,002,,NA,m,,d,upi,2024-03-01 12:00:00,success",
    )
    first, second = uploads.read_csv(spark, path).orderBy("transaction_id").collect()
    assert (first.transaction_id, first.amount, first.note) == ("001", 3.5, 'said "hi", left')
    assert (second.amount, second.user_id, second.location) == (None, None, None)


def test_newest_upload_wins(spark, tmp_path):
    put(tmp_path / "new.csv", HEADER, LINE.replace("t1", "new"), mtime=2_000_000)
    put(tmp_path / "old.csv", HEADER, LINE.replace("t1", "old"), mtime=1_000_000)
    put(tmp_path / "later.txt", "x", mtime=3_000_000)
    rows, source = uploads.ingest(spark, str(tmp_path))
    assert [r.transaction_id for r in rows.collect()] == ["new"] and source == "uploaded"


def test_equal_times_go_to_the_greater_name(spark, tmp_path):
    for name in ("a", "c", "b"):
        put(tmp_path / f"{name}.csv", HEADER, LINE, mtime=1_000_000)
    assert uploads.latest_upload(spark, str(tmp_path)).endswith("/c.csv")


def test_folder_names_with_blanks_and_relative_folders(spark, tmp_path):
    folder = tmp_path / "my uploads"
    folder.mkdir()
    put(folder / "a b.csv", HEADER, LINE)
    assert uploads.ingest(spark, str(folder))[0].count() == 1
    relative = os.path.relpath(folder)
    assert uploads.ingest(spark, relative)[0].count() == 1


def test_folder_that_does_not_exist_holds_no_uploads(spark, tmp_path):
    rows, source = uploads.ingest(spark, str(tmp_path / "none"), bronze(spark, [{}]), "uploaded")
    assert rows.count() == 1 and source == "uploaded"


def test_written_csv_is_found_and_read_back(spark, tmp_path):
    rows = bronze(spark, [{"location": 'a "b", c'}, {"transaction_id": "z", "amount": None}])
    path = tables.write_csv(rows.repartition(2), str(tmp_path), "uploaded")
    assert os.path.basename(path).startswith("uploaded_")
    back, _ = uploads.ingest(spark, str(tmp_path))
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_fallback_when_nothing_is_uploaded(spark, tmp_path):
    rows, source = uploads.ingest(spark, str(tmp_path), bronze(spark, [{}]))
    assert rows.count() == 1 and source == "synthetic"
    with pytest.raises(ValueError, match="no CSV"):
        uploads.ingest(spark, str(tmp_path))


def test_json_array_and_lines_give_the_same(spark, tmp_path):
    records = [
        {"transaction_id": 7, "amount": 2, "timestamp": "2024-03-01T12:00:00", "user_id": "u"},
        {"transaction_id": "8", "amount": 2.5, "timestamp": "2024-03-01 12:00:00", "other": 1},
    ]
    array = put(tmp_path / "a.json", json.dumps(records, indent=1))
    lines = put(tmp_path / "b.json", *[json.dumps(r) for r in records])
    got = uploads.read_json(spark, array)
    assert got.schema == BRONZE_SCHEMA
    assert got.exceptAll(uploads.read_json(spark, lines, lines=True)).count() == 0
    assert [(r.transaction_id, r.amount, r.timestamp) for r in got.orderBy("transaction_id").collect()] == [
        ("7", 2.0, "2024-03-01 12:00:00"), ("8", 2.5, "2024-03-01 12:00:00")
    ]


def test_unreadable_numbers_end_in_quarantine(spark, tmp_path):
    path = put(tmp_path / "a.csv", HEADER, LINE, LINE.replace("t1", "t2").replace("12.5", "abc"))
    layers = {r.transaction_id: r.layer for r in routed(uploads.read_csv(spark, path)).collect()}
    assert layers == {"t1": "silver", "t2": "quarantine"}


def test_run_log_keeps_history(spark, tmp_path):
    path = str(tmp_path / "log")
    ids = {run_log.log_pipeline_run(spark, path, n, "SUCCESS", "uploaded") for n in (1, 2)}
    log = run_log.read_run_log(spark, path)
    assert log.schema.fieldNames() == RUN_LOG_SCHEMA.fieldNames()
    assert {r.pipeline_run_id for r in log.collect()} == ids and len(ids) == 2


def test_observed_aggregates_come_from_the_write(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "t")
    rows = bronze(spark, [{"amount": 1.0}, {"amount": 4.0}])
    seen = tables.write_parquet(rows, path, observed={"n": F.count(F.lit(1)), "top": F.max("amount")})
    assert seen == {"n": 2, "top": 4.0} and tables.read_parquet(spark, path).count() == 2


def test_staged_table_lies_in_the_shared_folder(spark):
    staged, _ = tables.stage(bronze(spark, [{}]), "x")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in f for f in staged.inputFiles()) and staged.count() == 1


def test_record_with_too_many_fields_is_not_cut(spark, tmp_path):
    path = put(tmp_path / "a.csv", HEADER, LINE, LINE.replace("t1", "t2") + ",more")
    with pytest.raises(Exception, match="too many fields"):
        uploads.read_csv(spark, path).collect()
    short = put(tmp_path / "b.csv", HEADER + ",note", LINE)
    assert [(r.transaction_id, r.note) for r in uploads.read_csv(spark, short).collect()] == [("t1", None)]


def test_quoted_line_breaks_on_request(spark, tmp_path):
    put(tmp_path / "a.csv", HEADER, LINE.replace("here", '"two\nlines"'), LINE.replace("t1", "t2"))
    rows, _ = uploads.ingest(spark, str(tmp_path), multi_line=True)
    assert sorted((r.transaction_id, r.location) for r in rows.collect()) == [("t1", "two\nlines"), ("t2", "here")]


def test_newest_of_csv_and_json_wins(spark, tmp_path):
    put(tmp_path / "a.csv", HEADER, LINE, mtime=1_000_000)
    put(tmp_path / "b.json", json.dumps([{"transaction_id": "j", "more": 1}, {"transaction_id": "k"}]), mtime=2_000_000)
    rows, source = uploads.ingest(spark, str(tmp_path))
    assert sorted((r.transaction_id, r.more or "") for r in rows.collect()) == [("j", "1"), ("k", "")]
    assert source == "uploaded"
    put(tmp_path / "c.jsonl", '{"transaction_id": "l"}', '{"transaction_id": "m"}', mtime=3_000_000)
    assert uploads.ingest(spark, str(tmp_path))[0].count() == 2


def test_json_written_in_parts_is_read_whole(spark, tmp_path):
    rows = bronze(spark, [{"transaction_id": str(i), "amount": i + 0.5} for i in range(20)])
    rows.repartition(3).write.json(str(tmp_path / "x.json"))
    back, _ = uploads.ingest(spark, str(tmp_path))
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


@pytest.mark.parametrize(
    "given, wanted",
    [
        (1709294400000, "2024-03-01 12:00:00"),
        (1709294400, "2024-03-01 12:00:00"),
        (1709294400999999, "2024-03-01 12:00:00"),
        (1709294400000000000, "2024-03-01 12:00:00"),
        (1709294400999999999, "2024-03-01 12:00:00"),
        ("2024-03-01T12:00:00.000", "2024-03-01 12:00:00"),
        ("2024-03-01T12:00:00.25Z", "2024-03-01 12:00:00"),
        ("2024-03-01T12:00:00+02:00", "2024-03-01T12:00:00+02:00"),
        (12345678, "12345678"),
        ("soon", "soon"),
        (None, None),
    ],
)
def test_json_times(spark, tmp_path, given, wanted):
    path = put(tmp_path / "a.json", json.dumps([{"transaction_id": "t", "timestamp": given}]))
    assert uploads.read_json(spark, path).first().timestamp == wanted


def test_only_the_top_level_is_searched(spark, tmp_path):
    up = tmp_path / "kept.csv"
    (up / "archive").mkdir(parents=True)
    put(up / "a.csv", HEADER, LINE, mtime=1_000_000)
    put(up / "archive" / "b.csv", HEADER, LINE, mtime=2_000_000)
    assert uploads.latest_upload(spark, str(up)).endswith("/kept.csv/a.csv")


def test_malformed_records_keep_their_text(spark, tmp_path):
    bad = [
        LINE.replace("t1", "t2") + ",more",
        LINE.replace("t1", "t3") + ",,lost",
        LINE.replace("t1", "t4").replace("here", '"here'),
        LINE.replace("t1", "t5") + ",,",
    ]
    quoted = LINE.replace("t1", "t6").replace("here", '"a ""b"", c"')
    inches = LINE.replace("t1", "t7").replace("here", '5" and 6" wide')
    short = LINE.replace("t1", "t8").removesuffix(",success")
    path = put(tmp_path / "a.csv", HEADER, LINE, *bad, quoted, inches, short)
    rows = {r.transaction_id: r for r in uploads.read_csv(spark, path, audit=True).collect()}
    assert [rows[f"t{i}"]._corrupt_record for i in (2, 3, 4, 5)] == bad
    assert [rows[f"t{i}"]._corrupt_record for i in (1, 6, 7, 8)] == [None] * 4
    assert (rows["t6"].location, rows["t7"].location) == ('a "b", c', '5" and 6" wide')
    assert rows["t8"].transaction_status is None
    assert {r._source_file.rsplit("/", 1)[1] for r in rows.values()} == {"a.csv"}
    assert all(r._ingested_at for r in rows.values())
    # Whatever columns are asked for.
    assert len(uploads.read_csv(spark, path, audit=True).where("_corrupt_record is not null").select("amount").collect()) == 4
    for line in bad:
        with pytest.raises(Exception, match="too many fields"):
            uploads.read_csv(spark, put(tmp_path / "b.csv", HEADER, line)).collect()


def test_malformed_rows_go_to_quarantine_once_and_win_no_contest(spark, tmp_path):
    lines = [LINE, LINE.replace("success", "zzz") + ",x", LINE.replace("12.5", "-9") + ",x", LINE.replace("12.5", "-9") + ",x"]
    rows = uploads.read_csv(spark, put(tmp_path / "a.csv", HEADER, *lines), audit=True)
    got = routed(rows)
    assert [(r.amount, r.transaction_status) for r in got.where("layer = 'silver'").collect()] == [(12.5, "success")]
    assert got.where("layer = 'quarantine'").count() == 2
    counts = stage_counts(rows).first().asDict()
    assert counts == {"bronze_rows": 4, "unique_rows": 3, "complete_rows": 1, "incomplete_rows": 2, "silver_rows": 1, "quarantine_rows": 2}
    reasons = [r.quarantine_reasons for r in quarantine_reasons(rows).collect()]
    assert sorted(map(list, reasons)) == [["malformed record"], ["malformed record", "amount not positive"]]


def test_json_lines_that_are_no_json_keep_their_text(spark, tmp_path):
    path = put(tmp_path / "a.jsonl", '{"transaction_id": "a", "amount": "2.5"}', '{"transaction_id": "b", "amount": ', "null", '{"transaction_id": 3, "amount": "x"}')
    rows = uploads.read_json(spark, path, lines=True, audit=True).collect()
    assert {(r.transaction_id, r.amount) for r in rows if r._corrupt_record is None} >= {("a", 2.5), ("3", None)}
    assert [r._corrupt_record for r in rows if r._corrupt_record] == ['{"transaction_id": "b", "amount": ', "null"]
    assert all(r._source_file.endswith("/a.jsonl") and r._ingested_at for r in rows)


def test_fallback_rows_come_from_no_file(spark, tmp_path):
    rows, _ = uploads.ingest(spark, str(tmp_path), bronze(spark, [{}]), audit=True)
    row = rows.first()
    assert (row._corrupt_record, row._source_file) == (None, None) and row._ingested_at
