import pytest
from pyspark.sql import functions as F

from frames import bronze
from paywarden.operators import quality as q
from paywarden.schema import SILVER_SCHEMA


@pytest.fixture(scope="module")
def mixed(spark):
    return bronze(
        spark,
        [
            {"transaction_id": "a"},
            {"transaction_id": "b", "amount": -1.0},
            {"transaction_id": "c", "amount": -1.0, "location": None},
            {"transaction_id": "d", "amount": None},
            {"transaction_id": "e", "amount": float("nan")},
            {"transaction_id": "f", "amount": 0.0},
            {"transaction_id": None, "user_id": "x"},
            {"transaction_id": None, "user_id": "y"},
        ],
    )


def ids(df):
    return sorted((r.transaction_id for r in df.collect()), key=str)


def test_silver_and_quarantine(mixed):
    rows = q.routed(mixed)
    assert ids(rows.where("layer = 'silver'")) == ["a"]
    rejected = [None, "b", "c", "c", "d", "e", "f"]
    assert ids(rows.where("layer = 'quarantine'")) == sorted(rejected, key=str)


def test_routing_equals_the_separate_steps(mixed):
    unique = q.normalize_timestamp(q.deduplicate(mixed))
    rows = q.routed(mixed)
    for layer, expected in (("silver", q.silver_rows(unique)), ("quarantine", q.quarantine_rows(unique))):
        got = rows.where(F.col("layer") == layer).drop("layer")
        assert got.exceptAll(expected).count() == 0
        assert expected.exceptAll(got).count() == 0


def test_incomplete_rows_equal_the_set_difference(mixed):
    unique = q.normalize_timestamp(q.deduplicate(mixed))
    literal = unique.subtract(q.complete_rows(unique))
    assert ids(q.incomplete_rows(unique)) == ids(literal)


def test_every_id_ends_up_somewhere(mixed):
    unique = q.deduplicate(mixed)
    assert set(ids(q.routed(mixed))) == set(ids(unique))


def test_reasons(mixed):
    reasons = {r.transaction_id: r.quarantine_reasons for r in q.quarantine_reasons(mixed).collect()}
    assert reasons == {
        "b": ["amount not positive"],
        "c": ["missing location", "amount not positive"],
        "d": ["missing amount"],
        "e": ["missing amount"],
        "f": ["amount not positive"],
        None: ["missing transaction_id"],
    }


def test_stage_counts(mixed):
    assert q.stage_counts(mixed).first().asDict() == {
        "bronze_rows": 8, "unique_rows": 7, "complete_rows": 3, "incomplete_rows": 4,
        "silver_rows": 1, "quarantine_rows": 7,
    }


def test_stage_counts_of_nothing(spark):
    assert set(q.stage_counts(bronze(spark, [])).first()) == {0}


def test_timestamps(spark):
    texts = ["bad", "2024-01-01", "2024-01-01 00:00:00.5", None, "2024-01-01 00:00:00"]
    rows = bronze(spark, [{"transaction_id": str(i), "timestamp": t} for i, t in enumerate(texts)])
    parsed = q.normalize_timestamp(rows)
    assert ids(parsed.where("timestamp is not null")) == ["4"]
    reasons = {r.transaction_id: r.quarantine_reasons for r in q.quarantine_reasons(rows).collect()}
    assert reasons["0"] == ["unreadable timestamp"] and reasons["3"] == ["missing timestamp"]


def test_kept_copy_does_not_depend_on_order(spark):
    rows = [{"amount": 5.0}, {"amount": 7.0}, {"amount": None}]
    kept = [
        q.deduplicate(bronze(spark, order).repartition(3)).collect()
        for order in (rows, rows[::-1], rows[1:] + rows[:1])
    ]
    assert [k[0].amount for k in kept] == [7.0, 7.0, 7.0]


def test_copies_collapse_before_the_shuffle(spark):
    plan = q.deduplicate(bronze(spark, [{}]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(transaction_id") == 1
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit [transaction_id" in before_shuffle and "Partial" in before_shuffle


def test_routing_shuffles_once(mixed):
    plan = q.routed(mixed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_extra_columns_survive(spark):
    rows = bronze(spark, [{}]).withColumn("note", F.lit("kept"))
    assert q.routed(rows).first().note == "kept"


def test_missing_columns_are_an_error(spark):
    rows = bronze(spark, [{}]).drop("transaction_id")
    assert not q.validate_schema(rows)
    with pytest.raises(ValueError, match="transaction_id"):
        q.routed(rows)


def test_schema_problems(spark):
    rows = bronze(spark, [{}]).drop("location").withColumn("note", F.lit(1))
    assert q.schema_problems(rows) == [
        "missing column location",
        "column timestamp is string, expected timestamp",
        "unexpected column note",
    ]
    good = q.normalize_timestamp(bronze(spark, [{}]))
    assert q.schema_problems(good, SILVER_SCHEMA) == []
