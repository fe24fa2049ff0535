"""The registered queries against their SQL, and the pipeline against a plain version."""

import pytest

import corpus_pipeline
from compare import TESTDATA, connect, differences
from paywarden.llm import decontamination as leaks
from paywarden.llm.oracle import llm_oracle_sql
from paywarden.llm.queries import llm_queries
from test_dedup import linked

SF = "sf0.001"


@pytest.mark.parametrize("name", sorted(llm_oracle_sql()))
def test_query_matches_sql(spark, name):
    con = connect(SF)
    assert differences(llm_queries()[name](spark, str(TESTDATA / SF)), con, llm_oracle_sql()[name]) == ""


def test_one_query_for_each_operator():
    assert {int(n[2:].split("_")[0]) for n in llm_queries()} == set(range(1, 14))


def test_pipeline_keeps_what_a_plain_version_keeps(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(str(TESTDATA / SF / "documents.parquet")).collect()]
    docs = [(d, t) for d, t in docs if t and any(ch.isalpha() for ch in t)]
    last = {t: max(d for d, x in docs if x == t) for _, t in docs}
    docs = [(d, t) for d, t in docs if last[t] == d]
    stay = {d for d, _, c in linked(docs, 5, 80) if d == c}
    docs = [(d, t) for d, t in docs if d in stay]
    items = [leaks.plain(r.text) for r in spark.read.parquet(str(TESTDATA / SF / "benchmark.parquet")).collect()]
    index = leaks.Items([(i, t) for i, t in enumerate(items) if len(t) >= leaks.LEAST_CHARS])
    want = sorted(d for d, t in docs if not index.found(leaks.plain(t)))
    got = corpus_pipeline.run(spark, str(TESTDATA / SF))
    assert sorted(r.doc_id for r in got.collect()) == want
    assert got.where("not round_trip").count() == 0


def test_rows_without_or_with_equal_ids_are_decided_each(spark, tmp_path):
    words = [f"w{i}" for i in range(60)]
    near, nearer, other = " ".join(words), " ".join([*words, "x"]), " ".join(w + "b" for w in words)
    item = "the quick brown fox jumps over the lazy dog"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, near), (None, nearer), (None, other), (None, f"so {item}"), (7, "clean text"), (7, f"{item} too"), (8, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, name int")
    near_kept = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert near_kept.columns == docs.columns
    got = sorted(r.name for r in near_kept.collect())
    assert got in ([0, 2, 3, 4, 5, 6], [1, 2, 3, 4, 5, 6])
    clean = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert sorted(r.name for r in clean.collect()) == [0, 1, 2, 4, 6]
    # An id wins over none.
    named = docs.where("name < 2").selectExpr("if(name = 1, 9, doc_id) as doc_id", "text", "name")
    assert [r.doc_id for r in corpus_pipeline.near_dedup(spark, named, str(tmp_path)).collect()] == [9]


@pytest.mark.parametrize("lang", ["lang", "string(null)", "'und'"])
def test_the_language_stage_needs_no_labels(spark, odd_docs, lang):
    docs = odd_docs.selectExpr("doc_id", "text", f"{lang} as lang", "id")
    assert sorted(r.id or 0 for r in corpus_pipeline.language_id(spark, docs, "").collect()) == [0, 4, 5, 5, 7, 8, 9]


def test_the_language_stage_takes_columns_of_any_name(spark, odd_docs, no_docs):
    named = odd_docs.selectExpr("doc_id", "text", "lang", "id as lang_pred", "'s' as score", "1 as c0")
    kept = corpus_pipeline.language_id(spark, named, "")
    assert kept.columns == named.columns
    assert sorted(r.lang_pred or 0 for r in kept.collect()) == [0, 4, 5, 5, 7, 8, 9]
    assert corpus_pipeline.language_id(spark, no_docs, "").collect() == []
