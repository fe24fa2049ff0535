"""Ranked search against a plain version."""

import math
import random
import re
from collections import Counter

import pytest

from paywarden.llm import ranked_search as search
from paywarden.llm.ranked_search import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top=10):
    counted = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_all = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for d, c in counted:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own & c.keys()
            )
            if score > 0:
                scored.append((-score, d is None, d or 0))
        scored.sort()
        out += [(item, k + 1, None if no else d, -s) for k, (s, no, d) in enumerate(scored[:top])]
    return out


def found(df):
    return [tuple(r) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize("small", [False, True])
def test_equals_the_plain_version(spark, monkeypatch, small):
    if small:  # many shards and blocks
        monkeypatch.setattr(search, "SHARD_POSTINGS", 300)
        monkeypatch.setattr(search, "SHARD_DOCS", 40)
        monkeypatch.setattr(search, "BLOCK_ITEMS", 4)
    draw = random.Random(2)
    vocabulary = [f"W{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    text = lambda n: " ".join(draw.choices(vocabulary, weights, k=n))
    docs = [(i, text(draw.randint(0, 40))) for i in range(400)]
    docs += [(1000 + i, docs[i][1]) for i in range(60)] + [(2000 + i, "w0 w1 w2") for i in range(80)]
    items = [(i, text(draw.randint(1, 25))) for i in range(15)] + [(90, "w0 w1"), (91, "nothing here"), (92, "w59 w58")]
    got = ranked_search(
        spark.createDataFrame(docs, "doc_id int, text string").repartition(5), spark.createDataFrame(items, "item_id int, text string")
    )
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "int", "int", "bigint"]
    assert order(found(got)) == order(plain_search(docs, items))


def test_dropping_on_the_way_loses_nothing(spark):
    docs = [(i, f"common c{i % 7} " + ("rare jewel" if i % 50 == 0 else "filler")) for i in range(3000)]
    items = [(1, "rare jewel common c3"), (2, "common")]
    got = ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert order(found(got)) == order(plain_search(docs, items))


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(None, "Fox today"), (None, "dog"), (1, None), (2, ""), (3, "--- !!"), (4, "WORD"), (5, "漢字 s äö ÄÖ"), (4, "word again")]
    frame = spark.createDataFrame([(*i, 1, "y") for i in items], "item_id int, text string, score long, terms string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = found(ranked_search(odd_docs, frame))
    assert order(got) == order(plain_search(docs, items))
    # Repeated rows rank one by one, a null id last among equals.
    assert [(r[1], r[2]) for r in order(got) if r[0] is None] == [(1, 4), (2, 5), (3, 5), (4, 6), (5, None)]
    assert found(ranked_search(no_docs, frame)) == []
    assert found(ranked_search(odd_docs, frame.where("false"))) == []
    text_items = frame.selectExpr("cast(item_id as string) as q", "text as item")
    named = ranked_search(odd_docs, text_items, top=2, item_col="q", item_text_col="item")
    assert named.columns == ["q", "rank", "doc_id", "score"]
    assert {r[0] for r in found(named)} == {None, "4", "5"}
