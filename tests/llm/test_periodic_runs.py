"""Periodic runs against brute force."""

import hashlib
import random
from zlib import crc32

import numpy as np
from compare import TESTDATA
from hypothesis import given, settings, strategies as st

from paywarden.llm.periodic_runs import find_runs, periodic_runs
from paywarden.llm.queries import op13_periodic_runs


def plain_runs(x, least=12):
    """Every lag and every place; of equal stretches the smallest lag is the period."""
    found = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i < len(x) - q:
            j = i
            while j < len(x) - q and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(x, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [v for i, v in enumerate(x) if i not in gone]


def runs_of(texts, least=12):
    ids = np.array([x for t in texts for x in t], np.int64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    begin, end, period = find_runs(ids, text, least)
    first = np.cumsum([0, *map(len, texts)])
    out = [[] for _ in texts]
    for b, e, q in zip(begin.tolist(), end.tolist(), period.tolist()):
        out[text[b]].append((b - int(first[text[b]]), e - b, q))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=3))
def test_runs_of_few_words_equal_brute_force(texts):
    assert runs_of(texts) == [plain_runs(t) for t in texts]


def test_planted_and_nested_runs_equal_brute_force():
    draw = random.Random(5)
    for _ in range(300):
        texts = []
        for _ in range(draw.randint(1, 4)):
            n = draw.choice([0, 11, 12, 60, 200])
            t = [draw.randrange(draw.choice([2, 6, 400])) for _ in range(n)]
            for _ in range(draw.randint(0, 2)):
                a, p = draw.randint(0, n), draw.randint(1, 70)
                t[a:] = [t[a + i % p] for i in range(n - a)] if a + p <= n else t[a:]
            texts.append(t)
        assert runs_of(texts) == [plain_runs(t) for t in texts]


def test_long_texts_of_few_words_take_near_linear_time():
    unit = [*[0] * 20, 1]
    n = 100_000
    assert runs_of([[0] * n])[0] == [(0, n, 1)]
    found = runs_of([(unit * (n // 21))])[0]
    assert found[:2] == [(0, 20, 1), (0, n // 21 * 21, 21)]
    assert len(found) == 1 + n // 21
    deep = [0]
    for i in range(1, 12):
        deep = [*deep, i, *deep]
    assert runs_of([deep]) == [plain_runs(deep)]


def test_odd_rows(spark, odd_docs, no_docs):
    def loud(doc_id, words):
        return [*words, b"!"] if doc_id == 8 else words

    rows = periodic_runs(odd_docs, prepare=loud).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert [tuple(x) for x in by_id[7].runs] == [(0, 40_000, 1)]
    assert by_id[7].collapsed == "word"
    assert by_id[7].n_words == 40_000
    for i in (1, 2, 3):
        assert (by_id[i].n_words, by_id[i].runs, by_id[i].collapsed) == (0, [], "")
    assert by_id[8].collapsed.endswith("[INST] !")
    assert by_id[None].runs == []
    assert periodic_runs(no_docs).collect() == []
    # Text ids and clashing names.
    named = odd_docs.selectExpr("cast(doc_id as string) as doc_id", "text", "1 as runs", "2 as collapsed")
    assert periodic_runs(named).count() == odd_docs.count()


def test_query_equals_brute_force(spark):
    folder = str(TESTDATA / "sf0.001")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op13_periodic_runs(spark, folder).collect()}
    assert got.keys() == texts.keys()
    some = 0
    for doc_id, text in texts.items():
        x = (text or "").encode().split()
        h, n = crc32(str(doc_id).encode()), len(x)
        if n > 3000 and h % 10:
            continue  # brute force takes the square of a text's length
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(x)
        some += bool(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2])))
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(collapsed(x, runs))).hexdigest()
    assert some > 5
