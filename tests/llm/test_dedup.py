"""Exact, near and substring duplicates against brute force."""

import random
import re

from paywarden.llm import substring_dedup
from paywarden.llm.components import components
from paywarden.llm.exact_dedup import drop_exact_copies, exact_dedup
from paywarden.llm.jaccard_join import jaccard_components
from paywarden.llm.substring_dedup import remove_repeats

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(rows, size=13):
    words = [(d, SPLIT.findall(t or "")) for d, t in rows]
    first = {}
    for d, x in words:
        for i in range(len(x) - size + 1) if d is not None else ():
            g = tuple(x[i : i + size])
            first[g] = min(first.get(g, d), d)
    out = []
    for d, x in words:
        gone = set()
        for i in range(len(x) - size + 1) if d is not None else ():
            if first[tuple(x[i : i + size])] < d:
                gone.update(range(i, i + size))
        out.append((d, len(x), len(gone), " ".join(y for i, y in enumerate(x) if i not in gone)))
    return sorted(out, key=repr)


def linked(rows, size, percent):
    sets = []
    for _, t in rows:
        x = SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        grams = {tuple(x[i : i + size]) for i in range(len(x) - size + 1)}
        sets.append(grams or ({tuple(x)} if x else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=repr)


def random_texts(seed, alphabet, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        base = [rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 4, 12, 13, 40, 90]))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.choice([0, 0, 1, 6])):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(alphabet)
            rows.append((len(rows), "\t".join(copy)))
        if rng.random() < 0.3:
            rows.append((len(rows), rows[rng.randrange(len(rows))][1] + " then " + " ".join(base[3:])))
    return rows


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_repeats_in_few_words(spark):
    for k in (1, 2, 3, 26):
        rows = random_texts(k, list("abcdefghijklmnopqrstuvwxyz"[:k]), 40)
        assert plain(remove_repeats(frame(spark, rows))) == repeats(rows)


def test_repeats_of_a_hot_passage(spark, monkeypatch):
    from paywarden.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "_HOT_LEAST", 5)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(d, f"a{d} {passage} b{d} c") for d in range(200)]
    assert plain(remove_repeats(frame(spark, rows))) == repeats(rows)


def test_links(spark):
    words = [a + b for a in "abcdefghijklmno" for b in "Aeiou"]
    for size, percent in ((3, 90), (5, 80), (2, 50)):
        rows = random_texts(size, words, 40)
        got = jaccard_components(frame(spark, rows), size=size, percent=percent)
        assert plain(got) == linked(rows, size, percent)


def test_links_in_a_large_group(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(250):
        own = list(base)
        for _ in range(rng.randrange(5)):
            own[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(own)))
    assert plain(jaccard_components(frame(spark, rows))) == linked(rows, 3, 90)


def test_components_of_a_path(spark):
    rng = random.Random(1)
    nodes = rng.sample(range(10**6), 200)
    links = spark.createDataFrame(list(zip(nodes, nodes[1:])), "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(n, min(nodes)) for n in nodes}


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert plain(remove_repeats(odd_docs)) == repeats(rows)
    assert plain(jaccard_components(odd_docs)) == linked(rows, 3, 90)
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(odd_docs).collect()}
    assert {(4, 5, 4, False), (5, 5, 4, True), (None, 5, 4, False), (1, 2, 2, False), (2, 2, 2, True)} <= got
    kept = drop_exact_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7, 8]
    for make in (remove_repeats, jaccard_components, exact_dedup, drop_exact_copies):
        assert make(no_docs).count() == 0


def test_frequent_texts_are_settled_alike(spark, monkeypatch):
    from paywarden.llm import exact_dedup as module

    rows = [(d, f"t{d % 7 if d % 3 else 0}" if d % 5 else f"own {d}") for d in range(500)]
    split = plain(exact_dedup(frame(spark, rows)))
    monkeypatch.setattr(module, "HOT_SHARE", 1)
    assert plain(exact_dedup(frame(spark, rows))) == split


def test_words_that_a_polynomial_cannot_tell_apart(spark):
    for n in (1024, 4096):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        other = word.translate(str.maketrans("ab", "ba"))
        rows = [(1, " ".join([word] * 13)), (2, " ".join([other] * 13)), (3, other)]
        assert plain(remove_repeats(frame(spark, rows))) == repeats(rows)
        assert plain(jaccard_components(frame(spark, rows))) == linked(rows, 3, 90)


def test_many_groups_that_share_a_passage(spark, monkeypatch):
    from paywarden.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "_SEGMENT", 64)
    monkeypatch.setattr(jaccard_join, "_FLUSH", 100)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(d, f"{passage} x{d // 5} y{d // 5} z{d // 10}" + (" again" if d % 2 else "")) for d in range(120)]
    rows += [(200 + d, f"own{d} w{d} v{d} u{d}") for d in range(50)]
    for percent in (95, 80):
        assert plain(jaccard_components(frame(spark, rows), percent=percent)) == linked(rows, 3, percent)


def test_windows_are_stored_without_what_only_hot_ones_need(spark, monkeypatch):
    stored = {}

    def kept(df, name, stage=substring_dedup.stage):
        stored[name] = stage(df, name)
        return stored[name]

    monkeypatch.setattr(substring_dedup, "stage", kept)
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(1, text), (2, text + " x"), (3, "y " + text)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == repeats(rows)
    windows = stored["windows"]
    assert sorted(windows.columns) == ["id", "second", "window"]
    assert windows.where("second is not null").count() == 0 and windows.count() == 16
