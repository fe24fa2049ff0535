"""Operators that SQL cannot express, against plain versions and round trips."""

import hashlib
import random
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from paywarden.llm import chat_format as chat, decontamination as leaks, language_id, license_scan, secrets, sentencepiece
from paywarden.llm.personal_data import anchors, find_personal_data, find_spans

AUTOMATON = anchors()


# --- personal data -----------------------------------------------------------


def base_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[ -]", "", m[0])
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.+-_ ()0159é\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert [s for s in find_spans(text, AUTOMATON) if s[1] < 4] == base_spans(text)


def test_cards_and_more():
    text = "4111 1111 1111 1111, +1 (555) 555-1234 at 10.0.0.1 or 1.2.3.4.5.6.7.8; see https://a.example/x). IBAN: DE89 3704 0044 0532 0130 00"
    spans = find_spans(text, AUTOMATON)
    assert [s for s in spans if s[1] < 4] == base_spans(text)
    assert [text[a:b] for a, k, b in spans if k > 3] == ["https://a.example/x", "DE89 3704 0044 0532 0130 00"]


def test_ibans_of_all_forms():
    ibans = [
        "GB29 NWBK 6016 1331 9268 19", "NL91 ABNA 0417 1643 00", "IE29 AIBK 9311 5212 3456 78", "DE89 3704 0044 0532 0130 00",
        "NO93 8601 1117 947", "IS14 0159 2600 7654 5510 7303 39", "FR14 2004 1010 0505 0001 3M02 606", "MT84 MALT 0110 0001 2345 MTLC AST0 01S",
        "GB29NWBK60161331926819", "nl91-abna-0417-1643-00",
    ]
    # Of a country without a known length, any end that is right.
    ibans.append(next(f"ZZ{k:02} ABCD 1234 5678 9012" for k in range(2, 99) if int(f"1011121312345678901235 35{k:02}".replace(" ", "")) % 97 == 1))
    for iban in ibans:
        for before in ("IBAN ", "iban: ", "IBAN no. ", "Iban is "):
            for after in ("", ".", " 2024", " and more", " a1 b2", "\n12"):
                text = f"pay {before}{iban}{after}"
                assert [text[a:b] for a, k, b in find_spans(text, AUTOMATON) if k == 5] == [iban], text
    for bad in ("GB28 NWBK 6016 1331 9268 19", "GB29 NWBK 6016 1331 9268 190", "GB29 NWBK", "", " ", "-", "GB29NWBK60161331926819" * 9):
        assert not [s for s in find_spans(f"IBAN {bad}", AUTOMATON) if s[1] == 5]


def test_odd_texts(odd_docs, no_docs):
    assert find_personal_data(odd_docs).count() == 10
    assert find_personal_data(no_docs).count() == 0


# --- secrets -----------------------------------------------------------------


def secret_spans(text):
    out = []
    pattern = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(pattern, text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_secrets(spark, odd_docs, no_docs):
    rng = random.Random(3)
    parts = ["password=", "Secret: '", "token", "=", "AKIA", "ABCDEFGH2345", "0123456789abcdef", "é🎉", " ", "x1y2z3w4", "\n", "api_key:"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(14)))) for i in range(300)]
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    for r in found:
        assert [tuple(s) for s in r.spans if s.kind < 3] == secret_spans(texts[r.doc_id])
    assert secrets.find_secrets(odd_docs).count() == 10
    assert secrets.find_secrets(no_docs).count() == 0


def test_random_tokens_are_told_from_ordinary_ones(spark):
    rng = random.Random(5)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    strong = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(60)]
    weak = ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaA1", "Abcdefghijklmnopqrstuvwxyzabcdefghijklmn1", "getElementsByClassName1AndTagNameAndText"]
    rows = [(i, f"see {t} here") for i, t in enumerate(strong + weak)]
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hits = {r.doc_id for r in got if any(s.kind == 3 for s in r.spans)}
    assert len(hits & set(range(60))) >= 50
    assert not hits & {60, 61}


def test_random_tokens_of_every_form_are_found(spark):
    rng = random.Random(11)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"

    def key(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    def uuid():
        return "-".join(key(digits + "abcdef", n) for n in (8, 4, 4, 4, 12))

    forms = {
        "upper": lambda: key(upper + digits, 28),
        "uuid": uuid,
        "prefix": lambda: "sk_live_" + key(lower + digits, 32),
        "letters": lambda: key(lower, 30),
        "both cases": lambda: key(upper + lower, 30),
        "digits": lambda: key(digits, 40),
        "path": lambda: key(lower + digits, 12) + "/" + key(lower + digits, 16),
    }
    made = [(name, make()) for name, make in forms.items() for _ in range(20)]
    named = ["K8Q0ZR91WX7PLM2N9TYB4VD0HGS6", "sk_live_9q2z7x4k1m8n5b3v6c0a", "0" * 40, "-" * 60, "get_all_the_elements_in_the_list_and_return_them"]
    rows = [(i, f"see {t} here") for i, t in enumerate([t for _, t in made] + named)]
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hits = {r.doc_id for r in got if any(s.kind == 3 for s in r.spans)}
    for name in forms:
        assert sum(form == name and i in hits for i, (form, _) in enumerate(made)) >= 16, name
    assert [len(made) + k in hits for k in range(len(named))] == [True, True, False, False, False]


def test_long_keys_among_ordinary_tokens_are_found(spark):
    rng = random.Random(12)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows = []
    for i, n in enumerate([24, 40, 400, 4096] * 5):
        key = "".join(rng.choice(alphabet) for _ in range(n))
        rows.append((i, " ".join([f"aaaaaaaaaaaaaaaaaaaaaA{k:02}" for k in range(39)] + [key])))
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == 3] for r in got}
    assert all((a, b) == (39 * 25, len(rows[i][1])) for i, own in spans.items() for a, b in own)
    for k in range(4):
        assert sum(len(spans[i]) for i in range(k, 20, 4)) >= 4


def test_long_tokens_and_many_matches_take_time_in_proportion(spark):
    rng = random.Random(13)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

    def key(n):
        return "".join(rng.choices(alphabet, k=n))

    def seconds(*texts):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        begin = time.monotonic()
        out = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.find_secrets(df).collect()}
        return time.monotonic() - begin, out

    seconds("warm " + key(1000))
    took, out = seconds("x" * 10 + " " + key(400_000), " ".join(key(24) for _ in range(20_000)))
    assert took < 60
    assert out[0] in ([], [(11, 3, 400_011)])
    assert 18_000 < len(out[1]) <= 20_000 and all(a % 25 == 0 and b == a + 24 for a, _, b in out[1])
    # Spans of a text with many matches are those of the plain version.
    text = " ".join(rng.choice(["token=abcdefgh1", "AKIAABCDEFGH2345", "ok", "secret: é", "0123456789abcdef" * 2]) for _ in range(5_000))
    _, out = seconds(text)
    assert [s for s in out[0] if s[1] < 3] == secret_spans(text)


# --- pieces ------------------------------------------------------------------


def _toy():
    pieces = ["<unk>", *[f"<0x{b:02X}>" for b in range(256)], "▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "▁▁"]
    scores = [0.0] * 257 + [-3, -4, -4, -4, -5, -5.5, -9.5, -4.5, -6.5, -8]
    return sentencepiece.Pieces(pieces, scores, [i > 256 for i in range(len(pieces))], list(range(1, 257)))


TOY = _toy()


def _score(ids):
    return sum(TOY.unknown if i <= 256 else TOY.scores[i] for i in ids)


def _plain_best(text):
    """The best score over all cuts of a marked text, without unknown characters."""
    names = {"▁": -3, "a": -4, "b": -4, "c": -4, "ab": -5, "bc": -5.5, "abc": -9.5, "▁a": -4.5, "▁ab": -6.5, "▁▁": -8}
    best = [0.0] + [float("-inf")] * len(text)
    for j in range(1, len(text) + 1):
        best[j] = max((best[i] + names[text[i:j]] for i in range(j) if text[i:j] in names), default=float("-inf"))
    return best[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc ", max_size=20))
def test_the_path_is_the_best_one(text):
    ids = sentencepiece._Encoder(TOY)(text).tolist()
    assert TOY.decode(ids) == text
    if text:
        assert abs(_score(ids) - _plain_best("▁" + text.replace(" ", "▁"))) < 1e-9


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_any_text_comes_back(text):
    ids = sentencepiece._Encoder(TOY)(text).tolist()
    assert TOY.decode(ids) == text


def test_encode_and_decode_tables(odd_docs, no_docs):
    rows = sentencepiece.encode(odd_docs)
    got = {(r.doc_id, r.n_tokens): r for r in rows.collect()}
    assert all(r.round_trip and len(r.ids) == r.n_tokens for r in got.values())
    assert (1, 0) in got and (2, 0) in got
    texts = {(r.doc_id, r.text or "") for r in odd_docs.collect()}
    assert {tuple(r) for r in sentencepiece.decode(rows).collect()} == texts
    assert sentencepiece.encode(no_docs).count() == 0


def test_real_pieces_have_log_scores_and_best_paths():
    import sentencepiece as model_reader

    model = model_reader.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    pieces = sentencepiece.Pieces.load(sentencepiece.MODEL)
    names = {model.id_to_piece(i): pieces.scores[i] for i in range(257 + 2, model.get_piece_size())}
    assert max(names.values()) < 0 and abs(sum(np.exp(s) for s in names.values()) - 1) < 1e-9
    encoder = sentencepiece._Encoder(pieces)
    texts = ["The quick brown fox jumps over the lazy dog", "Über die Straße  gehen", "a", "  two", "def f(x): return x ** 2", "naïve café"]
    for text in texts:
        marked = "▁" + text.replace(" ", "▁")
        best = [0.0] + [float("-inf")] * len(marked)
        for j in range(1, len(marked) + 1):
            best[j] = max((best[i] + names[marked[i:j]] for i in range(j) if marked[i:j] in names), default=float("-inf"))
        ids = encoder(text).tolist()
        assert abs(sum(pieces.scores[i] for i in ids) - best[-1]) < 1e-9 and pieces.decode(ids) == text
    assert len(encoder(texts[0])) == 11 == len(model.encode(texts[0]))


def test_ranks_become_log_scores_and_ties_keep_their_order():
    got = sentencepiece.log_scores([0.0, -5.0, -1.0, -5.0], [False, True, True, True])
    assert got[0] == 0 and got[2] > got[1] > got[3] and abs(sum(np.exp(got[1:])) - 1) < 1e-12


# --- chat --------------------------------------------------------------------

FRAGMENTS = st.lists(st.sampled_from([*chat.CONTROLS, "[", "/INST]", "<", "</s", ">", "\\", " ", "\n", "a", "[INST] "]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "x<|text|>"]), FRAGMENTS), max_size=5))
def test_output_is_read_back(turns):
    program = chat.Program()
    pieces = [program.turn(i, r, t) for i, (r, t) in enumerate(turns)]
    assert chat.read_back("".join(p for p, _ in pieces)) == turns
    learned = [chat.unescape(p[a:b]) for p, spans in pieces for a, b in spans]
    assert learned == [t for r, t in turns if r == "assistant"]


def test_templates_fold_and_refuse():
    program = chat.Program("{{ 'a' + 'b' | upper }}{% for m in messages %}{% if 1 == 2 %}no{% else %}{{ m.role + ':' }}{% endif %}{% endfor %}!")
    assert (program.before(), program.turn(0, "r", "t")[0], program.after()) == ("aB", "r:", "!")
    for bad in ("no loop", "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in messages %}{{ open('x') }}{% endfor %}", "{% for m in messages %}{% set x %}{% endfor %}", "{% for m in messages %}"):
        try:
            chat.Program(bad)
        except chat.TemplateError:
            continue
        raise AssertionError(bad)


def test_conversation_tables(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (None, 0, None, "x"), (2, 0, "assistant", "</s>\\"), (2, 0, "assistant", "</s>\\")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as place")
    got = {r.conv_id: r for r in chat.formatted_digests(df).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\nhi\nassistant\n\n").hexdigest()
    assert (got[2].loss_chars, got[2].loss_sha256) == (10, hashlib.sha256(b"</s>\\</s>\\").hexdigest())
    assert got[None].n_turns == 1 and chat.formatted_digests(df.where("false")).count() == 0
    pieces = chat.format_turns(df).orderBy("conv_id", "place").collect()
    assert sum(len(r.formatted) for r in pieces if r.conv_id == 2) == got[2].formatted_chars


def test_conversations_cut_into_ranges_are_numbered_through(spark):
    rng = random.Random(14)
    big = [(7, rng.randrange(400), rng.choice(["user", "assistant", None]), rng.choice(["a", "</s>", None]) ) for _ in range(600)]
    rows = big + [(None, 0, "user", "same")] * 300 + [(c, t, "user", f"{c} {t}") for c in (1, 2, 9) for t in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    template = "<{% for m in messages %}{{ loop.index0 }}{% if loop.first %}!{% endif %}{{ m.role }}:{{ m.text }},{% endfor %}>"
    program, convs = chat.Program(template), {}
    for row in sorted(rows, key=lambda r: (r[0] or 0, r[1], r[2] or "", r[3] or "")):
        convs.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    # Ranges are cut differently with other numbers of partitions; the output is the same.
    for n in ("1", "3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            out = chat.format_turns(df, template)
            got = {}
            for r in sorted(out.collect(), key=lambda r: r.place):
                got.setdefault(r.conv_id, []).append((r.place, r.formatted))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        for conv, turns in convs.items():
            assert [p for p, _ in got[conv]] == list(range(len(turns)))
            plain = [program.turn(i, *x)[0] for i, x in enumerate(turns)]
            assert "".join(f for _, f in got[conv]) == "<" + "".join(plain) + ">"
        assert set(got) == set(convs)
    assert chat.format_turns(df.where("false")).count() == 0


# --- benchmark items ---------------------------------------------------------


def _distance(a, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc", min_size=1, max_size=12), st.text(alphabet="abc", max_size=30))
def test_bit_parallel_distance(item, text):
    assert leaks.nearest(item, text)[0] == _distance(item, text)


def test_items_within_the_budget_are_found():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(12)]
    index = leaks.Items(items)
    for _ in range(60):
        number, item = rng.choice(items)
        own = list(item)
        for _ in range(rng.randrange(int(len(item) * leaks.ERROR_RATE) + 6)):
            k = rng.randrange(len(own))
            own[k : k + 1] = rng.choice([[], ["z"], [own[k], "q"]])
        text = " ".join(rng.choice(words) for _ in range(50)) + " " + "".join(own) + " " + rng.choice(words)
        got = {(i, d) for i, d, _ in index.found(text)}
        want = {(i, d) for i, t in items if (d := _distance(t, text)) <= int(len(t) * leaks.ERROR_RATE)}
        assert got == want


def test_leaks_in_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "quick, BROWN fox; jumps over the lazy dog"), (2, None), (3, ""), (4, "dog")], "item_id long, text string")
    got = leaks.find_leaks(odd_docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.distance) for r in got) == [(0, 1, 0), (4, 1, 0), (5, 1, 0), (5, 1, 0), (6, 1, 0)]
    assert leaks.find_leaks(no_docs, items).count() == 0
    assert leaks.find_leaks(odd_docs, items.where("false")).count() == 0


def _plain_found(item, text):
    item, text = leaks.plain(item), leaks.plain(text)
    if len(item) < leaks.SHORT_CHARS:
        return bool(item) and f" {item} " in f" {text} "
    return _distance(item, text) <= int(len(item) * leaks.ERROR_RATE)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab ,", max_size=30), max_size=6), st.text(alphabet="ab ,", max_size=60))
def test_items_of_any_length_are_found(items, text):
    rows = [(i, own) for i, t in enumerate(items) if (own := leaks.plain(t))]
    got = {i for i, *_ in leaks.Items(rows).found(leaks.plain(text))} if rows else set()
    assert got == {i for i, t in enumerate(items) if _plain_found(t, text)}


def test_short_items_are_found_as_whole_words(spark, odd_docs):
    rows = [(1, "lazy dog"), (2, "azy do"), (3, "Jumps-Over"), (4, "lazy dgg"), (5, " ,"), (6, None), (None, "lazy"), (7, "漢字")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    got = leaks.find_leaks(odd_docs, items, least_chars=1).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, i) for d in (4, 5, 6, None) for i in (1, 3)} | {(8, 7)}
    assert {(r.distance, r.end_char) for r in got if r.item_id == 1} == {(0, 43)}
    assert leaks.find_leaks(odd_docs, items).count() == 0


# --- licenses and languages --------------------------------------------------


def test_notices(spark, odd_docs, no_docs):
    header = license_scan.NOTICES["Apache-2.0-header"]
    changed = header.replace("obtain", "get")
    rows = [(1, f"x {header} y"), (2, "so, " * 300 + "released UNDER the MIT licence. Released under the MIT license " + "z " * 99), (3, changed + " q"), (4, "under the license")]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license_id) for r in got} == {(1, "Apache-2.0-header"), (2, "MIT")}
    assert license_scan.scan_licenses(odd_docs).count() == 0 == license_scan.scan_licenses(no_docs).count()


def test_whole_and_windowed_search_agree():
    templates = license_scan.Templates(license_scan.NOTICES)
    rng = random.Random(2)
    for name, notice in license_scan.NOTICES.items():
        for before in (0, 1, 7, 33, 200):
            words = [f"f{rng.randrange(999)}" for _ in range(before)]
            text = license_scan._plain(" ".join([*words, notice, *words]))
            grams, _ = license_scan._shingles([text])
            assert name in {templates.ids[t] for t, *_ in templates.matches(grams)}


def test_notices_with_words_put_into_them_are_found():
    templates = license_scan.Templates(license_scan.NOTICES)
    rng = random.Random(6)
    contained, found, false = 0, 0, 0
    for name, notice in license_scan.NOTICES.items():
        whole = set(license_scan._shingles([license_scan._plain(notice)])[0].tolist())
        for put in (0, 1, 5, 20, 40) * 12:
            words, extra = license_scan._plain(notice).split(), [f"x{rng.randrange(999)}" for _ in range(put)]
            k = rng.randrange(len(words))
            around = [f"f{rng.randrange(999)}" for _ in range(rng.randrange(200))]
            grams, _ = license_scan._shingles([" ".join([*around, *words[:k], *extra, *words[k:], *around])])
            want = len(whole & set(grams.tolist())) >= license_scan.LEAST_CONTAINED * len(whole)
            got = name in {templates.ids[t] for t, *_ in templates.matches(grams)}
            contained, found, false = contained + want, found + (want and got), false + (got and not want)
    assert contained > 300 and found / contained >= 0.98 and not false


def test_languages_on_held_out_texts(spark):
    from pathlib import Path

    from paywarden.llm.queries import op2_language_id

    folder = "/root/testdata/sf0.01"
    assert Path(folder).exists()
    got = op2_language_id(spark, folder).where("held_out")
    true = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = got.join(true, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95


def test_languages_of_odd_texts(odd_docs, no_docs):
    learned = language_id.learn(odd_docs)
    rows = language_id.predict(odd_docs, learned, keep=["doc_id", "id"]).collect()
    by_id = {r.id: r for r in rows}
    assert len(rows) == 10 and [by_id[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3
    assert language_id.predict(no_docs, learned).count() == 0
    assert {r.lang_pred for r in language_id.predict(odd_docs, language_id.learn(no_docs)).collect()} == {"und"}


def test_profiles_do_not_depend_on_neighbours():
    texts = ["Hello there", "", "ß", "Ünd so weiter", "12 34"]
    together = language_id.profiles(texts)
    assert all((together[i] == language_id.profiles([t])[0]).all() for i, t in enumerate(texts))
    assert pa.array(texts).null_count == 0


def _plain_profile(text):
    letters = ["\0"]
    for c in f" {text}\n".lower():
        if c.isalpha() or letters[-1] != "\0":
            letters.append(c if c.isalpha() else "\0")
    out = np.zeros(language_id.DIMENSIONS)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if b != "\0":
            x, y, z = language_id._vectors(np.array([ord(a), ord(b), ord(c)], np.uint32)).astype(int)
            out += np.roll(x, 2) * np.roll(y, 1) * z
    return out


def test_profiles_are_those_of_the_definition():
    rng = random.Random(4)
    texts = ["".join(rng.choices("abc äÖ漢字.7\n", k=rng.randrange(40))) for _ in range(60)]
    for own, text in zip(language_id.profiles(texts), texts):
        assert (own == _plain_profile(text)).all(), text


def test_many_short_texts_with_many_letters_need_little_memory():
    rng = random.Random(9)
    han = [chr(c) for c in range(0x4E00, 0x9000)]
    texts = ["".join(rng.choices(han, k=17)) for _ in range(10_000)]
    some = language_id.profiles(texts[:50])
    tracemalloc.start()
    whole = language_id.profiles(texts)
    peak = tracemalloc.get_traced_memory()[1]
    one = "".join(texts)
    tracemalloc.reset_peak()
    language_id.profiles([one])
    assert peak < 400e6 and tracemalloc.get_traced_memory()[1] < 600e6
    tracemalloc.stop()
    assert (whole[:50] == some).all()
