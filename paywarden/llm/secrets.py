"""Secrets in text: named patterns, and tokens that pass a battery of randomness tests.

Everything is a column expression.  Where a pattern matches, the text is split
by it; lengths of pieces and matches give the spans, in code points.  Positions
are added up in blocks, and what is used twice is held by a lambda's variable,
so work is linear in a token's length and in a document's tested tokens, and
grows with the power 1.5 of its matches.

A long token is put into the narrowest encoding it fits: digits, letters, both,
hexadecimal or base 32 without its separators, or base 64, which holds every
token.  Under the hypothesis that its symbols are drawn evenly and
independently, four tests give a p-value: chi-squared on four equal parts of
the alphabet, runs above and below its middle, correlation of neighbours, and
the number of letters that are common in words; four times the least is the
token's.  Ordinary tokens are far from
random and are rejected, with the false discovery rate of each document held
by the step-up procedure on weighted p-values.  A token longer than its
document's mean has more power and needs less weight: the weight is the mean
length over its own, and never above 1, so a truly random token of any length
is rejected at a rate of FALSE_DISCOVERIES at most.  Tokens not rejected are
reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
#: Runs are maximal, so asking for the length in the pattern finds the same matches.
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ["assign", "access", "hex", "random"]
#: Least bits that a reported token carries, and the rate of falsely rejected random ones.
LEAST_BITS = 100
FALSE_DISCOVERIES = 0.05

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"
#: Ten letters that make up about three quarters of English text.
_COMMON = "etaoinsrhlETAOINSRHL"
#: In all but the widest encoding these stand between symbols.
_SEPARATORS = "-_+/"
# Encodings from narrow to wide: symbols in order of value, and what a token in it looks like.
_ENCODINGS = [
    (_DIGITS, r"^[0-9]+$"),
    ("0123456789abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$"),
    ("0123456789ABCDEF", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$"),
    (_UPPER, r"^[A-Z]+$"),
    (_LOWER, r"^[a-z]+$"),
    (_UPPER + "234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$"),
    (_DIGITS + _UPPER, r"^[0-9A-Z]+$"),
    (_DIGITS + _LOWER, r"^[0-9a-z]+$"),
    (_UPPER + _LOWER, r"^[A-Za-z]+$"),
]
_WIDEST = _UPPER + _LOWER + _DIGITS + "+/"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(steps: Column, at: Column) -> Column:
    """Array of (start, end, found) of (gap, found) steps from position ``at`` on."""
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")

    def step(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + x["gap"]
        end = start + F.length(x["found"])
        own = F.struct(start.alias("start"), end.alias("end"), x["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(so_far["out"], F.array(own)).alias("out"))

    return F.aggregate(steps, F.struct(at.alias("at"), empty.alias("out")), step, lambda x: x["out"])


def _begins(widths: Column) -> Column:
    """Where each of a row of blocks begins."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(so_far: Column, width: Column) -> Column:
        out = F.concat(so_far["out"], F.array(so_far["at"]))
        return F.struct((so_far["at"] + width).alias("at"), out.alias("out"))

    return F.aggregate(widths, first, step, lambda x: x["out"])


def _blocks(steps: Column) -> Column:
    """The array cut into about as many blocks as a block has elements; it must not be empty."""
    size = F.ceil(F.sqrt(F.size(steps))).cast("int")
    return F.transform(F.sequence(F.lit(1), F.size(steps), size), lambda i: F.slice(steps, i, size))


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, found) of all matches, left to right."""
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    width = lambda s, x: s + x["gap"] + F.length(x["found"])

    def steps(found: Column) -> Column:
        return F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)),
            found,
            lambda piece, m: F.struct(F.length(piece).alias("gap"), m.alias("found")),
        )

    def spans(blocks: Column) -> Column:
        begins = _begins(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), width)))
        return F.flatten(F.zip_with(blocks, begins, _running))

    all_spans = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda f: _let(steps(f), lambda s: _let(_blocks(s), spans)))
    return F.when(text.rlike(pattern), all_spans).otherwise(empty)


def _p_normal(z: Column) -> Column:
    """Upper tail of the normal distribution, by a logistic curve, to 0.0002."""
    return 1 / (1 + F.exp(F.lit(1.5976) * z + F.lit(0.07056) * z * z * z))


def _in_quarter(k: int, n_symbols: Column):
    return lambda v: F.floor(v * 4 / n_symbols) == k


def _of_kind(kind: int):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"))


def _n_common(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, _COMMON, ""))


def _pairs(values: Column) -> Column:
    """Neighbours as (a, b)."""
    n = F.size(values) - 1
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(2), n), pair)


def _p_random(token: Column, alphabet: Column, values: Column) -> Column:
    """p-value of the battery for a token and its symbols' places in the alphabet, from 0."""
    n_symbols = F.length(alphabet).cast("double")
    n = F.size(values).cast("double")
    chi = F.lit(0.0)
    for k in range(4):
        count = F.size(F.filter(values, _in_quarter(k, n_symbols)))
        chi = chi + F.pow(count - n / 4, 2) / (n / 4)
    # Wilson and Hilferty's normal form of a chi-squared value with three degrees of freedom.
    p_chi = _p_normal((F.pow(chi / 3, 1 / 3) - (1 - 2 / 27)) / (2 / 27) ** 0.5)
    half = n_symbols / 2
    mean = (n_symbols - 1) / 2
    variance = (n_symbols * n_symbols - 1) / 12

    def neighbours(pairs: Column) -> Column:
        changes = F.size(F.filter(pairs, lambda x: (x["a"] < half) != (x["b"] < half)))
        p_runs = 2 * _p_normal(F.abs(changes - (n - 1) / 2) / F.sqrt((n - 1) / 4))
        product = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + (x["a"] - mean) * (x["b"] - mean))
        p_serial = 2 * _p_normal(F.abs(product / variance) / F.sqrt(n - 1))
        return F.least(p_runs, p_serial)

    share = _n_common(alphabet) / n_symbols
    z_common = (_n_common(token) - n * share) / F.sqrt(n * share * (1 - share))
    p_common = F.when(share > 0, _p_normal(z_common)).otherwise(F.lit(1.0))
    return F.least(F.lit(1.0), 4 * F.least(p_chi, _let(_pairs(values), neighbours), p_common))


def _encoded(token: Column) -> Column:
    """(t, a): a token's symbols and the alphabet of the narrowest encoding they fit."""

    def form(symbols: Column, alphabet: str) -> Column:
        return F.struct(symbols.alias("t"), F.lit(alphabet).alias("a"))

    bare = F.translate(token, _SEPARATORS, "")
    choice = form(F.translate(token, "-_", "+/"), _WIDEST)
    for alphabet, shape in reversed(_ENCODINGS):
        choice = F.when(bare.rlike(shape), form(bare, alphabet)).otherwise(choice)
    # Nothing but separators: no symbols.
    return F.when(bare == "", form(bare, _WIDEST)).otherwise(choice)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and ``spans``, an array of (start, kind, end), sorted.

    ``kind`` is a place in KINDS; starts and ends are code points, the end
    exclusive.  Assignments need a value of 8 characters or more, access keys 16
    and hexadecimal runs 32.  Every match of TOKEN is tested unless its symbols,
    without separators, carry less than LEAST_BITS.  Spans of different kinds may
    overlap.

    Null and empty texts have no spans.  Repeated rows are reported each.  Other
    columns are not read.  Memory grows with a document's own matches; a token may be
    as long as its document.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("text"))
    t = F.col("text")
    found = [
        F.filter(_matches(t, ASSIGN), lambda x: F.length(F.regexp_extract(x["found"], ASSIGN, 2)) >= 8),
        F.filter(_matches(t, ACCESS), lambda x: F.length(x["found"]) >= 16),
        _matches(t, HEX),
    ]
    rows = rows.select(id_col, *[x.alias(k) for x, k in zip(found, KINDS)], _tokens(t).alias("tokens"))
    rows = rows.withColumn("tested", F.transform("tokens", _tested))
    rows = rows.withColumn("random", _not_rejected(F.col("tested")))
    spans = [F.transform(k, _of_kind(i)) for i, k in enumerate(KINDS)]
    return rows.select(id_col, F.array_sort(F.concat(*spans)).alias("spans"))


def _tokens(text: Column) -> Column:
    """Array of (start, end, x): long tokens, with their symbols and the alphabet they fit."""
    tokens = F.transform(
        _matches(text, TOKEN),
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), _encoded(x["found"]).alias("x")),
    )
    bits = lambda x: F.length(x["t"]) * F.log2(F.length(x["a"]).cast("double"))
    return F.filter(tokens, lambda x: bits(x["x"]) >= LEAST_BITS)


def _tested(x: Column) -> Column:
    token, alphabet = x["x"]["t"], x["x"]["a"]
    values = F.transform(F.split(token, ""), lambda c: F.instr(alphabet, c) - 1)
    p = _let(values, lambda v: _p_random(token, alphabet, v))
    return F.struct(x["start"].alias("start"), x["end"].alias("end"), p.alias("p"))


def _not_rejected(tested: Column) -> Column:
    """Weighted step-up rejection within the document; what is left."""
    m = F.size(tested)
    length = lambda x: x["end"] - x["start"]
    total = F.aggregate(tested, F.lit(0.0), lambda s, x: s + length(x))

    def weighted(total: Column) -> Column:
        over_mean = lambda x: F.greatest(F.lit(1.0), length(x) * m / total)
        return F.transform(
            tested, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), (x["p"] * over_mean(x)).alias("p"))
        )

    def cut(own: Column) -> Column:
        ordered = F.array_sort(F.transform(own, lambda x: x["p"]))
        passing = F.transform(ordered, lambda p, i: F.when(p <= (i + 1) * FALSE_DISCOVERIES / m, p))
        return F.coalesce(F.array_max(passing), F.lit(-1.0))

    def left(own: Column) -> Column:
        return _let(cut(own), lambda c: F.filter(own, lambda x: x["p"] > c))

    return _let(_let(total, weighted), left)
