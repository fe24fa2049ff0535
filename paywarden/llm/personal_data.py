"""Personal data in text, by anchors that local parsers expand.

One automaton finds at-signs, plus signs, digits, schemes and words that
announce an identifier.  From each anchor a parser reads as far as its kind of
data reaches, to both sides where needed, and validates what it read.  No
character is read twice by the same parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywarden.llm import words as w

KINDS = ["email", "ip", "card", "phone", "address", "account"]
_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | _DIGITS
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL = _ALNUM | frozenset("-._~:/?#[]@!$&'()*+,;=%")
#: Schemes, and words that announce an account or identity number.
SCHEMES = ["http://", "https://", "ftp://", "mailto:", "tel:"]
CUES = ["account", "acct", "iban", "passport", "ssn"]

Span = tuple[int, int, int]  # start, kind, end


def _forward(text: str, i: int, allowed: frozenset) -> int:
    while i < len(text) and text[i] in allowed:
        i += 1
    return i


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Around an at-sign; ``floor`` is where the last address ended."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _forward(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    dots = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end, dots = _forward(text, end + 1, _LABEL), dots + 1
    return (start, end) if dots else None


def _ips(text: str, start: int) -> tuple[list[tuple[int, int]], int]:
    """Four numbers at a time of a dotted chain of numbers, and where it ends."""
    parts, end = [], start
    while True:
        stop = _forward(text, end, _DIGITS)
        parts.append((end, stop))
        if stop + 1 < len(text) and text[stop] == "." and text[stop + 1] in _DIGITS:
            end = stop + 1
        else:
            break
    found = []
    for k in range(0, len(parts) - 3, 4):
        four = parts[k : k + 4]
        values = [text[a:b].lstrip("0") for a, b in four]
        if all(len(v) <= 3 and int(v or "0") <= 255 for v in values):
            found.append((four[0][0], four[3][1]))
    return found, parts[-1][1]


def _luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _card(text: str, start: int) -> tuple[tuple[int, int] | None, int]:
    """A chain of digits with single spaces or hyphens between, and where it ends."""
    end, n = start, len(text)
    while end < n:
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    digits = text[start:end].replace(" ", "").replace("-", "")
    return ((start, end) if 12 <= len(digits) <= 19 and _luhn(digits) else None), end


def _phone(text: str, plus: int) -> tuple[int, int, bool] | None:
    """From a plus sign: start, end, and whether the number of digits fits."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return None
    end = _forward(text, plus + 2, _PHONE)
    while end > plus + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < plus + 4:
        return None
    return plus, end, 9 <= sum(ch in _DIGITS for ch in text[plus:end]) <= 15


def _address(text: str, start: int, scheme_end: int) -> tuple[int, int] | None:
    """A scheme and what follows it, without closing punctuation."""
    end = _forward(text, scheme_end, _URL)
    while end > scheme_end and text[end - 1] in ".,;:!?'()[]":
        end -= 1
    return (start, end) if end > scheme_end else None


def _iban(value: str) -> bool:
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return False
    return int("".join(str(int(ch, 36)) for ch in value[4:] + value[:4])) % 97 == 1


#: Characters of an IBAN by country; others may have any number from 15 to 34.
_IBAN_CHARS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_FILLER = re.compile(r"(?:[ \t]*(?:number|no\.?|nr\.?|code|is|[:=#-]))*[ \t]*", re.IGNORECASE)
#: Before an IBAN, "no" and "is" with a digit behind them are Norway and Iceland.
_IBAN_FILLER = re.compile(r"(?:[ \t]*(?:number|no(?:\.|(?![0-9]))|nr\.?|code|is(?![0-9])|[:=#-]))*[ \t]*", re.IGNORECASE)
_GROUP = re.compile(r"[ -]?([A-Za-z0-9]+)")
_VALUE = re.compile(r"[A-Za-z0-9]+(?:[ -][A-Za-z0-9]*[0-9][A-Za-z0-9]*)*")


def _iban_span(text: str, start: int) -> tuple[int, int] | None:
    """The IBAN that starts here: groups up to its country's length, or to the last end that is right."""
    plain, end, found = "", start, None
    most = _IBAN_CHARS.get(text[start : start + 2].upper(), 34)
    # The first group follows without a mark; a longer run than an IBAN is read no further.
    while len(plain) < most and (group := _GROUP.match(text, end, end + most + 2)):
        if not plain and group.start(1) > start:
            return None
        plain, end = plain + group[1].upper(), group.end()
        whole = end == len(text) or text[end] not in _ALNUM
        if whole and len(plain) <= most and (len(plain) == most or text[start : start + 2].upper() not in _IBAN_CHARS) and _iban(plain):
            found = start, end
    return found


def _account(text: str, cue: str, cue_start: int, cue_end: int) -> tuple[int, int] | None:
    """The identifier that a cue announces: an IBAN with right check digits, or five digits or more."""
    if cue_start and text[cue_start - 1] in _ALNUM or cue_end < len(text) and text[cue_end] in _ALNUM:
        return None
    if cue == "iban":
        return _iban_span(text, _IBAN_FILLER.match(text, cue_end).end())
    value = _VALUE.match(text, _FILLER.match(text, cue_end).end())
    if not value:
        return None
    plain = value[0].replace(" ", "").replace("-", "")
    return value.span() if sum(ch in _DIGITS for ch in plain) >= 5 else None


def anchors():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for ch in "@+0123456789":
        automaton.add_word(ch, ("", 1))
    for scheme in SCHEMES:
        for form in {scheme, scheme.upper(), scheme.capitalize()}:
            automaton.add_word(form, ("scheme", len(scheme)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            automaton.add_word(form, (cue, len(cue)))
    automaton.make_automaton()
    return automaton


def find_spans(text: str, automaton) -> list[Span]:
    """All spans of a text, by start and kind."""
    spans: list[Span] = []
    # How far each parser has come.
    email = ip = card = phone = address = account = 0
    for last, (cue, length) in automaton.iter(text):
        start = last + 1 - length
        ch = text[last]
        if cue == "scheme":
            if start >= address and (not start or text[start - 1] not in _ALNUM) and (got := _address(text, start, last + 1)):
                spans.append((got[0], 4, got[1]))
                address = got[1]
        elif cue:
            if start >= account and (got := _account(text, cue, start, last + 1)):
                spans.append((got[0], 5, got[1]))
                account = got[1]
        elif ch == "@":
            if got := _email(text, last, email):
                spans.append((got[0], 0, got[1]))
                email = got[1]
        elif ch == "+":
            if last >= phone and (number := _phone(text, last)):
                phone = number[1]
                if number[2]:
                    spans.append((number[0], 3, number[1]))
        else:
            if last >= ip:
                found, ip = _ips(text, last)
                spans += [(a, 1, b) for a, b in found]
            if last >= card:
                found, card = _card(text, last)
                if found:
                    spans.append((found[0], 2, found[1]))
    return sorted(spans)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and ``spans``, an array of (start, kind, end), sorted.

    ``kind`` is a place in KINDS; starts and ends are code points, the end
    exclusive.  Null and empty texts have no spans.  Repeated rows are reported
    each.  Other columns are not read.  Whole texts are read, in one pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        for batch in w.chunks(batches, "text"):
            found = [
                [{"start": a, "kind": k, "end": b} for a, k, b in find_spans(t or "", automaton)]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)], ["id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, "id long, spans array<struct<start:int,kind:int,end:int>>")
    return out.withColumnRenamed("id", id_col)
