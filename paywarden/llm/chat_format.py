"""Render conversations by a template that is compiled to Python closures.

The language has text, ``{{ expression }}``, ``{% if %}``, one ``{% for m in
messages %}`` at the top, and ``{% generation %}`` around what a model is to
learn.  It knows no calls, no attributes but those of messages and the loop,
and no assignment, so a template can do nothing but write text.  Constants are
folded before closures are made.  A conversation is rendered row by row: its
length does not matter.

Texts are escaped when they are written: a backslash is doubled, and one is put
behind the first character of any control string, so none can be read as one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywarden.llm.tables import stage

CONTROLS = ["[INST]", "[/INST]", "</s>", "<|role|>", "<|text|>"]
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text }} [/INST]"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text }}{% endgeneration %}</s>"
    "{% else %}<|role|>{{ m.role }}<|text|>{{ m.text }}</s>{% endif %}"
    "{% endfor %}"
)

_ANY_CONTROL = "|".join(map(re.escape, CONTROLS))
_ESCAPE = re.compile(rf"\\|(?=(?:{_ANY_CONTROL}))(.)", re.DOTALL)
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


# --- syntax -----------------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(r"\s*('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|\d+|[A-Za-z_]\w*|==|!=|[.+()|])")
_NAMES = {("m", "role"), ("m", "text"), ("loop", "index0"), ("loop", "first")}


class TemplateError(ValueError):
    """The template does not belong to the language."""


class _Expression:
    """or > and > not > comparison > sum > filter, as nested tuples; constants are folded."""

    def __init__(self, source: str, loop_name: str | None):
        self.loop_name, self.tokens, at = loop_name, [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append(m[1])
            at = m.end()
        self.at = 0

    def parse(self):
        out = self._or()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at]!r}")
        return out

    def _peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def _take(self, *wanted):
        if self._peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1]
        return None

    def _chain(self, part, *operators):
        out = part()
        while op := self._take(*operators):
            out = _fold((op, out, part()))
        return out

    def _or(self):
        return self._chain(self._and, "or")

    def _and(self):
        return self._chain(self._not, "and")

    def _not(self):
        return _fold(("not", self._not())) if self._take("not") else self._compare()

    def _compare(self):
        return self._chain(self._sum, "==", "!=")

    def _sum(self):
        return self._chain(self._filtered, "+")

    def _filtered(self):
        out = self._atom()
        while self._take("|"):
            name = self._take("upper", "lower", "trim")
            if not name:
                raise TemplateError(f"no filter {self._peek()!r}")
            out = _fold((name, out))
        return out

    def _atom(self):
        token = self._peek()
        if token is None:
            raise TemplateError("an expression ends early")
        self.at += 1
        if token == "(":
            out = self._or()
            if not self._take(")"):
                raise TemplateError("a bracket is open")
            return out
        if token[0] in "'\"":
            return ("const", unescape(token[1:-1]))
        if token.isdigit():
            return ("const", int(token))
        if token in ("true", "false"):
            return ("const", token == "true")
        if self._take("."):
            name = ("m" if token == self.loop_name else token, self._peek())
            self.at += 1
            if self.loop_name and name in _NAMES:
                return ("name", *name)
        raise TemplateError(f"no name {token!r} here")


_OPERATIONS: dict[str, Callable] = {
    "or": lambda a, b: a or b,
    "and": lambda a, b: a and b,
    "not": lambda a: not a,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "+": lambda a, b: f"{a}{b}" if isinstance(a, str) or isinstance(b, str) else a + b,
    "upper": lambda a: str(a).upper(),
    "lower": lambda a: str(a).lower(),
    "trim": lambda a: str(a).strip(),
}


def _fold(node):
    if all(x[0] == "const" for x in node[1:]):
        return ("const", _OPERATIONS[node[0]](*[x[1] for x in node[1:]]))
    return node


def _parse(source: str) -> tuple[list, list, list]:
    """Nodes before the loop over messages, inside it, and after it."""
    parts, at = [], 0
    for m in _TAG.finditer(source):
        parts += [("text", source[at : m.start()]), ("write", m[1]) if m[1] is not None else ("tag", m[2].strip())]
        at = m.end()
    parts = [p for p in [*parts, ("text", source[at:])] if p != ("text", "")]
    parts.reverse()
    loop_name: str | None = None

    def block(*ends: str) -> tuple[list, str]:
        nonlocal loop_name
        out: list = []
        while parts:
            kind, body = parts.pop()
            word = body.split(None, 1)[0] if kind == "tag" and body else ""
            if kind == "text":
                out.append(("text", body))
            elif kind == "write":
                value = _Expression(body, loop_name).parse()
                out.append(("text", str(value[1])) if value[0] == "const" else ("write", value))
            elif word in ends:
                return out, body
            elif word == "if":
                out += branch(body[2:])
            elif word == "generation" and loop_name:
                inner, _ = block("endgeneration")
                out.append(("generation", inner))
            elif word == "for" and not ends and loop_name is None:
                m = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", body)
                if not m:
                    raise TemplateError(f"only a loop over messages: {body!r}")
                loop_name = m[1]
                inner, _ = block("endfor")
                loop_name = None
                out.append(("loop", inner))
            else:
                raise TemplateError(f"unexpected tag {body!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return out, ""

    def branch(condition: str) -> list:
        test = _Expression(condition, loop_name).parse()
        yes, end = block("elif", "else", "endif")
        no: list = []
        if end.startswith("elif"):
            no = branch(end[4:])
        elif end == "else":
            no, _ = block("endif")
        if test[0] == "const":
            return yes if test[1] else no
        return [("if", test, yes, no)]

    nodes, _ = block()
    loops = [i for i, n in enumerate(nodes) if n[0] == "loop"]
    if len(loops) != 1:
        raise TemplateError("one loop over messages is needed")
    k = loops[0]
    return nodes[:k], nodes[k][1], nodes[k + 1 :]


# --- code -------------------------------------------------------------------


class _Sink:
    def __init__(self):
        self.parts, self.length, self.spans = [], 0, []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _value(node) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda env, v=node[1]: v
    if kind == "name":
        return lambda env, k=node[1:]: env[k]
    operation, parts = _OPERATIONS[kind], [_value(x) for x in node[1:]]
    if len(parts) == 1:
        return lambda env, a=parts[0]: operation(a(env))
    return lambda env, a=parts[0], b=parts[1]: operation(a(env), b(env))


def _code(nodes: list) -> Callable[[dict, _Sink], None]:
    steps = []
    for node in nodes:
        if node[0] == "text":
            steps.append(lambda env, out, text=node[1]: out.write(text))
        elif node[0] == "write":
            steps.append(lambda env, out, v=_value(node[1]): out.write(escape(str(v(env)))))
        elif node[0] == "if":
            test, yes, no = _value(node[1]), _code(node[2]), _code(node[3])
            steps.append(lambda env, out, test=test, yes=yes, no=no: (yes if test(env) else no)(env, out))
        else:

            def generation(env, out, inner=_code(node[1])):
                begin = out.length
                inner(env, out)
                out.spans.append((begin, out.length))

            steps.append(generation)

    def run(env: dict, out: _Sink) -> None:
        for step in steps:
            step(env, out)

    return run


class Program:
    """A compiled template: ``before``, ``turn`` for each message, ``after``."""

    def __init__(self, source: str = TEMPLATE):
        head, body, tail = _parse(source)
        self._head, self._body, self._tail = _code(head), _code(body), _code(tail)

    def before(self) -> str:
        return self._outside(self._head)

    def after(self) -> str:
        return self._outside(self._tail)

    @staticmethod
    def _outside(code) -> str:
        out = _Sink()
        code({}, out)
        return "".join(out.parts)

    def turn(self, index: int, role: str, text: str) -> tuple[str, list[tuple[int, int]]]:
        """The text of one message and its spans to learn, in code points."""
        out = _Sink()
        env = {("m", "role"): role, ("m", "text"): text, ("loop", "index0"): index, ("loop", "first"): index == 0}
        self._body(env, out)
        return "".join(out.parts), out.spans


_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<\|role\|>(?P<role>.*?)<\|text\|>(?P<text>.*?)</s>|(?P<assistant>.*?)</s>",
    re.DOTALL,
)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of all turns of output of the default template."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError("not output of the default template")
        at = m.end()
        if m["user"] is not None:
            turns.append(("user", unescape(m["user"])))
        elif m["role"] is not None:
            turns.append((unescape(m["role"]), unescape(m["text"])))
        else:
            turns.append(("assistant", unescape(m["assistant"])))
    return turns


# --- Spark ------------------------------------------------------------------


_KEYS = ["conv_id", "turn", "role", "text"]
#: Bounds between ranges of rows are drawn from so many characters of a text.
_BOUND_CHARS = 64
#: Copies of a row are made in blocks of so many.
_COPIES = 100_000


def _turns(conversations: DataFrame) -> DataFrame:
    columns = [F.col(c).cast("long").alias(c) for c in _KEYS[:2]]
    return conversations.select(*columns, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in _KEYS[2:]])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema)], schema=schema)
            block = []
    if block:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema)], schema=schema)


def _numbered(turns: DataFrame) -> DataFrame:
    """Rows in ranges by conversation and turn, numbered within their range.

    Equal rows are one with their number ``n``.  ``local`` counts a conversation's
    turns before the row in its range; ``first``: the range begins with its
    conversation; ``ends``: no row of its conversation follows in the range;
    ``final``: nothing at all follows there.
    """
    counted = turns.groupBy(*_KEYS).agg(F.count("*").alias("n"))
    bounds = ["conv_id", "turn", *[F.substring(c, 1, _BOUND_CHARS) for c in _KEYS[2:]]]
    rows = counted.repartitionByRange(*bounds).sortWithinPartitions(*_KEYS)
    rows = rows.select(F.spark_partition_id().alias("part"), "conv_id", "role", "text", "n")
    schema = pa.schema(
        [("part", pa.int32()), ("conv_id", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n", pa.int64()),
         ("local", pa.int64()), ("first", pa.bool_()), ("ends", pa.bool_()), ("final", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def numbered():
            waiting, local, first = None, 0, True
            for row in _rows(batches):
                if waiting is not None:
                    other = waiting[1] != row[1]
                    yield (*waiting, local, first, other, False)
                    local, first = (0, False) if other else (local + waiting[4], first)
                waiting = row
            if waiting is not None:
                yield (*waiting, local, first, True, True)

        yield from _batched(numbered(), schema)

    return rows.mapInArrow(run, "part int, conv_id long, role string, text string, n long, local long, first boolean, ends boolean, final boolean")


def _carried(rows: DataFrame) -> dict[int, tuple[int, bool]]:
    """For each range: turns of its first conversation in ranges before it, and whether its last one goes on.

    One row for each range comes to the driver.
    """
    last = F.max(F.when(F.col("final"), F.struct("conv_id", (F.col("local") + F.col("n")).alias("turns"))))
    begun = F.max(F.when(F.col("first"), F.struct("conv_id")))
    ranges = rows.groupBy("part").agg(begun.alias("begun"), last.alias("last")).collect()
    out: dict[int, tuple[int, bool]] = {}
    before, turns = None, 0
    for r in sorted(ranges, key=lambda r: r.part):
        goes_on = before is not None and before.last.conv_id == r.begun.conv_id
        if goes_on:
            out[before.part] = (out[before.part][0], True)
        out[r.part] = (turns if goes_on else 0, False)
        turns = r.last.turns + (out[r.part][0] if r.last.conv_id == r.begun.conv_id else 0)
        before = r
    return out


def format_turns(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per turn: conv_id, ``place`` from 0, ``formatted`` and ``learn`` (spans in it).

    A conversation's output is its rows' ``formatted`` in order of place.  Rows
    go by turn, then role and text; equal rows are each a turn.  A null role or
    text is empty; rows without a conv_id are one conversation; no rows, no
    result.  Columns other than conv_id, turn, role and text are not read.  Text
    outside the template's loop goes with the first turn if it stands before,
    else with the last.

    A conversation may be cut into ranges of turns, which are numbered by
    themselves; what ranges before it held is added to each.
    """
    program = Program(template)
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("formatted", pa.string()), ("learn", pa.list_(pa.list_(pa.int64())))])
    rows = stage(_numbered(_turns(conversations)), "turns")
    carried = _carried(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns():
            for part, conv, role, text, n, local, first, ends, final, copy in _rows(batches):
                before, goes_on = carried[part]
                place = local + copy + (before if first else 0)
                piece, spans = program.turn(place, role, text)
                lead = program.before() if place == 0 else ""
                tail = program.after() if copy == n - 1 and ends and not (final and goes_on) else ""
                yield conv, place, lead + piece + tail, [[a + len(lead), b + len(lead)] for a, b in spans]

        yield from _batched(turns(), schema)

    blocks = rows.withColumn("block", F.explode(F.expr(f"sequence(0L, n - 1, {_COPIES}L)")))
    copies = F.explode(F.expr(f"sequence(block, least(n, block + {_COPIES}L) - 1)"))
    rows = blocks.select(*rows.columns, copies.alias("copy"))
    return rows.mapInArrow(run, "conv_id long, place long, formatted string, learn array<array<long>>")


@dataclass
class _Digest:
    conv: int | None
    turns: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)
    n: int = 0
    loss_chars: int = 0
    chars: int = 0

    def add(self, role: str, text: str, chars: int, learned: str | None) -> None:
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n += 1
        if learned is not None:
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += chars

    def row(self) -> tuple:
        return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row formatted in the default template, and what its output says.

    ``learned`` is the text to learn, null if there is none or if it is the
    turn's text, which ``whole`` tells.
    """
    program = Program(TEMPLATE)
    schema = pa.schema(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
         ("chars", pa.int64()), ("whole", pa.bool_()), ("learned", pa.string())]
    )

    def turns():
        for conv, turn, role, text in _rows(batches):
            # The default template asks for no place.
            piece, spans = program.turn(0, role, text)
            ((role, text),) = read_back(piece)
            learned = "".join(unescape(piece[a:b]) for a, b in spans) if spans else None
            whole = learned == text
            yield conv, turn, role, text, len(piece), whole, None if whole else learned

    yield from _batched(turns(), schema)


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """One row per conversation of what is read back from its output in the default template.

    conv_id, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``,
    ``formatted_chars``.  Nulls and ties as in ``format_turns``; no rows, no result.

    Rows are formatted and read back where they lie.  A digest has to see its
    turns in order, so a conversation's rows pass through one task, which only
    hashes; none is held beyond the row at hand.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations_of():
            own = None
            for conv, _, role, text, chars, whole, learned in _rows(batches):
                if own is None or own.conv != conv:
                    if own is not None:
                        yield own.row()
                    own = _Digest(conv)
                own.add(role, text, chars, text if whole else learned)
            if own is not None:
                yield own.row()

        yield from _batched(conversations_of(), schema)

    read = "conv_id long, turn long, role string, text string, chars long, whole boolean, learned string"
    rows = _turns(conversations).mapInArrow(_read_back, read)
    return rows.repartition("conv_id").sortWithinPartitions(*_KEYS).mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
