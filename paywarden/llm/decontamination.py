"""Documents that hold a benchmark item, up to a few edits.

An item of m characters may differ in k = 5 % of them.  Cut into k + 1 pieces,
at least one piece is met unchanged (the pigeonhole principle).  An automaton
finds all pieces; around each hit the item's edit distance to the best run of
the text is taken by Myers' bit-parallel method.  An item under SHORT_CHARS has
no budget: it is met as whole words, unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from paywarden.llm import words as w

ERROR_RATE = 0.05
#: Shorter items have an error budget of 0 and must stand between word bounds.
SHORT_CHARS = 24
#: Least characters of an item to be searched, if a caller does not say otherwise:
#: shorter ones are phrases that many clean texts hold, and no evidence of a leak.
LEAST_CHARS = 24
#: Items are searched in blocks of about so many characters, which bounds what is sent.
BLOCK_CHARS = 4_000_000
_WORD = re.compile(r"\w+")


def plain(text: str) -> str:
    return " ".join(_WORD.findall(text)).lower()


def pieces(item: str) -> list[tuple[int, str]]:
    """The error budget plus one pieces, with their offsets."""
    if len(item) < SHORT_CHARS:
        return [(-1, f" {item} ")]
    n = int(len(item) * ERROR_RATE) + 1
    edges = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def nearest(item: str, text: str) -> tuple[int, int]:
    """(distance, end) of the run of ``text`` that is nearest to ``item``; the first of equals."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, ch in enumerate(item):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, ch in enumerate(text):
        eq = masks.get(ch, 0)
        x = eq | minus
        d = (((eq & plus) + plus) ^ plus) | eq
        h_plus = minus | ~(d | plus) & full
        h_minus = plus & d
        if h_plus & top:
            score += 1
        elif h_minus & top:
            score -= 1
        h_plus = h_plus << 1 & full  # a run may begin anywhere
        h_minus = h_minus << 1 & full
        plus = h_minus | ~(x | h_plus) & full
        minus = h_plus & x
        if score < best:
            best, end = score, j + 1
    return best, end


class Items:
    """The items of one block; the automaton is made once in each process."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.rows = rows
        self._automaton = None

    def __getstate__(self):
        return {"rows": self.rows, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            by_piece: dict[str, list[tuple[int, int]]] = {}
            for number, (_, item) in enumerate(self.rows):
                for offset, piece in pieces(item):
                    by_piece.setdefault(piece, []).append((number, offset))
            self._automaton = ahocorasick.Automaton()
            for piece, owners in by_piece.items():
                self._automaton.add_word(piece, (len(piece), owners))
            self._automaton.make_automaton()
        return self._automaton

    def found(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, distance, end in ``text``): the nearest run for each item found."""
        best: dict[int, tuple[int, int]] = {}
        seen: set[tuple[int, int]] = set()
        # A space on both sides lets word bounds be part of a piece.
        for last, (length, owners) in self.automaton().iter(f" {text} "):
            for number, offset in owners:
                item = self.rows[number][1]
                begin = last - length - offset
                if number in best and best[number][0] == 0:
                    continue
                if begin >= 0 and text.startswith(item, begin):
                    best[number] = (0, begin + len(item))
                    continue
                # Hits of one occurrence lie on near diagonals; one window serves a band of them.
                budget = int(len(item) * ERROR_RATE)
                band = begin // (budget + 1)
                if (number, band) in seen:
                    continue
                seen.add((number, band))
                low = max(0, band * (budget + 1) - budget)
                high = band * (budget + 1) + 3 * budget + len(item)
                distance, end = nearest(item, text[low : max(high, 0)])
                if distance <= budget and distance < best.get(number, (1 << 60, 0))[0]:
                    best[number] = (distance, low + end)
        return [(self.rows[number][0], d, end) for number, (d, end) in sorted(best.items())]


def _blocks(items: DataFrame, id_col: str, text_col: str, least_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Usable items, a bounded number of characters at a time."""
    block, size = [], 0
    for item_id, text in items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        own = plain(text or "")
        if item_id is None or len(own) < max(1, least_chars):
            continue
        block.append((item_id, own))
        size += len(own)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """One row per document and item that it holds: id, ``item_id``, ``distance``, ``end_char``.

    Text is compared as its words in lower case, one space between them;
    ``end_char`` is where the nearest run ends in that form.  Items of at least
    ``least_chars`` characters in that form are searched, with 1 all of them;
    those under SHORT_CHARS are found as whole words without any edit.  Items
    without a word or an id are never found, null and empty documents hold
    none.  Other columns are not read.  Items with equal texts are each reported, repeated rows as well.
    Every text is searched whole.  A document's id may be a struct.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    kind = kind.simpleString() if isinstance(kind, StructType) else "long"
    rows = docs.select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, item_id long, distance int, end_char long"
    out = None
    for block in _blocks(items, item_id_col, item_text_col, least_chars):
        shared = spark.sparkContext.broadcast(Items(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in w.chunks(batches, "text"):
                hits = [
                    (i, *hit)
                    for i, text in enumerate(batch.column("text").to_pylist())
                    if text
                    for hit in shared.value.found(plain(text))
                ]
                if hits:
                    i, item, distance, end = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(i)), pa.array(item, pa.int64()), pa.array(distance, pa.int32()), pa.array(end, pa.int64())],
                        ["id", "item_id", "distance", "end_char"],
                    )

        own = rows.mapInArrow(run, schema)
        out = own if out is None else out.union(own)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.withColumnRenamed("id", id_col)
