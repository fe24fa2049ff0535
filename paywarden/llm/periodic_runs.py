"""Stretches of a text that repeat with a period, by recursive frequency splitting.

In a run of period q every word comes back q words later or stood there q words
before, so each word of a run occurs at least twice in it.  A word that occurs
once in its segment is in no run and splits the segment; what is left of the
parts is judged anew until nothing changes.  The segments that survive are
scanned by lag.

Small lags are compared directly.  Beyond, lags go by octaves: in a run whose
period is in [2 s, 4 s) some window of s words that starts at a multiple of s
recurs one period later.  Windows have exact names (ranks of pairs of names of
half the size), so a recurrence is looked up by name and extended to both sides
by names of falling sizes.  A segment of n words costs about n log^2 n, also if
it is one word over and over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywarden.llm import words as w

#: A run has at least so many words, and at least two periods.
LEAST_WORDS = 12
#: Lags below are compared one by one.
_SMALL = 16

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # first word, end, period


def surviving(ids: np.ndarray, text: np.ndarray, least: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that may be in a run, and the segment of each.

    ``ids`` are the words of all texts, ``text`` tells whose each is.
    """
    at, segment = np.arange(len(ids)), text
    while len(at):
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (segment[1:] != segment[:-1])
        own = np.cumsum(new) - 1
        key = own * (int(ids.max()) + 1) + ids[at]
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        keep = (count[back] > 1) & (np.bincount(own)[own] >= least)
        if keep.all():
            return at, own
        at, segment = at[keep], own[keep]
    return at, segment


class _Names:
    """Exact names of all windows of 1, 2, 4 ... elements."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.levels = [symbols]
        size = 1
        while 2 * size <= longest:
            half = self.levels[-1]
            a, b = half[:-size], half[size:]
            _, name = np.unique(a * (int(half.max()) + 1) + b, return_inverse=True)
            self.levels.append(name)
            size *= 2

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many elements from i on equal those from j on; i < j."""
        same = np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            # Twice, as sizes above the largest level are not named.
            for _ in range(2 if level < len(self.levels) - 1 else len(self.levels[0]) >> level):
                if not self._grow(level, i + same, j + same, same, 1 << level):
                    break
        return same

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many elements before i equal those before j."""
        same = np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            size = 1 << level
            for _ in range(2 if level < len(self.levels) - 1 else len(self.levels[0]) >> level):
                if not self._grow(level, i - same - size, j - same - size, same, size):
                    break
        return same

    def _grow(self, level: int, i: np.ndarray, j: np.ndarray, same: np.ndarray, size: int) -> bool:
        names = self.levels[level]
        inside = (i >= 0) & (j < len(names))
        hit = inside.copy()
        hit[inside] = names[i[inside]] == names[j[inside]]
        same[hit] += size
        return bool(hit.any())


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and end of each run of true values with at least so many."""
    edge = np.diff(np.concatenate([[0], equal.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - begin >= least
    return begin[long], end[long]


def _scan(symbols: np.ndarray, longest: int, least: int) -> Runs:
    """All maximal stretches with a lag, for lags up to half the longest segment."""
    begins, ends, lags = [], [], []

    def add(begin: np.ndarray, end: np.ndarray, lag) -> None:
        begins.append(begin)
        ends.append(end)
        lags.append(np.broadcast_to(lag, begin.shape))

    for lag in range(1, min(_SMALL, longest // 2 + 1)):
        begin, end = _stretches(symbols[:-lag] == symbols[lag:], max(least - lag, lag))
        add(begin, end + lag, lag)
    if longest // 2 >= _SMALL:
        names = _Names(symbols, longest)
        size = _SMALL // 2
        while 2 * size <= longest // 2:
            begin, lag = _recurrences(names.levels[size.bit_length() - 1], size)
            before, after = names.left(begin, begin + lag), names.right(begin, begin + lag)
            begin, end = begin - before, begin + after + lag
            run = end - begin >= np.maximum(2 * lag, least)
            add(begin[run], end[run], lag[run])
            size *= 2
    if not begins:
        none = np.zeros(0, np.int64)
        return none, none, none
    begin, end, lag = (np.concatenate(x).astype(np.int64) for x in (begins, ends, lags))
    # Multiples of a period span just the same words: the smallest is the period.
    order = np.lexsort((lag, end, begin))
    begin, end, lag = begin[order], end[order], lag[order]
    first = np.ones(len(begin), bool)
    first[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    return begin[first], end[first], lag[first]


def _recurrences(names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows at multiples of ``size`` that recur 2 to 4 sizes later: place and lag."""
    order = np.lexsort((np.arange(len(names)), names))
    anchors = np.arange(0, len(names), size)
    key = names.astype(np.int64) * (len(names) + 4 * size + 1)
    ranked = key[order] + order
    low = np.searchsorted(ranked, key[anchors] + anchors + 2 * size)
    high = np.searchsorted(ranked, key[anchors] + anchors + 4 * size)
    n = high - low
    begin = np.repeat(anchors, n)
    place = np.arange(len(begin)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    return begin, order[place] - begin


def find_runs(ids: np.ndarray, text: np.ndarray, least: int = LEAST_WORDS) -> Runs:
    """Runs of the texts whose words follow one another in ``ids``, by first word."""
    at, segment = surviving(ids, text, least)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none
    # A symbol of its own between segments keeps stretches inside.
    shift = np.arange(len(at)) + segment
    symbols = np.empty(len(at) + int(segment[-1]), np.int64)
    top = int(ids.max()) + 1
    symbols[:] = np.arange(top, top + len(symbols))
    symbols[shift] = ids[at]
    # Small numbers keep pairs of names within 64 bits.
    symbols = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    begin, end, lag = _scan(symbols, int(np.bincount(segment).max()), least)
    place = np.zeros(len(symbols), np.int64)
    place[shift] = at
    return place[begin], place[end - 1] + 1, lag


RUN_SCHEMA = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _run_batch(least: int, prepare: Callable | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.chunks(batches, "text"):
            texts = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
            if prepare is not None:
                texts = [prepare(i, t) for i, t in zip(batch.column("id").to_pylist(), texts)]
            counts = np.array([len(t) for t in texts], np.int64)
            first = np.concatenate([[0], np.cumsum(counts)])
            flat = pa.array([x for t in texts for x in t], pa.binary()).dictionary_encode()
            ids = np.asarray(flat.indices, np.int64)
            text = np.repeat(np.arange(len(texts)), counts)
            begin, end, period = find_runs(ids, text, least)
            owner = text[begin] if len(begin) else begin
            gone = np.zeros(len(ids) + 1, np.int64)
            np.add.at(gone, begin + period, 1)
            np.add.at(gone, end, -1)
            gone = np.cumsum(gone[:-1]) > 0
            edges = np.searchsorted(owner, np.arange(len(texts) + 1))
            changed = np.unique(owner).tolist()
            kept = [b" ".join(t) for t in texts]
            for i in changed:
                stay = ~gone[first[i] : first[i + 1]]
                kept[i] = b" ".join([texts[i][k] for k in np.flatnonzero(stay).tolist()])
            fields = [begin - first[owner], end - begin, period]
            runs = pa.ListArray.from_arrays(
                pa.array(edges.astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(f.astype(np.int64)) for f in fields], ["start", "length", "period"]),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts), runs, pa.array([k.decode() for k in kept], pa.string())],
                ["id", "n_words", "runs", "collapsed"],
            )

    return run


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_WORDS,
    prepare: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``runs`` and ``collapsed`` text.

    A run is a stretch of consecutive words with smallest period q (words q
    apart are identical) of at least ``least`` and of at least 2 q words that
    neither neighbour extends.  ``runs`` has start (word number from 0), length
    and period, by start, then length.  ``collapsed`` is the text without the
    words that some run contains after its first q ones, joined by one space.
    Words are runs of non-blank bytes.  ``prepare`` may change a text's words
    by its id before they are looked at.

    Null and empty texts have no words and no runs.  Rows are judged one by
    one, whatever their ids; repeated rows and null ids are kept as they are.
    Other columns are not read.  No row is shuffled; a task holds the words of
    half a megabyte of text, or of one text, with a name for each word and
    power of two up to the longest segment.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_run_batch(least, prepare), f"id {kind}, n_words long, runs {RUN_SCHEMA}, collapsed string")
    return out.withColumnRenamed("id", id_col)
