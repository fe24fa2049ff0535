"""Remove long word runs that an earlier document has too, by recompression.

Each text is a sequence of word names.  Rounds shorten it: the first names runs
of one word, the following ones name pairs.  Names come in two kinds, left and
right, by a bit of the name; a left name and the right name after it become
one.  Names are hashes of content, so all tasks agree on them without asking,
and equal word runs get equal symbols except near their ends.  For each symbol
the words that its existence depends on are tracked; a symbol whose words all
lie in a window is the same wherever that window occurs.

A window is looked up by the first of its highest such symbols (or by its own
name if it has none).  Symbols met in one document only are done with after
one count.  Windows around the others are compared across documents by names
of 104 bits, two hashes of all their words' names; each text sends a window
once.  Symbols in very many documents are known
from the aggregation; their windows are dealt out by window and salt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from paywarden.llm import words as w
from paywarden.llm.tables import key_filter, stage

_ROUNDS = 5
#: Symbols of more documents than this share of all rows are salted.
_HOT_SHARE = 1 << 16
_HOT_LEAST = 1000
_SALTS = 64
#: Windows are named by 64 bits and so many more.
_SECOND_BITS = 40


def _rounds(names: np.ndarray, found: w.Words) -> tuple[np.ndarray, int, list]:
    """Symbols after each round, with first and last + 1 word they depend on."""
    texts = len(found.first) - 1
    place = np.arange(len(names)) + found.text_of() + 1
    total = len(names) + texts + 1
    symbol = np.zeros(total, np.uint64)
    symbol[place] = names
    wall = np.ones(total, bool)  # between texts
    wall[place] = False
    again = np.zeros(total, bool)
    again[1:] = (symbol[1:] == symbol[:-1]) & ~wall[1:] & ~wall[:-1]
    begin = np.flatnonzero(~again).astype(np.int32)
    end = np.append(begin[1:], np.int32(total))
    length, symbol, wall = end - begin, symbol[begin], wall[begin]
    symbol = np.where(length > 1, w.combine(symbol, length.astype(np.uint64)), symbol)
    # A run ends where the words beside it differ.
    low, high = begin - 1, end + 1
    out = [(symbol, low, high, wall)]
    for step in range(_ROUNDS):
        left = (w.mix(symbol + np.uint64(step + 7)) & np.uint64(1)).astype(bool)
        right = ~left & ~wall
        left &= ~wall
        pair = np.zeros(len(symbol), bool)
        pair[:-1] = left[:-1] & right[1:]
        second = np.zeros(len(symbol), bool)
        second[1:] = pair[:-1]
        after = np.append(high[1:], np.int32(total + 1))
        before = np.append(np.int32(-1), low[:-1])
        # A left name stays single because of what follows, a right one because of what precedes.
        high = np.where(left, np.maximum(high, after), high)
        low = np.where(right & ~second, np.minimum(low, before), low)
        at = np.flatnonzero(pair)
        symbol = symbol.copy()
        symbol[at] = w.combine(symbol[at], symbol[at + 1])
        keep = ~second
        symbol, low, high, wall = symbol[keep], low[keep], high[keep], wall[keep]
        out.append((symbol, low, high, wall))
    return place, total, out


def window_symbols(found: w.Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each window: its name, the symbol it is looked up by, its text and its first word."""
    names = found.names()
    window, at = found.windows(names, size)
    text = found.text_of()[at] if len(at) else at
    key = window.copy()
    if len(at):
        place, total, rounds = _rounds(names, found)
        first = place[at]
        rest = np.arange(len(at))
        for symbol, low, high, wall in reversed(rounds):
            real = ~wall
            symbol, low, high = symbol[real], low[real], high[real]
            upto = np.cumsum(np.bincount(low + 1, minlength=total + 1))
            own = upto[first[rest]]
            # The first symbol that depends on no word before the window.
            hit = own < len(symbol)
            own = np.minimum(own, len(symbol) - 1)
            hit &= high[own] <= first[rest] + size
            key[rest[hit]] = symbol[own[hit]]
            rest = rest[~hit]
    return window, key, text, at


def _second_names(names: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Names of _SECOND_BITS bits for windows, by another hash of their words' names."""
    out = np.zeros(len(at), np.uint64)
    for k, factor in enumerate(w.mix(np.arange(1, size + 1)) | np.uint64(1)):
        out += names[at + k] * factor
    return w.mix(out) >> np.uint64(64 - _SECOND_BITS)


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Places where a row differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _emit_symbols(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.chunks(batches, "text"):
            _, key, text, _ = window_symbols(w.words_of(batch, "text"), size)
            new = _distinct(key, text)
            key, text = key[new], text[new]
            # Each symbol once for each text.
            order = np.lexsort((key, text))
            key, text = key[order], text[order]
            key = key[_distinct(key, text)]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])

    return run


def _emit_windows(size: int, shared, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.chunks(batches, "text"):
            found = w.words_of(batch, "text")
            window, key, text, at = window_symbols(found, size)
            pick = np.flatnonzero(shared.has(key))
            # Each window once for each text.
            pick = pick[np.argsort(window[pick] ^ w.mix(text[pick]))]
            pick = pick[_distinct(window[pick], text[pick])]
            window, key, text, at = window[pick], key[pick], text[pick], at[pick]
            ids = batch.column("id").take(pa.array(text))
            salt = 1 + w.mix(np.asarray(ids).view(np.uint64)) % np.uint64(_SALTS)
            salt[~np.isin(key, hot.value)] = 0
            second = _second_names(found.names(), at, size)
            mark = (second << np.uint64(8) | salt).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(window.view(np.int64)), pa.array(mark), ids], ["window", "mark", "id"]
            )

    return run


def _pick(touched, wanted: bool):
    """Rows whose id the filter has, or has not; without windows so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spread = np.asarray(batch.column("spread"), np.int64)
            rows = batch.select(["id", "text"]).filter(pa.array(touched.has(spread) == wanted))
            none = pa.nulls(rows.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, none], ["id", "text", "windows"])

    return run


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.chunks(batches, "text"):
            found = w.words_of(batch, "text")
            gone = np.zeros(len(found.start), bool)
            lists = batch.column("windows")
            if lists.null_count < len(lists):
                window, at = found.windows(found.names(), size)
                edges = np.searchsorted(at, found.first)
                for i in np.flatnonzero(np.asarray(lists.is_valid())).tolist():
                    a, b = edges[i], edges[i + 1]
                    listed = np.asarray(lists[i].values, np.int64).view(np.uint64)
                    hit = at[a:b][np.isin(window[a:b], listed)]
                    cover = np.zeros(len(gone) + 1, np.int64)
                    np.add.at(cover, hit, 1)
                    np.add.at(cover, hit + size, -1)
                    lo, hi = found.first[i], found.first[i + 1]
                    gone[lo:hi] = np.cumsum(cover[lo:hi]) > 0
            counts, texts = found.counts(), []
            data, start, end = found.data.tobytes(), found.start.tolist(), found.end.tolist()
            for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
                kept = [data[start[k] : end[k]] for k in range(lo, hi) if not gone[k]]
                texts.append(b" ".join(kept).decode())
            removed = np.add.reduceat(np.append(gone, False).astype(np.int64), found.first[:-1])
            removed[counts == 0] = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts), pa.array(removed), pa.array(texts, pa.string())],
                ["id", "n_words", "n_removed", "kept"],
            )

    return run


def shared_windows(docs: DataFrame, size: int) -> DataFrame:
    """(id, window) for each window that a document with a smaller id has too."""
    spark = docs.sparkSession
    docs = docs.where(F.col("id").isNotNull())
    symbols = docs.mapInArrow(_emit_symbols(size), "key long")
    keys = symbols.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    keys = stage(keys, "symbols")
    n_keys, n_rows = keys.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most _HOT_SHARE symbols can have so many rows.
    limit = max(_HOT_LEAST, n_rows // _HOT_SHARE)
    hot = np.array([r.key for r in keys.where(F.col("n") > limit).collect()], np.int64)
    shared = key_filter(keys, "key", n_keys)
    hot = spark.sparkContext.broadcast(np.sort(hot.view(np.uint64)))
    rows = docs.mapInArrow(_emit_windows(size, shared, hot), "window long, mark long, id long")
    own = Window.partitionBy("window", "mark").orderBy("id")
    rows = rows.withColumn("first", F.first("id").over(own)).where("first < id or (mark & 255) > 0")
    # What is stored has a second name only where it is compared once more.
    second = F.when(F.col("first") == F.col("id"), F.shiftright("mark", 8))
    rows = stage(rows.select("window", "id", second.alias("second")), "windows")
    later = rows.where("second is null").select("id", "window")
    # Of a hot window each salt's first document is left: few rows, compared once more.
    again = Window.partitionBy("window", "second").orderBy("id")
    firsts = rows.where("second is not null").withColumn("first", F.first("id").over(again))
    return later.union(firsts.where("first < id").select("id", "window"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed`` and ``kept`` text.

    A word goes if a window of ``size`` words covers it whose word sequence
    also starts in a document with a smaller id; windows are judged on the
    input.  Kept words are joined by one space.

    Null text and text without words: no words, ``kept`` is empty.  Texts
    shorter than a window lose nothing.  Repeats inside one document stay, and
    rows that share an id do not remove from one another.  Rows with a null id
    neither remove nor lose words.  Other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    gone = shared_windows(docs, size).groupBy("id").agg(F.collect_set("window").alias("windows"))
    gone = stage(gone.withColumn("spread", F.xxhash64("id")), "gone")
    touched = key_filter(gone, "spread", gone.count())
    docs = docs.withColumn("spread", F.xxhash64("id"))
    schema = "id long, n_words long, n_removed long, kept string"
    # Texts that lose nothing are done where they lie; only the others are shuffled.
    pick, cut = _pick(touched, False), _cut(size)
    whole = docs.mapInArrow(lambda batches: cut(pick(batches)), schema)
    some = docs.mapInArrow(_pick(touched, True), "id long, text string, windows array<long>")
    some = some.drop("windows").join(gone.drop("spread"), "id", "left")
    out = whole.union(some.mapInArrow(cut, schema))
    return out.select(F.col("id").cast(kind).alias(id_col), "n_words", "n_removed", "kept")
