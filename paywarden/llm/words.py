"""Words of many texts at once, as numpy arrays over one byte buffer.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return.  Words never cross texts.  Names of words and of
word sequences are 64-bit hashes that depend on content alone, so every task
gives the same name to the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 1 << 19
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finisher)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A name for the ordered pair of two names."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ np.uint64(0xA0761D6478BD642F)))


@dataclass
class Words:
    """The words of a run of texts: text i has words first[i]:first[i + 1]."""

    data: np.ndarray  # all bytes
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def names(self, seed: int = 0) -> np.ndarray:
        """A 64-bit name for each word; each distinct word is hashed once."""
        n = len(self.start)
        if not n:
            return np.zeros(0, np.uint64)
        # Words follow one another once the space between them is gone.
        ends = np.zeros(n + 1, np.int64)
        np.cumsum(self.end - self.start, out=ends[1:])
        packed = self.data[~_IS_SPACE[self.data]]
        parts = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(packed))]
        coded = pa.Array.from_buffers(pa.large_binary(), n, parts).dictionary_encode()
        _, ends, data = coded.dictionary.buffers()
        ends = np.frombuffer(ends, np.int64)[: len(coded.dictionary) + 1].tolist()
        data, digest = memoryview(data), xxhash.xxh3_64_intdigest
        named = np.fromiter((digest(data[a:b], seed) for a, b in zip(ends, ends[1:])), np.uint64, len(ends) - 1)
        return named[np.asarray(coded.indices)]

    def windows(self, names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of all runs of ``size`` words, with the index of their first word."""
        n = len(names) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.whole(size))
        out = np.full(len(at), size, np.uint64)
        for k in range(size):
            out = combine(out, names[at + k])
        return out, at

    def whole(self, size: int) -> np.ndarray:
        """For each place up to the last window of all: does it stay in its text?"""
        text = self.text_of()
        n = len(text) - size + 1
        return text[:n] == text[size - 1 :] if n > 0 else np.zeros(0, bool)


def cut(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Find the words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
    end = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
    return Words(data, start, end, np.searchsorted(start, offsets))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about CHUNK_BYTES of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.string())), 0)
        part = np.cumsum(np.asarray(sizes, np.int64)) // CHUNK_BYTES
        edges = np.flatnonzero(np.diff(part)) + 1
        begin = 0
        for end in [*edges.tolist(), batch.num_rows]:
            yield batch.slice(begin, end - begin)
            begin = end


def words_of(batch: pa.RecordBatch, text: str, lower: bool = False) -> Words:
    data, offsets = buffers(batch.column(text))
    if lower:
        data = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    return cut(data, offsets)
