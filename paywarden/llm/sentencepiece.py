"""Encode text into pieces by the best path through a double-array trie, and back.

Spaces become a marker, one marker is put in front, and the path of pieces with
the greatest sum of log scores is taken.  No piece crosses from a text character
to a following marker, so each run of markers with the word behind it has its
own best path, which is remembered while a task runs.

A vocabulary of merges has ranks where a unigram one has log probabilities.  A
piece's log score is then that of its rank in the law of Zipf and Mandelbrot,
-log(rank + MANDELBROT), less the log of the sum over all pieces.  Nothing is
trained, and no corpus is read for it.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywarden.llm import words as w

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_MARK = "▁"
_SEGMENT = re.compile(" *[^ ]+| +")
_REMEMBERED = 200_000
_TRIES = 40
#: Offset of ranks, the usual value for words.
MANDELBROT = 2.7


class DoubleArray:
    """A trie in two arrays: from a node, character c leads to base[node] + c."""

    def __init__(self, pieces: dict[str, int]):
        counts: dict[str, int] = {}
        for piece in pieces:
            for ch in piece:
                counts[ch] = counts.get(ch, 0) + 1
        # Frequent characters get small codes, which keeps the arrays dense.
        self.codes = {ch: i + 1 for i, ch in enumerate(sorted(counts, key=lambda ch: (-counts[ch], ch)))}
        self.base, self.check, self.value = [0], [-1], [-1]
        keys = sorted((tuple(self.codes[ch] for ch in p), v) for p, v in pieces.items())
        todo, free = [(0, 0, 0, len(keys))], 1
        while todo:
            node, depth, lo, hi = todo.pop()
            if lo < hi and len(keys[lo][0]) == depth:
                self.value[node] = keys[lo][1]
                lo += 1
            children = []
            while lo < hi:
                code, begin = keys[lo][0][depth], lo
                while lo < hi and keys[lo][0][depth] == code:
                    lo += 1
                children.append((code, begin, lo))
            if not children:
                continue
            while free < len(self.check) and self.check[free] >= 0:
                free += 1
            # A few places from the first gap on are tried; behind the end all is free.
            place = max(1, free - children[0][0])
            for _ in range(_TRIES):
                if all(place + c >= len(self.check) or self.check[place + c] < 0 for c, _, _ in children):
                    break
                place += 1
            else:
                place = max(1, len(self.check) - children[0][0])
            more = place + children[-1][0] + 1 - len(self.check)
            if more > 0:
                self.base += [0] * more
                self.check += [-1] * more
                self.value += [-1] * more
            self.base[node] = place
            for code, begin, end in children:
                self.check[place + code] = node
                todo.append((place + code, depth + 1, begin, end))


def log_scores(scores: list[float], ordinary: list[bool]) -> list[float]:
    """The log probability of each ordinary piece by the rank of its score; 0 for the others.

    The greatest score has rank 1, and of equal scores the piece that comes first.
    """
    ranked = sorted((i for i, own in enumerate(ordinary) if own), key=lambda i: (-scores[i], i))
    logs = -np.log(np.arange(1, len(ranked) + 1) + MANDELBROT)
    out = np.zeros(len(scores))
    out[ranked] = logs - np.log(np.exp(logs).sum())
    return out.tolist()


class Pieces:
    """Pieces with scores, and what encoding and decoding need of them."""

    def __init__(self, pieces: list[str], scores: list[float], ordinary: list[bool], byte_ids: list[int]):
        self.scores, self.byte_ids, self._encoder, self._table = scores, byte_ids, None, None
        own = {p: i for i, p in enumerate(pieces) if ordinary[i]}
        if any(_MARK in p.lstrip(_MARK) for p in own):
            raise ValueError("a piece holds a marker after text")
        self.trie = DoubleArray(own)
        self.unknown = min(scores[i] for i in own.values()) - 10
        raw = {i: bytes([b]) for b, i in enumerate(byte_ids)}
        plain = [p.replace(_MARK, " ").encode() if ordinary[i] else b"" for i, p in enumerate(pieces)]
        self.bytes = [raw.get(i, b) for i, b in enumerate(plain)]

    def encoder(self) -> _Encoder:
        """One for each Python process, so that its tasks share what is remembered."""
        if self._encoder is None:
            self._encoder = _Encoder(self)
        return self._encoder

    def __getstate__(self):
        return self.__dict__ | {"_encoder": None, "_table": None}

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        names = [model.id_to_piece(i) for i in ids]
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        ordinary, scores = [not s for s in special], [model.get_score(i) for i in ids]
        # Log probabilities fall short of 1 when summed up; ranks do not come near it.
        likely = sum(np.exp(s) for s, own in zip(scores, ordinary) if own)
        if not 0.5 < likely < 1.5:
            scores = log_scores(scores, ordinary)
        return cls(names, scores, ordinary, byte_ids)

    def best(self, segment: str) -> list[int]:
        """The best path; of equal ones the one whose last piece starts first."""
        codes, base, check, value = self.trie.codes, self.trie.base, self.trie.check, self.trie.value
        scores, unknown = self.scores, self.unknown
        n, size = len(segment), len(check)
        # A space is looked up as the marker; a marker in the text is not a piece.
        at = [codes.get(_MARK, 0) if ch == " " else 0 if ch == _MARK else codes.get(ch, 0) for ch in segment]
        score, back = [float("-inf")] * (n + 1), [(0, -1)] * (n + 1)
        score[0] = 0.0
        for i in range(n):
            node, here, single = 0, score[i], False
            for j in range(i, n):
                if not at[j]:
                    break
                nxt = base[node] + at[j]
                if nxt >= size or check[nxt] != node:
                    break
                node = nxt
                piece = value[node]
                if piece >= 0:
                    single |= j == i
                    s = here + scores[piece]
                    if s > score[j + 1]:
                        score[j + 1], back[j + 1] = s, (i, piece)
            if not single and here + unknown > score[i + 1]:
                score[i + 1], back[i + 1] = here + unknown, (i, -1)
        out: list[int] = []
        while n:
            i, piece = back[n]
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.byte_ids[b] for b in reversed(segment[i:n].encode())]
            n = i
        return out[::-1]

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, one after another, and where each id's begin."""
        if self._table is None:
            ends = np.cumsum([0, *map(len, self.bytes)])
            self._table = np.frombuffer(b"".join(self.bytes), np.uint8), ends[:-1], np.diff(ends)
        data, start, size = self._table
        length = size[ids]
        begin = np.concatenate([[0], np.cumsum(length)])
        at = np.repeat(start[ids] - begin[:-1], length) + np.arange(begin[-1])
        return data[at], begin

    def round_trips(self, texts: list[str], flat: np.ndarray, first: np.ndarray) -> list[bool]:
        """Does decoding give each text back?  Bytes that differ are decoded to see."""
        data, begin = self.joined(flat)
        data, begin = data.tobytes(), begin[first].tolist()
        out = []
        for i, text in enumerate(texts):
            own = data[begin[i] : begin[i + 1]]
            same = own == b" " + text.encode() if text else not own
            out.append(same or self.decode(flat[first[i] : first[i + 1]].tolist()) == text)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids; markers become spaces, the first one goes, broken bytes become U+FFFD."""
        text = b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class _Encoder(dict):
    """Remembers segments' ids, as bytes: the newest, and the ones before them."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.before = pieces, {}

    def __missing__(self, segment: str) -> bytes:
        ids = self.before.get(segment)
        if ids is None:
            ids = array("i", self.pieces.best(segment)).tobytes()
        if len(segment) < 64:
            if len(self) >= _REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[segment] = ids
        return ids

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        return np.frombuffer(b"".join(map(self.__getitem__, _SEGMENT.findall(" " + text))), np.int32)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """One row per input row: id, ``ids`` (array of int), ``n_tokens``, ``n_bytes``, ``round_trip``.

    Characters that no piece holds, and markers in the text itself, become byte
    pieces, counted by ``n_bytes``; ``round_trip`` tells whether decoding gives
    the text back.  Null and empty texts have no tokens.  Repeated rows are each
    encoded; an empty table has no rows.  Ids must be integers or null; other
    columns, whatever their names, are not read.  The model is read by the driver
    and sent to the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        encoder = pieces.encoder()
        is_byte = np.zeros(len(pieces.bytes), bool)
        is_byte[pieces.byte_ids] = True
        for batch in w.chunks(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [encoder(t) for t in texts]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate([*ids, np.zeros(0, np.int32)])
            same = pieces.round_trips(texts, flat, ends)
            n_bytes = np.diff(np.concatenate([[0], np.cumsum(is_byte[flat])])[ends])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(np.diff(ends).astype(np.int64)), pa.array(n_bytes, pa.int64()), pa.array(same)],
                ["id", "ids", "n_tokens", "n_bytes", "round_trip"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, "id long, ids array<int>, n_tokens long, n_bytes long, round_trip boolean")
    return out.withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """One row per input row: id and ``text``; null ids give null, no ids the empty text."""
    shared = tokens.sparkSession.sparkContext.broadcast(Pieces.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else shared.value.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    rows = tokens.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
