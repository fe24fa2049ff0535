"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1.  A run of three letters is bound
into one vector: the product of the letters' vectors, the first one permuted
twice and the second once.  A text's profile is the sum of its runs' vectors,
a language's prototype that of its labelled texts; the nearest prototype by
cosine is the answer.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywarden.llm import words as w

DIMENSIONS = 512
UNKNOWN = "und"
#: Bounds of the table that runs are counted in: texts times characters, and runs at a time.
GROUP_CELLS = 1 << 24
RUN_BLOCK = 1 << 13


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _vectors(points: np.ndarray) -> np.ndarray:
    """The random vectors of code points; the one of a word's edge is 0's."""
    lanes = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    seed = (points.astype(np.uint64)[:, None] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    bits = w.mix(w.mix(seed) + lanes[None, :] * np.uint64(0xD1342543DE82EF95))
    return (np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1)


def _runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The alphabet of some texts, their runs of three as numbers over it, and whose each run is."""
    lowered = [t.lower() for t in texts]
    data = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(texts)), np.array([len(t) + 1 for t in lowered]))
    points = np.where(_letters()[data], data, 0)
    keep = np.ones(len(points), bool)  # one edge between words
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0) | (text[1:] != text[:-1])
    points, text = points[keep], text[keep]
    alphabet, code = np.unique(points, return_inverse=True)
    k = len(alphabet)
    run = (code[:-2] * k + code[1:-1]) * k + code[2:]
    # Within one text, around at least one letter: a run is kept if its middle is one.
    inside = (text[:-2] == text[2:]) & (points[1:-1] != 0)
    # A text's first word has no edge before it; its first two letters still count below.
    return alphabet, run[inside], text[:-2][inside]


def _sums(texts: list[str]) -> np.ndarray:
    """Profiles of texts that are few for their length: their runs are counted in a table."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    alphabet, run, text = _runs(texts)
    k, own = len(alphabet), _vectors(alphabet)
    once, twice = np.roll(own, 1, axis=1), np.roll(own, 2, axis=1)
    runs, which = np.unique(run, return_inverse=True)
    order = np.argsort(which, kind="stable")
    which, text = which[order], text[order]
    for at in range(0, len(runs), RUN_BLOCK):
        block = runs[at : at + RUN_BLOCK]
        bound = twice[block // (k * k)] * once[block // k % k] * own[block % k]
        lo, hi = np.searchsorted(which, [at, at + len(block)])
        cell = text[lo:hi] * len(block) + which[lo:hi] - at
        counts = np.bincount(cell, minlength=len(texts) * len(block)).reshape(len(texts), len(block))
        out += counts.astype(np.float32) @ bound.astype(np.float32)
    return out


def profiles(texts: list[str]) -> np.ndarray:
    """One row of DIMENSIONS sums for each text.

    Texts are taken in groups whose number times their length is at most
    GROUP_CELLS, or one by one, and runs in blocks of RUN_BLOCK: memory does
    not depend on the letters' variety.
    """
    texts = [f" {t}" for t in texts]
    parts, group, size = [], [], 0
    for t in texts:
        if group and (len(group) + 1) * (size + len(t)) > GROUP_CELLS:
            parts.append(_sums(group))
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        parts.append(_sums(group))
    return np.concatenate(parts) if parts else np.zeros((0, DIMENSIONS), np.float32)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes of all languages, from every row with a text and a label.

    Sums are made in the tasks and added by Spark; what reaches the driver is
    one vector for each language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in w.chunks(batches, "text"):
            langs = batch.column("lang").to_pylist()
            profile = profiles(batch.column("text").to_pylist())
            for lang in sorted(set(langs)):
                rows = [i for i, x in enumerate(langs) if x == lang]
                sums[lang] = sums.get(lang, 0) + profile[rows].sum(axis=0, dtype=np.float64)
        for lang, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([own.tolist()])], ["lang", "sums"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sums = rows.where("text is not null and lang is not null").mapInArrow(run, "lang string, sums array<double>")
    added = sums.select("lang", F.posexplode("sums").alias("place", "v")).groupBy("lang", "place").agg(F.sum("v").alias("v"))
    out: dict[str, np.ndarray] = {}
    for lang, place, v in added.collect():
        out.setdefault(lang, np.zeros(DIMENSIONS))[place] = v
    return out


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score``, and the columns to ``keep``.

    Null texts and texts without a letter are ``und`` with score 0, and so is
    everything if nothing was learned.  A cosine below 0 counts as 0; of equal
    ones the first language by name is taken.  Whole texts are read.
    """
    langs = sorted(prototypes)
    matrix = np.array([prototypes[x] / max(np.linalg.norm(prototypes[x]), 1e-9) for x in langs], np.float32).reshape(-1, DIMENSIONS)
    names = [*langs, UNKNOWN]
    keep = docs.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.chunks(batches, "text"):
            own = profiles([t or "" for t in batch.column("text").to_pylist()])
            size = np.linalg.norm(own, axis=1)
            best, score = np.full(len(own), len(langs)), np.zeros(len(own))
            if len(langs):
                near = np.round(own @ matrix.T / np.maximum(size, 1e-9)[:, None], 6)
                known = size > 0
                best[known] = near.argmax(axis=1)[known]
                score[known] = np.clip(near.max(axis=1), 0, 1)[known]
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array([names[i] for i in best.tolist()], pa.string()), pa.array(score)],
                [*rest.schema.names, "lang_pred", "score"],
            )

    # Columns travel under their places, so that no name can clash.
    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]
    schema = docs.select(*own).schema.add("lang_pred", "string").add("score", "double")
    rows = docs.select(*own, F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).toDF(*keep, "lang_pred", "score")
