"""Find license notices by MinHash bands over overlapping windows of text.

Templates and texts are shingled into five words.  A template of m shingles is
searched in windows of W shingles, the least power of two of 2 m or more, that
start every W / 2: any run of m shingles lies in one of them whole, and a
window that holds 80 % of a template has a Jaccard similarity of at least 0.19
with it.  64 bands of one minimum each then miss with a chance of (1 - 0.19)^64,
about one in a million.  Windows without any shingle of any template agree with
no template and need no signature.

Retrieved pairs are verified exactly: in the window, and if it holds too little,
together with a window's length on both sides.  So a notice with words put into
it, over up to 3 W / 2 shingles, is found if it is contained at all: a window
then holds 40 % of it, a similarity of 0.087 or more, which 64 bands miss with a
chance of 0.3 %.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywarden.llm import words as w

SHINGLE = 5
LEAST_CONTAINED = 0.8
BANDS = 64

#: Notices that public licenses ask for or that are common for them.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-body": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC-body": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        'the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS '
        "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
        "OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Apache-2.0-whole-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You '
        "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
}

_WORD = re.compile(r"\w+")


def _plain(text: str) -> str:
    return " ".join(_WORD.findall(text)).lower()


def _shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Names of shingles, and where each text's begin; a shorter text has none."""
    data, offsets = w.buffers(pa.array(texts, pa.string()))
    found = w.cut(data, offsets)
    names = found.names()
    grams, at = found.windows(names, SHINGLE)
    edges = np.searchsorted(at, found.first)
    return grams, edges


class Templates:
    def __init__(self, notices: Mapping[str, str]):
        self.ids, self.sets, self.classes = [], [], {}
        for name, text in sorted(notices.items()):
            own = np.unique(_shingles([_plain(text)])[0])
            if not len(own):
                raise ValueError(f"{name}: a template needs {SHINGLE} words")
            size = 1 << (2 * len(own) - 1).bit_length()
            bands = self.classes.setdefault(size, {})
            for band in enumerate(self.signature(own).tolist()):
                bands.setdefault(band, []).append(len(self.ids))
            self.ids.append(name)
            self.sets.append(own)
        self.all = np.unique(np.concatenate(self.sets))

    def signature(self, grams: np.ndarray) -> np.ndarray:
        seeds = w.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        return w.mix(grams[:, None] ^ seeds[None, :]).min(axis=0)

    def matches(self, grams: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(template, first word, last word + 1, share contained) in one text's shingles."""
        places = np.flatnonzero(np.isin(grams, self.all))
        found = set()
        for size, bands in self.classes.items():
            step = max(1, size // 2)
            starts = {s for k in (places // step).tolist() for s in (k * step, (k - 1) * step) if s >= 0}
            for start in sorted(starts):
                window = grams[start : start + size]
                retrieved = {t for band in enumerate(self.signature(window).tolist()) for t in bands.get(band, ())}
                for t in retrieved:
                    for around in (0, size):
                        lo = max(0, start - around)
                        near = grams[lo : start + size + around]
                        inside = np.flatnonzero(np.isin(near, self.sets[t]))
                        share = len(np.unique(near[inside])) / len(self.sets[t])
                        if share >= LEAST_CONTAINED:
                            found.add((t, lo + int(inside[0]), lo + int(inside[-1]) + SHINGLE, share, around))
                            break
        # Overlapping windows see one notice twice: a single window's and then the fullest sight of it counts.
        best: list[tuple[int, int, int, float]] = []
        for t, lo, hi, share, _ in sorted(found, key=lambda x: (x[0], x[4], -x[3], x[1], x[2])):
            if not any(b[0] == t and lo < b[2] and b[1] < hi for b in best):
                best.append((t, lo, hi, share))
        return sorted(best, key=lambda b: (b[1], b[0]))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    notices: Mapping[str, str] = NOTICES,
) -> DataFrame:
    """One row per notice found: id, ``license_id``, ``start_word``, ``end_word``, ``contained``.

    Words are runs of letters, digits and underscores in lower case; the span
    counts them from 0, its end exclusive.  Null, empty and short texts have no
    notice, an empty table no rows.  Repeated rows and repeated notices are each
    reported.  A notice needs five words.  Ids must be integers or null; other
    columns, whatever their names, are not read.
    """
    templates = Templates(notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.chunks(batches, "text"):
            grams, edges = _shingles([_plain(t or "") for t in batch.column("text").to_pylist()])
            hit = np.isin(grams, templates.all)
            rows = []
            for i in np.unique(np.searchsorted(edges, np.flatnonzero(hit), "right") - 1).tolist():
                rows += [(i, *m) for m in templates.matches(grams[edges[i] : edges[i + 1]])]
            if rows:
                i, t, lo, hi, share = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(i)), pa.array([templates.ids[x] for x in t]), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(share, pa.float64())],
                    ["id", "license_id", "start_word", "end_word", "contained"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, "id long, license_id string, start_word long, end_word long, contained double")
    return out.withColumnRenamed("id", id_col)
