"""Documents whose sets of word n-grams have a high Jaccard similarity.

Texts with equal sets form one class first, told by 128 bits; classes are what
is joined.  Every n-gram has a place in one order of all n-grams, rarest first.
Two sets that are similar enough share an n-gram among the first few of each
(their prefixes), so an n-gram that only one class has finds no partner: it
fills a place of the prefix and is not sent on.

All n-grams are counted, of one text for each class.  Tasks sort and count what
they have before it is shuffled, four bytes an n-gram.  Counts come back as
bitmaps, one for each step of frequency.

Candidates share a prefix n-gram and pass a length filter, a positional filter
(what can still overlap after the shared place) and a suffix filter (the sets'
sizes over parts of the hash space bound how far they differ).  Each pair is
verified once, on whole sets.

Pairs inside a group are not all made.  In each bucket the class with the
shared n-gram foremost is compared with all others; links make components.  Then
only classes outside a bucket's main component are compared with the bucket's
classes of other components, which loses no link that could matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from paywarden.llm import words as w
from paywarden.llm.components import components
from paywarden.llm.tables import KeyFilter, key_filter
from paywarden.sources.tables import stage

_PARTS = 128
#: N-grams of so many classes and more come later in the order.
_LEVELS = [2, 8, 64, 512]
#: N-grams a task sorts at once, and n-grams of a segment that is counted in one piece.
_FLUSH = 1 << 21
_SEGMENT = 1 << 21


def gram_sets(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct n-gram names of all texts, and where each text's begin; A-Z count as a-z."""
    found = w.words_of(batch, "text", lower=True)
    names = found.names()
    grams, at = found.windows(names, size)
    text = found.text_of()[at] if len(at) else at
    n = found.counts()
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        # A text of fewer words is one n-gram.
        own = n[short].astype(np.uint64)
        for k in range(size - 1):
            more = n[short] > k
            own[more] = w.combine(own[more], names[found.first[:-1][short][more] + k])
        grams, text = np.concatenate([grams, own]), np.concatenate([text, short])
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    grams, text = grams[new], text[new]
    return grams, np.searchsorted(text, np.arange(len(n) + 1))


def _node(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _nodes(grams: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    return [_node(grams[a:b]) if b > a else None for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def _row_keys(batch: pa.RecordBatch, nodes: list[bytes | None]) -> np.ndarray:
    """A number for each row that tells it by id and set."""
    own = np.array([int.from_bytes(x[:8], "little") if x else 0 for x in nodes], np.uint64)
    return w.combine(own, np.asarray(batch.column("spread"), np.int64).view(np.uint64)).view(np.int64)


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def _describe(size: int):
    """Set size, class key, row key and counts over parts of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.chunks(batches, "text"):
            grams, first = gram_sets(batch, size)
            nodes, n = _nodes(grams, first), np.diff(first)
            place = np.repeat(np.arange(len(n)), n) * _PARTS + (w.mix(grams) % np.uint64(_PARTS)).astype(np.int64)
            parts = np.minimum(np.bincount(place, minlength=len(n) * _PARTS), 255).astype(np.uint8).reshape(-1, _PARTS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(n, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(_row_keys(batch, nodes)),
                    pa.array([x.tobytes() for x in parts], pa.binary()),
                ],
                ["id", "n", "node", "row", "parts"],
            )

    return run


def _one_each(batch: pa.RecordBatch, size: int, chosen: KeyFilter) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The sets of the rows that stand for their class; copies in one batch once."""
    grams, first = gram_sets(batch, size)
    nodes = _nodes(grams, first)
    take = chosen.has(_row_keys(batch, nodes))
    seen, kept = set(), []
    for i in np.flatnonzero(take).tolist():
        if nodes[i] is not None and nodes[i] not in seen:
            seen.add(nodes[i])
            kept.append(i)
    wanted = np.zeros(len(nodes), bool)
    wanted[kept] = True
    n = np.diff(first)
    grams = grams[np.repeat(wanted, n)]
    return grams, np.concatenate([[0], np.cumsum(n[kept])]).astype(np.int64), [nodes[i] for i in kept]


def _emit_counts(size: int, chosen: KeyFilter, bits: int):
    """What a task has of each segment: n-grams it met once, and others with their counts."""

    def blobs(pool: list[np.ndarray]) -> pa.RecordBatch:
        # Segment and 32 bits of a name; the lowest bits are cut off.
        short = np.concatenate(pool) >> np.uint64(32 - bits)
        short, count = np.unique(short, return_counts=True)
        segment = (short >> np.uint64(32)).astype(np.int64)
        low = (short & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        found, begin = np.unique(segment, return_index=True)
        end = np.append(begin[1:], len(segment))
        once, more, counts = [], [], []
        for a, b in zip(begin.tolist(), end.tolist()):
            own, n = low[a:b], count[a:b]
            once.append(own[n == 1].tobytes())
            more.append(own[n > 1].tobytes())
            counts.append(n[n > 1].astype(np.uint32).tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(found), *(pa.array(x, pa.binary()) for x in (once, more, counts))], ["segment", "once", "more", "counts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, held = [], 0
        for batch in w.chunks(batches, "text"):
            grams, _, _ = _one_each(batch, size, chosen)
            pool.append(grams)
            held += len(grams)
            if held >= _FLUSH:
                yield blobs(pool)
                pool, held = [], 0
        if held:
            yield blobs(pool)

    return run


def _shared_of_segment(bits: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        blobs = {c: b"".join(table.column(c).to_pylist()) for c in ("once", "more", "counts")}
        once, more, counts = (np.frombuffer(blobs[c], np.uint32) for c in ("once", "more", "counts"))
        low, back = np.unique(np.concatenate([once, more]), return_inverse=True)
        total = np.bincount(back, weights=np.concatenate([np.ones(len(once)), counts]), minlength=len(low)).astype(np.int64)
        shared = total > 1
        segment = np.uint64(key[0].as_py()) << np.uint64(32)
        grams = (low[shared].astype(np.uint64) | segment) << np.uint64(32 - bits)
        return pa.table({"gram": grams.view(np.int64), "n": total[shared]})

    return run


def _emit_prefixes(size: int, percent: int, chosen: KeyFilter, levels: list[KeyFilter]):
    """(gram, node, n, at) for the n-grams in a class's prefix that others may have too."""

    def level(grams: np.ndarray) -> np.ndarray:
        out = np.zeros(len(grams), np.int64)
        at = np.arange(len(grams))
        for step in levels:
            at = at[step.has(grams[at].view(np.int64))]
            out[at] += 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.chunks(batches, "text"):
            grams, first, nodes = _one_each(batch, size, chosen)
            n = np.diff(first)
            reach = _prefix(n, percent)
            owner = np.repeat(np.arange(len(n)), n)
            step = level(grams)
            # They are in order of names already.
            order = np.argsort(owner * (len(levels) + 1) + step, kind="stable")
            grams, owner, step = grams[order], owner[order], step[order]
            at = np.arange(len(owner)) - first[owner]
            keep = (at < reach[owner]) & (step > 0)
            grams, owner, at = grams[keep], owner[keep], at[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.view(np.int64)), pa.array(nodes, pa.binary()).take(pa.array(owner)), pa.array(at.astype(np.int64))],
                ["gram", "node", "at"],
            )

    return run


def _sets(size: int, wanted: KeyFilter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.chunks(batches, "text"):
            grams, first, nodes = _one_each(batch, size, wanted)
            blobs = [grams[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(blobs, pa.binary())], ["node", "grams"])

    return run


def _suffixes_near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose parts differ by no more than ``most``: the suffix filter."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, _PARTS).astype(np.int16)
            for c in ("parts_a", "parts_b")
        )
        near = np.abs(a - b).sum(1) <= np.asarray(batch.column("most"))
        yield batch.filter(pa.array(near)).select(["a", "b"])


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "grams_a", "grams_b"))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                if 100 * same >= percent * (len(x) + len(y) - same):
                    links.append((a, b))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


class _Join:
    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent = docs, size, percent
        kind = docs.schema["id"].dataType.simpleString()
        described = docs.mapInArrow(_describe(size), f"id {kind}, n long, node binary, row long, parts binary")
        self.rows, _ = stage(described, "sets")
        one = self.rows.where("node is not null").groupBy("node")
        # Copies meet in each task; of a class one row stands for all.
        classes = one.agg(F.first("n").alias("n"), F.min("row").alias("row"), F.first("parts").alias("parts"))
        self.classes, _ = stage(classes.withColumn("own", F.monotonically_increasing_id()), "classes")
        self.n_classes, self.n_grams = self.classes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    def shared_grams(self, chosen: KeyFilter) -> list[KeyFilter]:
        """Filters of the n-grams that two, some, many classes have."""
        bits = min(32, (self.n_grams // _SEGMENT).bit_length())
        counted = self.docs.mapInArrow(
            _emit_counts(self.size, chosen, bits), "segment long, once binary, more binary, counts binary"
        )
        shared = counted.groupBy("segment").applyInArrow(_shared_of_segment(bits), "gram long, n long")
        shared, _ = stage(shared, "shared")
        sizes = shared.agg(*[F.count_if(F.col("n") >= n).alias(f"n{n}") for n in _LEVELS]).first()
        # Names are cut to what was counted, and filters read no further.
        return [key_filter(shared.where(F.col("n") >= n), "gram", sizes[f"n{n}"]) for n in _LEVELS]

    def prefixes(self) -> DataFrame:
        """(gram, node, n, at): the n-grams in the classes' prefixes that others may have too."""
        chosen = key_filter(self.classes, "row", self.n_classes)
        emitted = self.docs.mapInArrow(
            _emit_prefixes(self.size, self.percent, chosen, self.shared_grams(chosen)), "gram long, node binary, at long"
        )
        own = self.classes.select("node", F.col("own").alias("class"), "n")
        return emitted.join(own, "node").select("gram", F.col("class").alias("node"), "n", "at")

    def _close(self, n1: str, at1: str, n2: str, at2: str) -> Column:
        """The length and the positional filter."""
        p = self.percent
        least = f"(({p} * ({n1} + {n2}) + {99 + p}) div {100 + p})"
        return F.expr(
            f"100 * least({n1}, {n2}) >= {p} * greatest({n1}, {n2})"
            f" and least({n1} - {at1}, {n2} - {at2}) >= {least}"
        )

    def near(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) those that the suffix filter leaves."""
        parts = self.classes.select("own", "n", "parts")
        for c in "ab":
            own = parts.select(F.col("own").alias(c), F.col("n").alias(f"n_{c}"), F.col("parts").alias(f"parts_{c}"))
            pairs = pairs.join(own, c)
        p = self.percent
        # |x| + |y| - 2 * least overlap; a part holding over 254 n-grams only weakens the filter.
        most = F.expr(f"n_a + n_b - 2 * (({p} * (n_a + n_b) + {99 + p}) div {100 + p})")
        return pairs.withColumn("most", most).mapInArrow(_suffixes_near, "a long, b long")

    def candidates(self, rows: DataFrame) -> DataFrame:
        """(own, grams): the whole sets of all classes that share a prefix n-gram."""
        own = self.classes.join(rows.select(F.col("node").alias("own")).distinct(), "own")
        own, found = stage(own.select("own", "node", "row"), "candidates", {"n": F.count("*")})
        wanted = key_filter(own, "row", found["n"])
        sets = self.docs.mapInArrow(_sets(self.size, wanted), "node binary, grams binary")
        sets = sets.join(own.select("own", "node"), "node").groupBy("own").agg(F.first("grams").alias("grams"))
        return stage(sets, "grams")[0]

    def links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are linked, each verified once."""
        pairs = self.near(pairs.distinct())
        for c in "ab":
            pairs = pairs.join(sets.select(F.col("own").alias(c), F.col("grams").alias(f"grams_{c}")), c)
        return stage(pairs.mapInArrow(_verify(self.percent), "a long, b long"), "linked")[0]

    def labels(self) -> DataFrame:
        """(node, label): the component of each linked class."""
        rows, _ = stage(self.prefixes(), "emitted")
        sizes = rows.groupBy("gram").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
        # Copies of a row that both stand for a class come twice.
        rows = rows.distinct().join(sizes.select("gram"), "gram")
        rows, _ = stage(rows, "prefixes")
        sets = self.candidates(rows)
        links = self.links(self.stars(rows), sets)
        found = components(links)
        rest = self.links(self.apart(rows, found), sets)
        if rest.isEmpty():
            return found
        return components(links.union(rest))

    def stars(self, rows: DataFrame) -> DataFrame:
        """Pairs of each bucket's foremost class and the others."""
        hubs = rows.groupBy("gram").agg(F.min(F.struct("at", "node", "n")).alias("hub"))
        pairs = rows.join(hubs, "gram").where(F.col("hub.node") != F.col("node"))
        pairs = pairs.where(self._close("n", "at", "hub.n", "hub.at"))
        return pairs.select(F.least("hub.node", "node").alias("a"), F.greatest("hub.node", "node").alias("b"))

    def apart(self, rows: DataFrame, found: DataFrame) -> DataFrame:
        """Pairs of one bucket that are not of one component yet."""
        rows = rows.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
        # One row for each bucket and component; buckets with one component are done.
        sizes = rows.groupBy("gram", "label").agg(F.count("*").alias("m"))
        main = sizes.groupBy("gram").agg(F.max(F.struct("m", "label")).alias("top"), F.count("*").alias("k")).where("k > 1")
        open_rows, _ = stage(rows.join(main.select("gram", F.col("top.label").alias("main")), "gram"), "apart")
        others = open_rows.where("label <> main").select(
            "gram", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), F.col("label").alias("label_b")
        )
        pairs = open_rows.join(others, "gram").where(
            (F.col("label") != F.col("label_b"))
            & ((F.col("label") == F.col("main")) | (F.col("node") < F.col("b")))
            & self._close("n", "at", "n_b", "at_b")
        )
        return pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 3,
    percent: int = 90,
) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id``.

    Words are runs of non-blank bytes with A-Z as a-z; a set holds the distinct
    runs of ``size`` words, or the whole sequence if there are fewer words.  Two
    rows are linked when the intersection has ``percent`` hundredths of the
    union or more; ``component_id`` is the smallest id reachable by links.

    Null texts and texts without words have an empty set and are linked with
    nothing: their component is their own id.  Rows with equal sets are linked,
    repeated rows as well.  Null ids are ignored when the smallest is taken.  An id
    may be a struct, compared field by field.
    Other columns are not read.
    """
    # By its name, which leaves fields nullable.
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if not isinstance(docs.schema["id"].dataType, StructType):
        docs = docs.withColumn("id", F.col("id").cast("long"))
    docs = docs.withColumn("spread", F.xxhash64("id"))
    join = _Join(docs, size, percent)
    labels = join.labels()
    own = join.rows.select("id", "n", "node")
    least = own.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    classes = join.classes.select("node", F.col("own").alias("class"))
    linked = classes.join(labels.withColumnRenamed("node", "class"), "class", "left")
    least = least.join(linked.withColumn("label", F.coalesce("label", "class")), "node")
    ids = least.groupBy("label").agg(F.min("least").alias("component_id"))
    by_node = least.select("node", "label").join(ids, "label").select("node", "component_id")
    out = own.join(by_node, "node", "left")
    alone = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").cast(kind).alias(id_col), F.col("n").alias("n_shingles"), alone.cast(kind).alias("component_id")
    )
