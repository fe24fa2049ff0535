"""Ranked lexical search by pipelined term partitioning.

Terms are dealt out to owners by how many documents hold them, rarest first.
Documents are dealt out to shards, items to blocks.  For each shard a bundle
holds a block's items with their terms and a sparse document accumulator each;
it passes from owner to owner.  A stage is one cogroup of bundles and the
owner's postings by shard and block: it adds weight times impact, all integers,
to the accumulators.  After the last owner each bundle gives its best
documents, and the best of all shards are selected.

A bundle may drop a document on its way only if that cannot matter: ``top``
documents of the shard have scores already that it cannot reach with all that
its item's later terms can add.  Rare terms come first as they add most.

Nothing grows with the corpus in one place: a shard has a bounded number of
postings and of documents, a block a bounded number of items.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from paywarden.llm import words as w
from paywarden.llm.tables import KeyFilter, key_filter
from paywarden.sources.tables import stage

#: A term belongs to the first owner for which its documents times this are at most all documents.
OWNER_SHARES = [1000, 100, 10, 1]
SHARD_POSTINGS = 1 << 18
SHARD_DOCS = 1 << 14
BLOCK_ITEMS = 256
#: An impact is always below.
_MOST_IMPACT = 1_000_000
_NO_ID = (1 << 63) - 1

_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII; A-Z as a-z."""
    return (text or "").encode().translate(_TERM_BYTES).split()


def _key(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms_of(t))) for t in batch.column("text").to_pylist()]
        owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
        terms = [x for own in found for x in own]
        keys = np.array([_key(x) for x in terms], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("item").take(pa.array(owner)), pa.array([x.decode() for x in terms], pa.string()), pa.array(keys)],
            ["item", "term", "key"],
        )


def _index(wanted: KeyFilter):
    """Number of terms of each document, and the wanted ones with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.chunks(batches, "text"):
            texts = [terms_of(t) for t in batch.column("text").to_pylist()]
            n = np.array([len(t) for t in texts], np.int64)
            coded = pa.array([x for t in texts for x in t], pa.binary()).dictionary_encode()
            known = coded.dictionary
            keys = np.array([_key(x) for x in known.to_pylist()], np.uint64)
            code = np.asarray(coded.indices, np.int64)
            pair = np.repeat(np.arange(len(texts)), n) * max(1, len(known)) + code
            if len(pair):
                pair = pair[wanted.has(keys)[code]]
            pair, tf = np.unique(pair, return_counts=True)
            ends = np.searchsorted(pair, np.arange(len(texts) + 1) * max(1, len(known))).astype(np.int32)
            terms = known.take(pa.array(pair % max(1, len(known)))).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(n),
                    pa.ListArray.from_arrays(pa.array(ends), terms),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int64))),
                ],
                ["id", "n", "terms", "tfs"],
            )

    return run


def _binary(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.int64).tobytes()


def _numbers(blob: bytes | None) -> np.ndarray:
    return np.frombuffer(blob or b"", np.int64)


def _visit(owner: int, top: int, last: bool, result: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What an owner does with the bundles of a shard and block."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        term, row, doc, impact = (
            np.asarray(postings.column(c).combine_chunks(), np.int64) for c in ("term", "row", "doc", "impact")
        )
        order = np.argsort(term, kind="stable")
        term, row, doc, impact = term[order], row[order], doc[order], impact[order]
        items = bundles.to_pylist()
        carried = [[_numbers(x[c]) for c in ("rows", "docs", "scores")] for x in items]
        # All documents of the shard that occur here, by place.
        every = np.concatenate([row, *(c[0] for c in carried)])
        rows, first, place = np.unique(every, return_index=True, return_inverse=True)
        docs = np.concatenate([doc, *(c[1] for c in carried)])[first]
        own, spare = place[: len(row)], place[len(row) :]
        at, out = 0, []
        for item, (have, _, points) in zip(items, carried):
            score = np.zeros(len(rows), np.int64)
            score[spare[at : at + len(have)]] = points
            at += len(have)
            later = 0
            for t in item["terms"]:
                if t["owner"] == owner:
                    a, b = np.searchsorted(term, [t["term"], t["term"] + 1])
                    score[own[a:b]] += t["weight"] * impact[a:b]
                elif t["owner"] > owner:
                    later += t["weight"]
            found = np.flatnonzero(score)
            if len(found) >= top:
                least = np.partition(score[found], len(found) - top)[len(found) - top]
                found = found[score[found] + later * _MOST_IMPACT >= least]
            if last:
                found = found[np.lexsort((rows[found], docs[found], -score[found]))[:top]]
                out += [
                    {"item": item["item"], "row": r, "doc": d, "score": s}
                    for r, d, s in zip(rows[found].tolist(), docs[found].tolist(), score[found].tolist())
                ]
            else:
                item |= {"rows": _binary(rows[found]), "docs": _binary(docs[found]), "scores": _binary(score[found])}
                out.append(item)
        return pa.Table.from_pylist(out, schema=result)

    return run


def _shard(n: int) -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``top`` best documents of each item: item id, ``rank``, document id, ``score``.

    Terms are maximal runs of ASCII letters and digits and of any characters
    beyond ASCII, with A-Z as a-z.  With N documents that have a term, L terms
    in all and n in a document, df documents that hold a term, tf times each:
    w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 10 + (90 n N) div L, and the
    score is the sum of w ((10^9 tf) div (1000 tf + 8 m)) over the item's
    distinct terms.  Only scores above 0 are ranked, equal ones by id.

    Null and empty texts have no terms: such documents are found by nothing and
    count neither for N nor L, such items have no rows.  Each row of ``docs`` is
    a document of its own, whatever its id, so rows that repeat an id or a text
    rank one by one; null ids come after all others.  Document ids are whole
    numbers.  Rows that share an item id, null as well, are one item with the
    terms of all.  Other columns are not read.
    """
    id_kind, item_kind = docs.schema[id_col].dataType, items.schema[item_col].dataType
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))

    item_terms = items.mapInArrow(_item_terms, T.StructType([items.schema["item"]]).add("term", "string").add("key", "long"))
    item_terms, _ = stage(item_terms.distinct(), "search-items")
    vocabulary = item_terms.groupBy("term").agg(F.first("key").alias("key")).withColumn("number", F.monotonically_increasing_id())
    vocabulary, _ = stage(vocabulary, "search-terms")
    n_terms = vocabulary.count()
    n_blocks = 1 + item_terms.select("item").distinct().count() // BLOCK_ITEMS
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int")

    wanted = key_filter(vocabulary, "key", n_terms)
    index = docs.mapInArrow(_index(wanted), "id long, n long, terms array<string>, tfs array<long>")
    index, _ = stage(index.where("n > 0").withColumn("row", F.monotonically_increasing_id()), "search-index")
    n_docs, n_all, n_postings = index.agg(
        F.count("*"), F.coalesce(F.sum("n"), F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))
    ).first()
    n_shards = 1 + max(n_postings // SHARD_POSTINGS, n_docs // SHARD_DOCS)

    owner = F.lit(0)
    for i, share in enumerate(OWNER_SHARES[:-1]):
        owner = F.when(F.col("df") * share > n_docs, i + 1).otherwise(owner)
    frequency = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    blocks = item_terms.groupBy("term").agg(F.collect_set(block).alias("blocks"))
    owners = (
        frequency.join(vocabulary.select("term", "number"), "term")
        .join(blocks, "term")
        .withColumn("weight", F.floor(1000 * F.ln(F.lit(2 * n_docs + 2.0) / (2 * F.col("df") + 1))))
        .withColumn("owner", owner)
    )
    owners, _ = stage(owners, "search-owners")

    # In decimals, as 90 n N may pass 64 bits.
    length = F.expr(f"10 + (cast(n as decimal(18, 0)) * cast({90 * n_docs} as decimal(20, 0))) div {n_all}")
    postings = (
        index.select("row", F.coalesce("id", F.lit(_NO_ID)).alias("doc"), length.alias("m"), F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
        .select("row", "doc", "m", F.col("p.terms").alias("term"), F.col("p.tfs").alias("tf"))
        .join(owners.select("term", "number", "owner", "blocks"), "term")
        .select(
            _shard(n_shards).alias("shard"),
            F.explode("blocks").alias("block"),
            F.col("number").alias("term"),
            "row",
            "doc",
            F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)").alias("impact"),
            "owner",
        )
    )
    postings, _ = stage(postings, "search-postings")

    bundles = (
        item_terms.join(owners, "term")
        .groupBy("item")
        .agg(F.collect_list(F.struct(F.col("number").alias("term"), "weight", "owner")).alias("terms"))
        .select(
            F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"),
            block.alias("block"),
            "item",
            "terms",
            *[F.lit(None).cast("binary").alias(c) for c in ("rows", "docs", "scores")],
        )
    )
    found = T.StructType([items.schema["item"]]).add("row", "long").add("doc", "long").add("score", "long")
    for i in range(len(OWNER_SHARES)):
        last = i == len(OWNER_SHARES) - 1
        result = found if last else bundles.schema
        own = postings.where(F.col("owner") == i).drop("owner")
        bundles = (
            bundles.groupBy("shard", "block")
            .cogroup(own.groupBy("shard", "block"))
            .applyInArrow(_visit(i, top, last, to_arrow_schema(result)), result)
        )
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc", "row")
    return bundles.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        F.col("item").cast(item_kind).alias(item_col),
        "rank",
        F.nullif("doc", F.lit(_NO_ID)).cast(id_kind).alias(id_col),
        "score",
    )
