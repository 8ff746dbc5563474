"""Ranked lexical search by the Best Position Algorithm over impact lists.

Documents are indexed once: a row per document with its number of terms and its (term, count) postings in
the terms of the queries. A task reads the index in shards of bounded size. In a shard every term has a
list of its documents by falling impact. A query reads its lists from the top in step (sorted access);
for a document met for the first time all its places in the query's lists are looked up (direct access),
which completes its score and marks these places as seen. The best position of a list is the end of its
run of seen places, however they were seen; what no document beyond the runs can exceed is the sum of the
impacts at the first place behind each run. Reading stops when that sum lies strictly below the k-th
score, so that ties are still read, and a shard also uses the k-th score of the shards its task has read.

A shard returns at most k documents a query and the ranking is decided among these, in two steps, so no
task orders more than its share. Queries come in blocks of bounded size, each with a pass of its own.

Defined cases: a null or empty text, or one without letters and digits, has no term, does not count in N
and is never found; equal scores go by doc_id, null last; rows of equal doc_id are separate documents, rows
of equal item_id separate queries; a query without terms or an empty table gives no rows. Columns beside
those named are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from flowops.llm.common import stored
from flowops.llm.terms import pieces

TOP = 20
# Queries of a block: bytes of text that the driver and every task hold.
BLOCK_BYTES = 1 << 22
# Postings of a shard, unless one document has more; a shard takes about 50 bytes a posting.
SHARD_POSTINGS = 1 << 20
# Places read from every list in the first step; each step reads twice as many as the one before.
FIRST_STEP = 16
# Groups in which the findings of a query are cut to k before they are ranked together.
MERGES = 64


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item with a score above 0."""
    texts = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    kinds = {f.name: f.dataType for f in [*docs.schema, *items.schema] if f.name in ("doc_id", "item_id")}
    schema = T.StructType([T.StructField("item_id", kinds["item_id"]), T.StructField("rank", T.IntegerType()),
                           T.StructField("doc_id", kinds["doc_id"]), T.StructField("score", T.LongType())])
    found = []
    for block in range(blocks):
        own = texts if blocks == 1 else texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = own.collect()
        if rows:
            found.append(_block(docs, [r["item_id"] for r in rows], [r["text"] for r in rows], k, kinds))
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _block(docs: DataFrame, names: list, texts: list[str], k: int, kinds: dict) -> DataFrame:
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    queries = []
    for text in texts:
        times = Counter(vocabulary.setdefault(w, len(vocabulary)) for words in pieces(text.encode()) for w in words)
        queries.append((np.fromiter(times, np.int64, len(times)), np.fromiter(times.values(), np.int64, len(times))))
    index = stored(indexed(docs, vocabulary), "search-index")
    n_docs, n_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(vocabulary), np.int64)
    for term, n in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        held[term] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in held], np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The scores to beat: the k best of the shards before.
        best = [np.zeros(0, np.int64) for _ in queries]
        for held_docs, sizes, terms, counts in shards(batches):
            shard = Shard(sizes, terms, counts, weights, n_docs, n_terms)
            numbers, places, scores = [], [], []
            for q, (slots, times) in enumerate(queries):
                floor = int(best[q][0]) if len(best[q]) == k else 1
                at, score = shard.top(slots, times, k, floor)
                best[q] = np.sort(np.concatenate([best[q], score]))[-k:]
                numbers.append(np.full(len(at), q, np.int32))
                places.append(at)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(numbers)), held_docs.take(pa.array(np.concatenate(places))), pa.array(np.concatenate(scores))],
                names=["query", "doc_id", "score"],
            )

    kind = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("doc_id", kinds["doc_id"]), T.StructField("score", T.LongType())])
    best = index.mapInArrow(search, kind)
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = best.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGES)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*by))).where(F.col("rank") <= k)
    last = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*by))).where(F.col("rank") <= k)
    named = spark.createDataFrame(
        list(enumerate(names)), T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", kinds["item_id"])])
    )
    # The queries of one block, whose size is bounded.
    return last.join(F.broadcast(named), "query").select("item_id", "rank", "doc_id", "score")


def indexed(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: its postings in the terms of ``vocabulary``."""
    kind = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.IntegerType())),
    ])

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = vocabulary.get
        for batch in batches:
            keep, sizes, terms, counts = [], [], [], []
            for i, raw in enumerate(batch.column("text")):
                times, n = Counter(), 0
                for words in pieces(raw.as_py() or b""):
                    times.update(map(slot, words))
                    n += len(words)
                if n:
                    times.pop(None, None)
                    own = sorted(times)
                    keep.append(i)
                    sizes.append(n)
                    terms.append(own)
                    counts.append([times[t] for t in own])
            rows = [pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(keep, pa.int64())), *rows], names=kind.names)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(postings, kind)


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, list, list]]:
    """Index rows put together until they have SHARD_POSTINGS, in the order of doc_id, null last."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            held.append(part)
            size += len(part.column("terms").flatten())
            if size >= SHARD_POSTINGS:
                yield _ordered(held)
                held, size = [], 0
    if held:
        yield _ordered(held)


def _ordered(parts: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray, list, list]:
    table = pa.Table.from_batches(parts).combine_chunks().sort_by("doc_id").combine_chunks()
    return tuple(pa.concat_arrays(c.chunks) if c.num_chunks != 1 else c.chunk(0) for c in map(table.column, ("doc_id", "n", "terms", "counts")))


def _ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers first[i]..end[i]-1 of all i, one range behind the other."""
    n = end - first
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Shard:
    """Postings of some documents twice: by document, and as one list a term in falling order of impact."""

    def __init__(self, sizes: pa.Array, terms: pa.Array, counts: pa.Array, weights: np.ndarray, n_docs: int, n_terms: int):
        n = sizes.to_numpy(zero_copy_only=False)
        lengths = 75 + (25 * n * n_docs) // max(n_terms, 1)
        self.row = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        self.term = terms.flatten().to_numpy(zero_copy_only=False)
        times = counts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(n)), np.diff(self.row))
        self.own_impact = weights[self.term] * ((1_000_000_000 * times) // (1000 * times + 12 * lengths[doc]))
        by_impact = np.argsort(-self.own_impact, kind="stable")
        order = by_impact[np.argsort(self.term[by_impact], kind="stable")]
        self.doc, self.impact = doc[order], self.own_impact[order]
        self.start = np.searchsorted(self.term[order], np.arange(len(weights) + 1))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.accesses = 0

    def top(self, slots: np.ndarray, times: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of the at most ``k`` best documents with at least ``floor`` points (1 or more)."""
        first, end = self.start[slots], self.start[slots + 1]
        wanted = np.zeros(len(self.start), np.int64)
        wanted[slots] = times
        seen = np.zeros(len(self.doc), bool)
        known = np.zeros(len(self.row) - 1, bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        read, best, step = first.copy(), first.copy(), FIRST_STEP
        while True:
            upto = np.minimum(read + step, end)
            met = self.doc[_ranges(read, upto)]
            if not len(met):
                break
            new = np.unique(met[~known[met]])
            if len(new):
                known[new] = True
                rows, n = _ranges(self.row[new], self.row[new + 1]), self.row[new + 1] - self.row[new]
                held = wanted[self.term[rows]]
                score = np.add.reduceat(held * self.own_impact[rows], np.cumsum(n) - n)
                seen[self.place[rows[held > 0]]] = True
                self.accesses += len(rows)
                docs, scores = np.concatenate([docs, new]), np.concatenate([scores, score])
            if len(scores) > k:
                kept = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[kept], scores[kept]
            for i in range(len(best)):
                rest = seen[best[i] : end[i]]
                best[i] += len(rest) if rest.all() else rest.argmin()
            ahead = best < end
            bound = int((times[ahead] * self.impact[best[ahead]]).sum())
            kth = int(scores.min()) if len(scores) == k else 0
            if bound < max(kth, floor):
                break
            read, step = upto, 2 * step
        kept = np.lexsort((docs, -scores))
        kept = kept[scores[kept] >= floor]
        return docs[kept], scores[kept]
