"""Reversible line deduplication: exact reference-count tables behind sharded cuckoo filters.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, with A-Z in lower case; keys are held
as 128-bit digests. A `LineIndex` keeps, as tables in a folder,

* ``references``: one row per (key, document), from which documents can be taken out again;
* ``tallies``: one row per key, its number of documents and the last of them;
* ``filters``: one cuckoo filter per shard of the key space, holding every referenced key once.

An insertion asks the filters first: keys they do not know are new for certain and become rows of the tallies
as they are, and only the others are looked up in the exact tables and merged. A deletion counts the touched
keys anew and takes a key out of its filter when its last reference goes. A whole table is loaded in
``BATCHES`` insertions, dealt by document, so that all but the first meet filled filters.

Defined cases: a null or empty text is one empty line; keys shorter than ``min_chars`` are never dropped;
a document given in several rows counts once, and each of its rows is treated alike; a null doc_id counts as
one document that sorts before all others. Extra columns are carried along untouched.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowops.llm.common import dropped, packed, stored
from flowops.llm.cuckoo import CuckooFilter
from flowops.session import scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
# Keys a shard is meant to hold; its filter takes one megabyte and is at most half full then.
SHARD_KEYS = 1 << 18
# Insertions in which a table is loaded.
BATCHES = 3
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_FILTER = "shard int, filter binary, spare binary"


def _key(line: str, min_chars: int) -> bytes | None:
    core = line.strip(BLANKS)
    if len(core) < min_chars:
        return None
    return hashlib.blake2b(core.encode("utf-8").lower(), digest_size=16).digest()


def references_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc_id) for every long enough line key of every document; repeated within a row once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = {_key(line, min_chars) for line in (text.as_py() or "").split("\n")}
                own.discard(None)
                ids += [doc] * len(own)
                keys += own
            k = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(ids, pa.int64())], names=["k1", "k2", "doc_id"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "k1 long, k2 long, doc_id long")
    return rows.groupBy("k1", "k2", "doc_id").agg(F.count("*").alias("n_rows"))


def _loaded(filters: pd.DataFrame) -> CuckooFilter:
    if not len(filters):
        return CuckooFilter(SHARD_KEYS)
    return CuckooFilter.loaded(filters["filter"].iloc[0], filters["spare"].iloc[0])


def _changed(own: pd.DataFrame, keys: pd.DataFrame, add: bool) -> pd.DataFrame:
    cuckoo = _loaded(own)
    if len(keys):
        (cuckoo.add if add else cuckoo.remove)(keys["k1"].to_numpy(np.int64))
    table, spare = cuckoo.dumped()
    shard = int((own if len(own) else keys)["shard"].iloc[0])
    return pd.DataFrame({"shard": [shard], "filter": [table], "spare": [spare]})


def _tallied(references: DataFrame) -> DataFrame:
    return references.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last"))


class LineIndex:
    """Line references of a growing and shrinking set of documents, in versioned tables below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str | None = None, shards: int | None = None):
        self.spark = spark
        self.folder = folder or scratch_path(spark, "lines")
        self.shards = shards
        self.references = spark.createDataFrame([], "k1 long, k2 long, doc_id long, n_rows long")
        self.tallies = spark.createDataFrame([], "k1 long, k2 long, n_docs long, last long")
        self.filters = spark.createDataFrame([], _FILTER)

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, name, f"{self.folder}/{name}-{uuid.uuid4().hex}")

    def _sharded(self, keys: DataFrame) -> DataFrame:
        return keys.withColumn("shard", F.pmod(F.xxhash64("k2"), F.lit(self.shards)).cast("int"))

    def load(self, docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> LineIndex:
        """Insert the documents of a table into a new index, a share of them at a time; texts are read once."""
        new = self._stored(references_of(docs, min_chars), "line-references")
        self.shards = self.shards or max(1, -(-new.count() // SHARD_KEYS))
        batch = F.pmod(F.xxhash64(F.lit("batch"), F.col("doc_id")), F.lit(batches))
        for n in range(batches):
            # All rows of a document are in one batch, so no reference of a batch is there already.
            self._add(new.where(batch == n))
        return self

    def insert(self, docs: DataFrame, min_chars: int = MIN_CHARS) -> LineIndex:
        """Add documents. A document already there keeps its references and gains those of its new lines."""
        new = self._stored(references_of(docs, min_chars), "line-references")
        self.shards = self.shards or max(1, -(-new.count() // SHARD_KEYS))
        known = self.probed(new.select("k1", "k2").distinct()).where("known").select("k1", "k2")
        there = self.references.join(known, ["k1", "k2"], "left_semi").select(
            F.col("k1").alias("_a"), F.col("k2").alias("_b"), F.col("doc_id").alias("_doc")
        )
        same = (F.col("k1") == F.col("_a")) & (F.col("k2") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
        self._add(self._stored(new.join(there, same, "left_anti"), "line-references"))
        return self

    def _add(self, new: DataFrame) -> None:
        """Take in references that are not there yet."""
        asked = self._stored(self.probed(_tallied(new)), "line-probes")
        unknown, known = asked.where("not known").drop("known"), asked.where("known").drop("known")
        held = self.tallies.select("k1", "k2", F.col("n_docs").alias("_n"), F.col("last").alias("_last"))
        met = self._stored(known.join(held, ["k1", "k2"], "left"), "line-met")
        merged = met.select("k1", "k2", (F.col("n_docs") + F.coalesce("_n", F.lit(0))).alias("n_docs"), F.greatest("last", "_last").alias("last"))
        fresh = unknown.select("k1", "k2").unionByName(met.where("_n is null").select("k1", "k2"))
        self.filters = self._stored(self._with_filters(self._sharded(fresh), True), "line-filters")
        rest = self.tallies.join(met.where("_n is not null"), ["k1", "k2"], "left_anti")
        self.tallies = self._stored(rest.unionByName(unknown).unionByName(merged), "line-tallies")
        self.references = self.references.unionByName(new)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Take documents out again, as if they had never been inserted."""
        gone = doc_ids.select(F.col("doc_id").cast("long").alias("_gone")).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("_gone"))
        left = self._stored(self.references.join(gone, same, "left_anti"), "line-references")
        touched = self._stored(self.references.join(gone, same, "left_semi").select("k1", "k2").distinct(), "line-touched")
        anew = self._stored(_tallied(left.join(touched, ["k1", "k2"], "left_semi")), "line-anew")
        ended = self._sharded(touched.join(anew, ["k1", "k2"], "left_anti"))
        self.filters = self._stored(self._with_filters(ended, False), "line-filters")
        self.tallies = self._stored(self.tallies.join(touched, ["k1", "k2"], "left_anti").unionByName(anew), "line-tallies")
        self.references = left
        return self

    def _with_filters(self, keys: DataFrame, add: bool) -> DataFrame:
        """The filters with keys added or taken out."""

        def run(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            return _changed(own, rows, add)

        return self.filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInPandas(run, _FILTER)

    def probed(self, keys: DataFrame) -> DataFrame:
        """``keys`` with a flag ``known``: false is certain, true may be wrong once in thousands."""
        names = keys.columns

        def ask(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            known = _loaded(own).has(rows["k1"].to_numpy(np.int64)) if len(rows) else np.zeros(0, bool)
            return rows.assign(known=known)[[*names, "known"]]

        kinds = ", ".join(f"{n} {t}" for n, t in [*keys.dtypes, ("known", "boolean")])
        return self.filters.groupBy("shard").cogroup(self._sharded(keys).groupBy("shard")).applyInPandas(ask, kinds)

    def losses(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(doc_id, keys): the line keys each document loses, all holders but the last losing a frequent line."""
        # Stored, its size is known: a small table is broadcast, and beside a large one a hot line is split.
        frequent = self._stored(self.tallies.where(F.col("n_docs") >= min_docs), "frequent-lines")
        lost = self.references.join(frequent, ["k1", "k2"]).where("doc_id is null or doc_id < last")
        return lost.groupBy("doc_id").agg(F.collect_list(F.struct("k1", "k2")).alias("keys"))


def deduplicated(docs: DataFrame, index: LineIndex, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``row`` (the whole input row), ``kept`` (its text after the losses), ``n_lines`` and ``n_dropped``."""
    return without(docs, index.losses(min_docs), min_chars)


def without(docs: DataFrame, losses: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """What ``deduplicated`` returns, from the losses (doc_id, keys) of an index."""
    losses = losses.withColumnRenamed("doc_id", "_loser")
    rows = packed(docs)
    rows = rows.withColumn("_id", F.col("row.doc_id").cast("long"))
    joined = rows.join(losses, F.col("_id").eqNullSafe(F.col("_loser")), "left")
    held = joined.select("row", F.transform("keys", lambda k: k["k1"]).alias("a"), F.transform("keys", lambda k: k["k2"]).alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, lines, dropped = [], [], []
            for text, a, b in zip(batch.column("row").field("text"), batch.column("a"), batch.column("b")):
                text = text.as_py() or ""
                parts = text.split("\n")
                lines.append(len(parts))
                if a.is_valid:
                    lost = set(map(bytes, np.stack([a.values.to_numpy(), b.values.to_numpy()], 1)))
                    parts = [x for x in parts if _key(x, min_chars) not in lost]
                    text = "\n".join(parts)
                kept.append(text)
                dropped.append(lines[-1] - len(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=["row", "kept", "n_lines", "n_dropped"],
            )

    schema = held.select("row").schema.add("kept", "string").add("n_lines", "long").add("n_dropped", "long")
    return held.mapInArrow(run, schema)


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """All documents loaded into a fresh index and freed of lines that later documents also hold."""
    index = LineIndex(docs.sparkSession).load(docs, min_chars)
    # Only the losses are read again: the tables of the index leave the shared folder before the texts are written.
    losses = stored(index.losses(min_docs), "line-losses")
    dropped(docs.sparkSession, index.folder)
    return without(docs, losses, min_chars)
