"""Near-duplicate documents by MinHash, with sequential Bayesian verification of banded candidates.

Documents are sets of five-word shingles; two are linked at a Jaccard similarity of 0.75 or more.

1. Documents with the same words are one class, named by its smallest doc_id; only classes go on.
2. Signatures are cut into bands. Classes that share a band's bucket are compared with the bucket's smallest
   id, so a group of m copies makes m candidates and not all pairs.
3. A candidate's signatures are compared batch by batch; it is dropped as soon as the posterior probability
   of reaching the similarity (uniform prior) falls below the chosen miss probability.
4. What survives is confirmed on the full shingle sets of both texts.
5. Buckets whose members are not all in one component yet are compared in blocks of bounded size, members
   of different components only, by the same steps; survivors are confirmed on their full sets of 64-bit
   shingle hashes where they are compared, and a block returns at most one link per component. No bucket
   is capped or sampled.

Defined cases: a text without words links with nothing and is its own component; rows of equal doc_id are
one document with the links of all its texts; a row without doc_id takes no part, has a null component and
is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowops.llm import words
from flowops.llm.common import components, dropped, stored
from flowops.session import scratch_path

SHINGLE = 5
PERCENT = 75
BANDS = 32
ROWS = 4
BATCH = 32
MISS = 1e-5
# Members of a bucket, and shingles of all of them, that one block of a comparison is meant to hold.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 19
# Bits, as a power of two, of the map of ids whose texts are needed again. When so many are that the map
# fills up, more texts than needed are shuffled; results do not depend on it.
ID_BITS = 25


def _seeds(count: int) -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 63, (2, count), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The low 16 bits of the smallest value of each hash function over the shingles."""
    least = np.full(seeds.shape[1], np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[at : at + 1024, None] * seeds[0]
        part += seeds[1]
        np.minimum(least, part.min(axis=0), out=least)
    return (words.mixed(least) & np.uint64(0xFFFF)).astype("<u2")


def least_matches(batches: list[int], percent: int, miss: float) -> list[int]:
    """For n compared values, the fewest matches at which the posterior P(similarity >= t) reaches ``miss``.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1), whose tail above t
    is the probability of at most m successes in n + 1 trials of chance t.
    """
    t, out = percent / 100, []
    for n in batches:
        tail, m = (1 - t) ** (n + 1), 0
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def signatures(docs: DataFrame, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, k1 and k2 (digest of the word sequence), n_shingles and the signature, a row per input row."""
    seeds = _seeds(bands * rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, n, sig = [], [], [], []
            for _, hashes, bounds in words.sliced(batch.column(1)):
                places = words.powers(words.BASE, len(hashes))
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = hashes[a:b]
                    unique = np.unique(words.shingles(own, size))
                    n.append(len(unique))
                    sig.append(signature(unique, seeds).tobytes() if len(unique) else None)
                    k1.append(int((own * places[: b - a]).sum()))
                    k2.append(int((words.mixed(own + np.uint64(1)) * places[: b - a]).sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.array(k1, np.uint64).view(np.int64)),
                    pa.array(np.array(k2, np.uint64).view(np.int64)),
                    pa.array(n, pa.int64()),
                    pa.array(sig, pa.binary()),
                ],
                names=["doc_id", "k1", "k2", "n_shingles", "sig"],
            )

    chosen = docs.select(F.col("doc_id").cast("long"), "text")
    return chosen.mapInArrow(run, "doc_id long, k1 long, k2 long, n_shingles long, sig binary")


def _banded(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, bucket, id, n_shingles): a row per class and band."""
    width = 2 * rows
    bucket = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda b: F.struct(b.alias("band"), F.xxhash64(F.substring("sig", b * width + 1, F.lit(width))).alias("bucket")),
    )
    return classes.select(F.explode(bucket).alias("b"), "id", "n_shingles").select("b.band", "b.bucket", "id", "n_shingles")


def _places(ids: np.ndarray) -> np.ndarray:
    h = words.mixed(ids.astype(np.int64).view(np.uint64))
    mask = np.uint64((1 << ID_BITS) - 1)
    return np.concatenate([h & mask, (h >> np.uint64(32)) & mask]).astype(np.int64)


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents with one of the ids, and of few others: a filter before a join.

    The ids go to every task as a map of fixed size, two bits each.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << ID_BITS, np.uint8)
        for batch in batches:
            flags[_places(batch.column(0).to_numpy())] = 1
        bits = np.packbits(flags, bitorder="little").view(np.int64)
        there = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(bits[there])], names=["place", "bits"])

    marked = ids.mapInArrow(mark, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toPandas()
    whole = np.zeros(1 << ID_BITS >> 6, np.int64)
    whole[marked["place"].to_numpy(np.int64)] = marked["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(whole.view(np.uint8))

    @F.pandas_udf("boolean")
    def there(doc_id: pd.Series) -> pd.Series:
        at = _places(doc_id.fillna(0).to_numpy(np.int64))
        found = (shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return pd.Series(found.reshape(2, -1).all(axis=0)) & doc_id.notna().to_numpy()

    return docs.select(F.col("doc_id").cast("long"), "text").where(there("doc_id"))


def _matrix(sig: pa.Array) -> np.ndarray:
    array = sig.combine_chunks() if isinstance(sig, pa.ChunkedArray) else sig
    return np.frombuffer(b"".join(array.to_pylist()), "<u2").reshape(len(array), -1)


def _surviving(pairs: DataFrame, classes: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) whose signatures leave the similarity possible."""
    side = classes.select("id", "n_shingles", "sig")
    left = side.select(F.col("id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sig").alias("sig_a"))
    right = side.select(F.col("id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sig").alias("sig_b"))
    possible = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    joined = pairs.join(right, "b").join(left, "a").where(possible).select("a", "b", "sig_a", "sig_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch.column("sig_a")), _matrix(batch.column("sig_b"))
            steps = list(range(BATCH, x.shape[1] + 1, BATCH)) or [x.shape[1]]
            alive, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
            for step, fewest in zip(steps, least_matches(steps, percent, miss)):
                part = slice(step - steps[0], step)
                matches = matches + (x[alive, part] == y[alive, part]).sum(axis=1)
                keep = matches >= fewest
                alive, matches = alive[keep], matches[keep]
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(alive)), batch.column("b").take(pa.array(alive))], names=["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def _shingle_set(text: str | None, size: int) -> set:
    own = (text or "").encode("utf-8").lower().split()
    if len(own) < size:
        return {tuple(own)} if own else set()
    return set(zip(*[own[i:] for i in range(size)]))


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int, folder: str) -> DataFrame:
    """The pairs that reach the similarity on the full shingle sets of their texts."""
    texts = stored(_among(docs, pairs.select(F.explode(F.array("a", "b")).alias("id"))), "near-texts", f"{folder}/near-texts")
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, set()
        for batch in batches:
            kept = []
            for i, text in enumerate(batch.column("text_a")):
                if text != held or held is None:
                    held, own = text, _shingle_set(text.as_py(), size)
                other = _shingle_set(batch.column("text_b")[i].as_py(), size)
                both = len(own & other)
                if 100 * both >= percent * (len(own) + len(other) - both) > 0:
                    kept.append(i)
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, ids: DataFrame, size: int, folder: str) -> DataFrame:
    """(id, hashes): the sorted 64-bit hashes of all shingles of each named document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, hashes, bounds in words.sliced(batch.column(1)):
                out += [np.unique(words.shingles(hashes[a:b], size)).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "hashes"])

    # Stored between the two, so that no task needs two Python workers at once.
    return stored(_among(docs, ids), "open-texts", f"{folder}/open-texts").mapInArrow(run, "id long, hashes binary")


def _open_links(
    members: DataFrame, classes: DataFrame, found: DataFrame, docs: DataFrame, size: int, rows: int, percent: int, miss: float, folder: str
) -> DataFrame:
    """Links (a, b) between components that share a bucket, beyond those with the bucket's smallest id."""
    named = members.join(found.select("id", "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    need = F.greatest(F.col("n") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)
    buckets = (
        named.groupBy("band", "bucket")
        .agg(
            F.count("*").alias("n"),
            F.sum("n_shingles").alias("shingles"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .where("n > 2 and low <> high")
        .select("band", "bucket", F.ceil(need).alias("blocks"))
    )
    left = stored(named.join(buckets, ["band", "bucket"]).where("id <> leader"), "open-members", f"{folder}/open-members")
    if left.isEmpty():
        return left.select(F.col("id").alias("a"), F.col("id").alias("b"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, own).alias("i"), F.greatest(j, own).alias("j"))
    )
    dealt = left.select("band", "bucket", "id", "component", own.alias("own"), F.explode(blocks).alias("at"))
    data = stored(classes.select("id", "sig").join(_sets(docs, left.select("id"), size, folder), "id"), "open-sets", f"{folder}/open-sets")
    rows_of = dealt.select("band", "bucket", "at.i", "at.j", "own", "id", "component").join(data, "id")

    def compare(table: pa.Table) -> pa.Table:
        sig = _matrix(table.column("sig"))
        ids, comp, own = (table.column(c).to_numpy() for c in ("id", "component", "own"))
        i, j, band = (table.column(c)[0].as_py() for c in ("i", "j", "band"))
        sets = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
        n = np.array([len(x) for x in sets])
        one, two = np.flatnonzero(own == i), np.flatnonzero(own == j)
        steps = list(range(BATCH, sig.shape[1] + 1, BATCH)) or [sig.shape[1]]
        fewest = least_matches(steps, percent, miss)
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while parent.setdefault(c, c) != c:
                c = parent[c]
            return c

        out = []
        for x in one:
            y = two[ids[two] > ids[x]] if i == j else two
            y = y[(comp[y] != comp[x]) & (100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x]))]
            matches = np.zeros(len(y), np.int64)
            for step, least in zip(steps, fewest):
                matches = matches + (sig[y, step - steps[0] : step] == sig[x, step - steps[0] : step]).sum(axis=1)
                y, matches = y[matches >= least], matches[matches >= least]
            if len(y) and band:
                # A pair that shares an earlier band is compared in that band's bucket.
                shared = (sig[y, : band * rows] == sig[x, : band * rows]).reshape(len(y), band, rows).all(axis=2).any(axis=1)
                y = y[~shared]
            for k in y:
                if root(int(comp[x])) == root(int(comp[k])):
                    continue
                at = np.minimum(np.searchsorted(sets[x], sets[k]), n[x] - 1)
                both = int(np.count_nonzero(sets[x][at] == sets[k]))
                if 100 * both >= percent * (n[x] + n[k] - both):
                    parent[root(int(comp[x]))] = root(int(comp[k]))
                    out.append((int(ids[x]), int(ids[k])))
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows_of.groupBy("band", "bucket", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    miss: float = MISS,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    folder = scratch_path(docs.sparkSession, "near")

    def kept(df: DataFrame, name: str) -> DataFrame:
        return stored(df, name, f"{folder}/{name}")

    signed = kept(signatures(docs, size, bands, rows), "signatures")
    named = signed.where("n_shingles > 0 and doc_id is not null")
    least = named.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("first"))
    classes = kept(least.select("k1", "k2", F.col("first.doc_id").alias("id"), "first.n_shingles", "first.sig"), "classes")

    banded = _banded(classes, bands, rows)
    shared = banded.groupBy("band", "bucket").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    leaders = kept(shared.drop("n"), "bucket-leaders")
    members = kept(banded.join(leaders, ["band", "bucket"]), "bucket-members")
    stars = members.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    survivors = kept(_surviving(stars, classes, percent, miss), "survivors")
    links = kept(_confirmed(survivors, docs, size, percent, folder), "links")
    found = kept(components(links), "components")

    more = kept(_open_links(members, classes, found, docs, size, rows, percent, miss, folder), "open-links")
    if not more.isEmpty():
        found = kept(components(links.unionByName(more)), "all-components")

    of_class = classes.select("k1", "k2", "id").join(found, "id", "left").select("k1", "k2", F.coalesce("component", "id").alias("component_id"))
    done = signed.select("doc_id", "k1", "k2", "n_shingles").join(of_class, ["k1", "k2"], "left")
    alone = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    out = done.select("doc_id", "n_shingles", alone.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
    # Signatures, sets and texts leave the shared folder as soon as what is known of each row is stored.
    out = stored(out, "near-duplicates")
    dropped(docs.sparkSession, folder)
    return out
