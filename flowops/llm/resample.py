"""Target-distribution importance resampling over hashed word runs, with weights from bit-sliced counts.

Features of a text are its runs of one to three words, hashed into buckets. A bucket's gain says how much
likelier it is in the target texts than in the corpus. The weight of a document is the sum of gains over
its features: its bucket counts become bit planes, plane i holding a bit for every bucket whose count has
bit i; gains become planes of their positive and of their negative values. The bits that a count plane i
and a gain plane j share, counted, times 2**(i + j), add up to the exact weight.

Corpus counts cover all documents and come from a pass of their own, as one row per task and bucket; the
second pass reads the texts again, which is cheaper than storing planes larger than the texts. Documents
with enough words get noise from a digest of their id and are ranked by a range sort with one sum per part.

Defined cases: a null or empty text has no feature and weight 0, a text of one or two words has no longer
runs; without target texts all gains come from the corpus alone; a null doc_id counts as an empty one in
the digest and comes last among ties; rows of equal doc_id are separate rows, ranked by their features
where score and doc_id are equal; an empty table gives no rows. Columns beside those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from flowops.llm.common import default_shuffles, stored
from flowops.llm.terms import SLICE, pieces

BUCKETS = 10_000
SMOOTHING = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = "42"
# Texts whose bucket counts are held at once, as one row of counts each.
TEXTS = 128
# Words up to so many bytes shift the checksum of what comes before them by table.
SHIFTS = 64
POLYNOMIAL = 0xEDB88320


def _shift_tables() -> np.ndarray:
    """[n, j, b]: checksum of byte b at place j of a checksum once n zero bytes are appended."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = (byte >> np.uint32(1)) ^ (np.uint32(POLYNOMIAL) * (byte & np.uint32(1)))
    steps = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])]
    for _ in range(SHIFTS):
        steps.append(byte[steps[-1] & np.uint32(255)] ^ (steps[-1] >> np.uint32(8)))
    return np.stack(steps)


TABLES = _shift_tables()
SPACE = np.array([crc32(b" ")], np.uint32)


def _shifted(sums: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = TABLES[n, 0, sums & np.uint32(255)]
    for j in (1, 2, 3):
        out ^= TABLES[n, j, (sums >> np.uint32(8 * j)) & np.uint32(255)]
    return out


def run_checksums(words: list[bytes]) -> list[np.ndarray]:
    """CRC-32 of the runs of one, two and three words, joined by a space, that end at each word.

    The checksum of a run follows from that of the run without its last word and that of the word. The
    first values of the longer runs mean nothing, as there are no words before.
    """
    n = len(words)
    own = np.fromiter(map(crc32, words), np.uint32, n)
    size = np.fromiter(map(len, words), np.int64, n)
    far = np.minimum(size + 1, SHIFTS)
    spaced = own ^ _shifted(np.broadcast_to(SPACE, n), np.minimum(size, SHIFTS))
    out = [own]
    for length in (2, 3):
        before = np.concatenate([out[-1][:1], out[-1][:-1]])
        out.append(_shifted(before, far) ^ spaced)
    for i in np.flatnonzero(size >= SHIFTS).tolist():
        # A long word breaks the steps of its own runs and of the one that ends behind it.
        for end, length in ((i, 2), (i, 3), (i + 1, 3)):
            if length - 1 <= end < n:
                out[length - 1][end] = crc32(b" ".join(words[end - length + 1 : end + 1]))
    return out


def buckets(texts: pa.Array, size: int = BUCKETS) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, words of each text, text of a feature, bucket of a feature) for slices of the texts.

    Texts share a slice of at most SLICE bytes and TEXTS texts; a longer text comes in several slices of its
    own, each of which begins with the last two words of the one before and leaves out the runs counted there.
    """
    first, words, counts = 0, [], []
    held = 0

    def features(counts: list[int], words: list[bytes], known: int = 0) -> tuple[np.ndarray, np.ndarray]:
        doc = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        whole = [(place >= length - 1) & (place >= known) for length in (1, 2, 3)]
        sums = run_checksums(words)
        return np.concatenate([doc[w] for w in whole]), np.concatenate([s[w] % np.uint32(size) for s, w in zip(sums, whole)]).astype(np.int64)

    for i, raw in enumerate(texts):
        raw = raw.as_py() or b""
        if len(counts) == TEXTS or held + len(raw) > SLICE and counts:
            yield first, np.array(counts), *features(counts, words)
            first, words, counts, held = i, [], [], 0
        if len(raw) <= SLICE:
            found = [w for part in pieces(raw) for w in part]
            words += found
            counts.append(len(found))
            held += len(raw)
            continue
        tail: list[bytes] = []
        for part in pieces(raw):
            joined = tail + part
            yield i, np.array([len(part)]), *features([len(joined)], joined, len(tail))
            tail = joined[-2:]
        first = i + 1
    if counts:
        yield first, np.array(counts), *features(counts, words)


def bucket_counts(texts: DataFrame, size: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows of the column text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for *_, found in buckets(batch.column("text"), size):
                total += np.bincount(found, minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    parts = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, size: int) -> np.ndarray:
    """At most ``size`` rows, whatever the texts."""
    out = np.zeros(size, np.int64)
    for bucket, n in counts.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the logarithm of each bucket's smoothed share in the target over that in the corpus."""
    ratio = (target + 1.0) * (corpus.sum() + float(SMOOTHING)) / ((corpus + 1.0) * (target.sum() + float(SMOOTHING)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """[bit, row, word]: the bits of whole numbers of 0 or more, 64 columns to a word."""
    n = int(values.max(initial=0))
    kind = np.uint8 if n < 1 << 8 else np.uint16 if n < 1 << 16 else np.int64
    small = values.astype(kind)
    width = -(-values.shape[1] // 64) * 8
    out = np.zeros((n.bit_length(), len(values), width), np.uint8)
    for bit in range(n.bit_length()):
        packed = np.packbits((small >> kind(bit)).astype(np.uint8) & np.uint8(1), axis=1)
        out[bit, :, : packed.shape[1]] = packed
    return out.view(np.uint64)


def weighed(counts: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Sum of count times gain for each row of counts, from the planes of its counts and of the gains."""
    out = np.zeros(len(counts), np.int64)
    for i, plane in enumerate(planes(counts)):
        for gain, sign in ((up, 1), (down, -1)):
            for j, bits in enumerate(gain):
                shared = np.bitwise_count(plane & bits).sum(axis=1, dtype=np.int64)
                out += sign * (shared << (i + j))
    return out


def scored(docs: DataFrame, target: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    gain = gains(_dense(bucket_counts(docs), BUCKETS), _dense(bucket_counts(target), BUCKETS))
    up, down = planes(np.maximum(gain, 0)[None]), planes(np.maximum(-gain, 0)[None])
    kind = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, weight = np.zeros((2, batch.num_rows), np.int64)
            for first, n, doc, bucket in buckets(batch.column("text")):
                counts = np.bincount(doc * BUCKETS + bucket, minlength=len(n) * BUCKETS).reshape(len(n), BUCKETS)
                n_words[first : first + len(n)] += n
                weight[first : first + len(n)] += weighed(counts, up, down)
            features = n_words + np.maximum(n_words - 1, 0) + np.maximum(n_words - 2, 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (n_words, features, weight))], names=kind.names)

    done = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(weigh, kind)
    return done.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in whole thousandths, from a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """``scored`` with the rank of the drawn documents: the highest scores among those with enough words."""
    spark: SparkSession = docs.sparkSession
    rows = stored(scored(docs, target, seed), "resample-scores").withColumn("open", F.col("n_words") >= least_words)
    order = [F.col("open").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    dealt = rows.repartitionByRange(default_shuffles(spark), *order).withColumn("part", F.spark_partition_id())
    parts = stored(dealt, "resample-order")
    # One row per part of the range sort.
    sums = parts.groupBy("part").agg(F.sum(F.col("open").cast("long")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy()).alias("total"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("start")
    drawn = F.col("open") & (place <= F.floor(percent * F.col("total") / 100))
    ranked = parts.join(F.broadcast(starts), "part").withColumn("rank", F.when(drawn, place.cast("long")))
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", "rank")
