"""Toxicity by two class-conditional Kneser-Ney models with a shared backoff.

Expressions are whole words, pairs of neighbouring words, and all runs of 2 to 8 characters of `` word ``,
blanks included, so that no part of a word or of an unspaced text is left out. A document counts a word once
for each different predecessor, so a word said over and over weighs little. Each class has discounted counts
of its own; what the discount takes is given back through counts both classes share, from all documents,
labelled or not: the number of different predecessors of a word, the number of places of a run in different
words. The ordinary class's discount is set so that both classes give the same part of their mass to the
shared counts. Rare expressions then say nothing about the class, and frequent ones of one class say much.
Pairs are words given their predecessor: their discounted share of the predecessor's count backs off to the
shared counts of the word, with the mass that the discounts of this predecessor's pairs set free in the class, all
of it where the class has not seen the predecessor. A pair that the discounts take away says what the masses say;
the sums over such pairs and over the others are weighed apart.

A document's log-likelihoods are compared relative to the median ratio of its words, as language and topic
shift all of them alike, and as they are, as a text of toxic words alone has a toxic median; so is how far
the strongest run of each word exceeds a ratio. All are normalised by length (per word and per root of their
number). A logistic curve of slopes not below 0, fitted on labelled rows the counts have not seen, turns them
into a score.

Counts are Spark tables keyed by expression and grow with the input. An expression whose counts do not exceed
the discounts has a ratio of exactly 0 (a pair that of its predecessor) and is not carried further; what is counted
over all texts passes a map of the carried ones, of a fixed size, before it is sent. Up to ``HELD`` others are sent to all tasks
to score; more are joined to the words of the texts. The number of different pairs in the corpus, a divisor
common to both classes, is estimated (standard error 0.8%). The curve takes ``SAMPLE`` rows at most.

Defined cases: null and empty texts get the score of a difference of zero; without labelled rows of both
classes every score is the share of toxic ones among them, 0 without any. Repeated label rows count once, the
toxic one winning; a null label is no label.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from flowops.llm import words
from flowops.llm.common import default_shuffles, dropped, packed, stored
from flowops.session import scratch_path

SIZES = range(2, 9)
LONG = 5
OVER = (1.0, 2.0)
SAMPLE = 250_000
DISCOUNT = 4.0
FOLDS = 5
# Expressions, or labelled ids, that every task may hold.
HELD = 1 << 23
HELD_IDS = 1 << 21
# Parts that a frequent word's values are dealt into.
PARTS = 8
# Bits, as a power of two, of the map of keys that are carried.
MAP_BITS = 26
# Pairs of words a task gathers before it sends them; groups of them to a shuffle partition.
GATHERED = 1 << 21
BUCKETS = 4
# Partitions of different words whose runs one task counts.
TOGETHER = 4
# Registers that estimate all pairs, and how many go together.
REGISTERS = 1 << 14
CHUNK = 256
# Bytes of a predecessor's hash: of n predecessors of a word about n * n / 2**41 are taken for another.
OWN = 5
# Words whose values a task keeps.
KEPT = 1 << 18
FEATURES = 4 * 4 + 2 * 2 * len(OVER)
WORD, PAIR, GRAM = range(3)


def fold(doc_id: Column) -> Column:
    """0 to 4; rows of fold 0 are held out."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % FOLDS).cast("int")


class Lookup:
    """Values of different keys that are evenly spread 64-bit hashes, 0 for other keys.

    Tables of slots behind one another: a key whose slot is taken goes on, mixed again, to the next, smaller table.
    Most keys that are asked for are there, in the first.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        left, hashes = np.arange(len(keys)), keys
        parts, starts, shifts = [], [0], []
        while len(left) or not parts:
            bits = max(len(left), 2).bit_length()
            shifts.append(64 - bits)
            place = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            _, first = np.unique(place, return_index=True)
            table, own, more = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, values.dtype), np.zeros(1 << bits, bool)
            table[place[first]], own[place[first]] = keys[left[first]], values[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            more[place[rest]] = True
            parts.append((table, own, more))
            starts.append(starts[-1] + len(table))
            left, hashes = left[rest], words.mixed(hashes[rest])
        self.keys, self.values, self.more = (np.concatenate(x) for x in zip(*parts))
        self.starts, self.shifts = np.array(starts), np.array(shifts, np.uint64)

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        out = np.zeros(len(asked))
        at, key, hashes = None, asked, asked
        for start, shift in zip(self.starts.tolist(), self.shifts):
            place = (hashes >> shift).astype(np.int64)
            if start:
                place += start
            met = self.keys[place] == key
            value = self.values[place]
            value *= met
            if at is None:
                out[:] = value
            else:
                out[at] = value
            left = np.flatnonzero(~met)
            left = left[self.more[place[left]]]
            if not len(left):
                break
            at, key, hashes = left if at is None else at[left], key[left], words.mixed(hashes[left])
        return out


@dataclass
class Model:
    """Sorted keys and values of words, pairs and runs, the curve, and the same tables for a join if they are many.

    Among the pairs, a predecessor with the word 0 has the value of all its pairs that are not there.
    """

    held: list[tuple[np.ndarray, np.ndarray]]
    weights: np.ndarray
    table: DataFrame | None = None
    _lookups: dict[int, Lookup] = field(default_factory=dict)
    _sent: Broadcast | None = None
    _kept: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.uint64), np.zeros((0, 4))])

    def features(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros((len(texts), FEATURES))
        for first, hashes, before, bounds, raw, start, end in _expressions(texts):
            values = np.column_stack([self._words(hashes, raw, start, end), self._pairs(before, hashes)])
            out[first : first + len(bounds) - 1] = _summed(values, bounds)
        return out

    def shared(self, docs: DataFrame) -> Broadcast:
        """The tables on their way to all tasks, sent once."""
        if self._sent is None:
            self._sent = docs.sparkSession.sparkContext.broadcast(self.held)
        return self._sent

    def _lookup(self, family: int, asked: np.ndarray) -> np.ndarray:
        if family not in self._lookups:
            self._lookups[family] = Lookup(*self.held[family])
        return self._lookups[family](asked)

    def _pairs(self, before: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        own = self._lookup(PAIR, _pair(before, hashes))
        return np.column_stack([own, np.where(own != 0, 0, self._lookup(PAIR, _context(before)))])

    def _words(self, hashes: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """What ``_runs`` and the words' own evidence say of each word; words met before are looked up."""
        asked, at, back = words.distinct(hashes)
        keys, values = self._kept
        place = np.searchsorted(keys, asked)
        new = np.append(keys, np.uint64(0))[place] != asked
        new[place == len(keys)] = True
        if new.any():
            if len(keys) > KEPT:
                keys, values, new, place = keys[:0], values[:0], np.ones(len(asked), bool), np.zeros(len(asked), np.int64)
            own = _runs(words.taken(raw, start[at[new]], end[at[new]]), lambda asked: self._lookup(GRAM, asked))
            own = np.column_stack([self._lookup(WORD, asked[new]), own])
            self._kept = [np.insert(keys, place[new], asked[new]), np.insert(values, place[new], own, axis=0)]
        keys, values = self._kept
        return values[np.searchsorted(keys, asked)][back]

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights[1:] + self.weights[0], -500, 500)))


def _runs(texts: pa.Array, lookup: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """For each word the sum over its long runs, and the largest value of all and of long runs, 0 at least."""
    out = np.zeros((len(texts), 3))
    for size, word, hashes in words.grams(texts, SIZES):
        value = lookup(hashes)
        there = np.flatnonzero(value)
        word, value = word[there], value[there]
        np.maximum.at(out[:, 1], word, value)
        if size >= LONG:
            out[:, 0] += np.bincount(word, value, len(texts))
            np.maximum.at(out[:, 2], word, value)
    return out


def _summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Features of texts from (word, long runs, largest, largest long, pair, masses) of their words: sums per word and
    per root of their number, relative to the median and as they are; 0 for a text without words."""
    out = np.zeros((len(bounds) - 1, FEATURES))
    live = np.flatnonzero(np.diff(bounds))
    if not len(live):
        return out
    plain = values[:, [0, 1, 4, 5]]
    over = [np.maximum(values[:, c] - o, 0) for c in (2, 3) for o in OVER]
    sums = np.add.reduceat(np.column_stack([plain, *over]), bounds[live])
    n = np.diff(bounds)[live].astype(float)[:, None]
    middle, columns = np.zeros((len(live), plain.shape[1])), np.ascontiguousarray(plain.T)
    for i, (a, b) in enumerate(zip(bounds[live].tolist(), bounds[live + 1].tolist())):
        ordered = np.sort(columns[:, a:b], axis=1)
        middle[i] = (ordered[:, (b - a - 1) // 2] + ordered[:, (b - a) // 2]) / 2
    wide = plain.shape[1]
    whole = np.hstack([sums[:, :wide] - n * middle, sums])
    out[live] = np.stack([whole / n, whole / np.sqrt(n)], axis=2).reshape(len(live), -1)
    return out


def _pair(before: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return words.mixed(words.mixed(before) + hashes)


def _context(before: np.ndarray) -> np.ndarray:
    """Keys of what a predecessor says of any word."""
    return _pair(before, np.zeros(len(before), np.uint64))


def _before(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The predecessor of each word, 0 for the first of a text."""
    before = np.zeros(len(hashes), np.uint64)
    before[1:] = hashes[:-1]
    before[bounds[:-1][bounds[:-1] < len(hashes)]] = 0
    return before


def _expressions(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, ...]]:
    """(number of the first text, words, their predecessors, bounds, bytes, starts, ends), pairs once per text."""
    for first, hashes, bounds, raw, start, end in words.located(texts, size=words.WIDE):
        before = _before(hashes, bounds)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        pair = words.mixed(_pair(before, hashes) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at = np.sort(words.distinct(pair)[1])
        yield first, hashes[at], before[at], np.searchsorted(text[at], np.arange(len(bounds))), raw, start[at], end[at]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _labelled(texts: DataFrame, pairs: bool) -> DataFrame:
    """(key, text, toxic, ordinary) of words or (before, word, toxic, ordinary) of pairs, from (text, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_numpy()
            for first, hashes, before, bounds, raw, start, end in _expressions(batch.column(0)):
                toxic = np.repeat(labels[first : first + len(bounds) - 1], np.diff(bounds)) > 0
                _, at, back = words.distinct(_pair(before, hashes) if pairs else hashes)
                counts = [pa.array(np.bincount(back, x, len(at)).astype(np.int64)) for x in (toxic, ~toxic)]
                if pairs:
                    own = [_signed(before[at]), _signed(hashes[at])]
                    yield pa.RecordBatch.from_arrays([*own, *counts], names=["before", "word", "toxic", "ordinary"])
                else:
                    own = [_signed(hashes[at]), words.taken(raw, start[at], end[at]).cast(pa.binary())]
                    yield pa.RecordBatch.from_arrays([*own, *counts], names=["key", "text", "toxic", "ordinary"])

    keys = ["before", "word"] if pairs else ["key", "text"]
    kinds = ", ".join(f"{k} {'binary' if k == 'text' else 'long'}" for k in keys)
    sent = texts.mapInArrow(run, f"{kinds}, toxic long, ordinary long")
    return sent.groupBy(*keys).agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _keyed(pairs: DataFrame) -> DataFrame:
    """(key, value) of pairs (before, word, value); ``key`` is the hash of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, word = (batch.column(c).to_numpy().view(np.uint64) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([_signed(_pair(before, word)), batch.column(2)], names=["key", "value"])

    return pairs.select("before", "word", "value").mapInArrow(run, "key long, value double")


def _place(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def marks(keys: np.ndarray) -> np.ndarray:
    """A map with a bit set for each of the keys."""
    flags = np.zeros(1 << MAP_BITS, bool)
    flags[_place(keys)] = True
    return np.packbits(flags, bitorder="little")


def _marked(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are on the map: all that were marked, and few others."""
    at = _place(keys)
    return ((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def _marks(keys: DataFrame) -> np.ndarray:
    """The map of a column of keys, of the same size however many they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << MAP_BITS >> 3, np.uint8)
        for batch in batches:
            flags |= marks(batch.column(0).to_numpy().view(np.uint64))
        there = np.flatnonzero(flags.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(flags.view(np.int64)[there])], names=["place", "bits"])

    set_ = keys.mapInArrow(run, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << MAP_BITS >> 6, np.int64)
    out[set_.column("place").to_numpy()] = set_.column("bits").to_numpy()
    return out.view(np.uint8)


def _blobs(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Items bounds[i]:bounds[i+1] of the data as one binary value each."""
    data = np.ascontiguousarray(data)
    wide = data.nbytes // max(len(data), 1)
    offsets = (bounds * wide).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    """The bytes of all binary values behind one another."""
    parts = [np.zeros(0, np.uint8)]
    for chunk in column.chunks:
        array = chunk.cast(pa.large_binary())
        if array.buffers()[2] is not None:
            offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
            parts.append(np.frombuffer(array.buffers()[2], np.uint8)[offsets[0] : offsets[-1]])
    return np.concatenate(parts)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])


def _all_words(texts: DataFrame) -> DataFrame:
    """The different words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, hashes, _, raw, start, end in words.located(batch.column(0)):
                at = words.distinct(hashes)[1]
                yield pa.RecordBatch.from_arrays([words.taken(raw, start[at], end[at]).cast(pa.binary())], names=["text"])

    return texts.select("text").mapInArrow(run, "text binary").distinct()


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of short texts behind one another until they are as large as a slice of texts."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(0).nbytes
        if size >= words.SLICE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _run_counts(found: DataFrame) -> DataFrame:
    """(size, key, toxic, ordinary) of the runs of words (text, toxic, ordinary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches):
            counts = [batch.column(c).to_numpy().astype(np.float64) for c in (1, 2)]
            for size, word, hashes in words.grams(batch.column(0), SIZES):
                key, back = np.unique(hashes, return_inverse=True)
                sums = [pa.array(np.bincount(back, c[word], len(key)).astype(np.int64)) for c in counts]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), size, np.int32)), _signed(key), *sums], names=["size", "key", "toxic", "ordinary"])

    sent = found.select("text", "toxic", "ordinary").mapInArrow(run, "size int, key long, toxic long, ordinary long")
    return sent.groupBy("size", "key").agg(*[F.sum(c).alias(c) for c in ("toxic", "ordinary")])


def _places(found: DataFrame, only: np.ndarray) -> DataFrame:
    """(size, key, kinds): in how many places of the words (text) the runs ``only`` of a map are; key null has all runs of a size.

    A task sends nearly every run on the map, however few words it has, so it takes the words of several partitions.
    """
    shared = found.sparkSession.sparkContext.broadcast(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches):
            for size, _, hashes in words.grams(batch.column(0), SIZES):
                key, kinds = np.unique(hashes[_marked(shared.value, hashes)], return_counts=True)
                keys = pa.array(np.append(key.view(np.int64), 0), mask=np.append(np.zeros(len(key), bool), True))
                columns = [pa.array(np.full(len(key) + 1, size, np.int32)), keys, pa.array(np.append(kinds, len(hashes)))]
                yield pa.RecordBatch.from_arrays(columns, names=["size", "key", "kinds"])

    spark = found.sparkSession
    few = found.select("text").coalesce(max(spark.sparkContext.defaultParallelism, default_shuffles(spark) // TOGETHER))
    return few.mapInArrow(run, "size int, key long, kinds long").groupBy("size", "key").agg(F.sum("kinds").alias("kinds"))


def _predecessors(texts: DataFrame, only: np.ndarray | None) -> DataFrame:
    """(word, kinds): different predecessors of words, ``only`` of those on a map; word null has an estimate of all pairs.

    A task sends its different pairs in buckets of words, a word with ``OWN`` bytes of its predecessors' hashes;
    those of a word are dealt into four buckets.
    """
    shared = None if only is None else texts.sparkSession.sparkContext.broadcast(only)
    buckets = BUCKETS * default_shuffles(texts.sparkSession)
    names = ["bucket", "words", "sizes", "own"]

    def parts(word: np.ndarray, own: np.ndarray) -> np.ndarray:
        return words.mixed(word + (own >> np.uint64(62)))

    def sent(word: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
        # One sort brings parts of words, and equal pairs in them, together. Where 44 bits of two parts are equal they
        # may alternate: more entries then, and pairs sent twice, which are counted once all the same.
        low = np.uint64((1 << 20) - 1)
        key = parts(word, own)
        key &= ~low
        key |= own & low
        order = np.argsort(key)
        del key
        word, own = word[order], own[order]
        del order
        new = np.append(True, (word[1:] != word[:-1]) | (own[1:] != own[:-1]))
        word, own = word[new], own[new]
        group = parts(word, own)
        first = _starts(group)
        bucket = ((group[first] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        cut = _starts(bucket)
        bounds, sizes = np.append(cut, len(first)), np.diff(np.append(first, len(word))).astype(np.uint32)
        data = np.ascontiguousarray(own.view(np.uint8).reshape(-1, 8)[:, :OWN])
        blobs = [_blobs(word[first], bounds), _blobs(sizes, bounds), _blobs(data, np.append(first, len(word))[bounds])]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut]), *blobs], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        registers, gathered, n = np.zeros(REGISTERS, np.uint8), np.empty((2, GATHERED), np.uint64), 0
        for batch in batches:
            for _, word, bounds, *_ in words.located(batch.column(0)):
                own = _before(word, bounds)
                pair = _pair(own, word)
                rank = (51 - np.frexp((pair >> np.uint64(14)).astype(np.float64))[1]).astype(np.uint8)
                np.maximum.at(registers, (pair & np.uint64(REGISTERS - 1)).astype(np.int64), rank)
                if shared is not None:
                    there = _marked(shared.value, word)
                    word, own = word[there], own[there]
                while len(word):
                    some = min(len(word), GATHERED - n)
                    gathered[:, n : n + some] = word[:some], own[:some]
                    word, own, n = word[some:], own[some:], n + some
                    if n == GATHERED:
                        yield sent(*gathered)
                        n = 0
        if n:
            yield sent(*gathered[:, :n])
        chunks = REGISTERS // CHUNK
        blobs = _blobs(registers, np.arange(chunks + 1) * CHUNK)
        none = pa.array([b""] * chunks, pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(-1 - np.arange(chunks, dtype=np.int32)), none, none, blobs], names=names)

    def counted(table: pa.Table) -> pa.Table:
        own = _flat(table.column("own"))
        if table.column("bucket")[0].as_py() < 0:
            ranks = own.reshape(-1, CHUNK).max(axis=0)
            sums = [(2.0 ** -ranks.astype(float)).sum()], [int((ranks == 0).sum())]
            return pa.table([pa.array([None], pa.int64()), *map(pa.array, sums)], names=["word", "kinds", "unset"])
        key = np.repeat(_flat(table.column("words")).view(np.uint64), _flat(table.column("sizes")).view(np.uint32))
        wide = np.zeros((len(key), 8), np.uint8)
        wide[:, :OWN] = own.reshape(-1, OWN)
        at = np.unique(_pair(wide.view(np.uint64)[:, 0], key), return_index=True)[1]
        found, kinds = np.unique(key[at], return_counts=True)
        return pa.table([_signed(found), pa.array(kinds.astype(float)), pa.array(np.zeros(len(found), np.int64))], names=["word", "kinds", "unset"])

    dealt = texts.select("text").mapInArrow(run, "bucket int, words binary, sizes binary, own binary")
    sums = dealt.groupBy("bucket").applyInArrow(counted, "word long, kinds double, unset long").groupBy("word").agg(F.sum("kinds").alias("kinds"), F.sum("unset").alias("unset"))
    # The registers' part of a count of different pairs: by harmonic mean, by those unset while they are many.
    guess = 0.7213 / (1 + 1.079 / REGISTERS) * REGISTERS * REGISTERS / F.col("kinds")
    few = (F.col("unset") > 0) & (guess <= 2.5 * REGISTERS)
    estimate = F.when(few, REGISTERS * F.log(REGISTERS / F.col("unset"))).otherwise(guess)
    return sums.select("word", F.when(F.col("word").isNull(), estimate).otherwise(F.col("kinds")).alias("kinds"))


@dataclass
class Discounts:
    """Counts of both classes, the mass given to the shared counts, the ordinary class's discount."""

    toxic: float
    ordinary: float
    given: float
    high: float

    @classmethod
    def of(cls, counts: np.ndarray, times: np.ndarray, toxic: np.ndarray) -> Discounts | None:
        """From how many expressions have each count in each class; none without counts of both."""
        totals = [float((counts * times)[toxic == c].sum()) for c in (1, 0)]
        if not min(totals):
            return None
        taken = lambda c, d: (np.minimum(counts, d) * times)[toxic == c].sum()
        given = taken(1, DISCOUNT) / totals[0]
        low, high = 0.0, float(counts[toxic == 0].max())
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if taken(0, middle) / totals[1] < given else (low, middle)
        return cls(*totals, float(given), high)

    def says(self) -> Column:
        return (F.col("toxic") > DISCOUNT) | (F.col("ordinary") > self.high)

    def ratio(self, shared: Column) -> Column:
        """Log ratio of the smoothed chances of an expression."""
        return F.log(self._chance("toxic", self.toxic, self.given, shared) / self._chance("ordinary", self.ordinary, self.given, shared))

    def _chance(self, name: str, total: Column | float, freed: Column | float, shared: Column) -> Column:
        taken = DISCOUNT if name == "toxic" else self.high
        own = F.greatest(F.col(name) - taken, F.lit(0.0)) / total
        return F.coalesce(own, F.lit(0.0)) + freed * shared

    def contexts(self, pairs: DataFrame) -> DataFrame:
        """(_b, t, o, freed_t, freed_o): counts of the predecessors in both classes, the part that the discounts set free."""
        out = pairs.groupBy(F.col("before").alias("_b"))
        sums = {"t": ("toxic", DISCOUNT), "o": ("ordinary", self.high)}
        out = out.agg(*[F.sum(c).alias(n) for n, (c, _) in sums.items()], *[F.sum(F.least(F.col(c), F.lit(float(d)))).alias(f"_{n}") for n, (c, d) in sums.items()])
        freed = {n: F.when(F.col(n) > 0, F.col(f"_{n}") / F.col(n)).otherwise(1.0).alias(f"freed_{n}") for n in sums}
        return out.select("_b", *[F.when(F.col(n) > 0, F.col(n)).alias(n) for n in sums], *freed.values())

    def conditional(self, shared: Column) -> Column:
        """Log ratio of the chances of a pair beside the columns of its context."""
        return F.log(self._chance("toxic", F.col("t"), F.col("freed_t"), shared) / self._chance("ordinary", F.col("o"), F.col("freed_o"), shared))


def _discounts(counts: DataFrame, by: str | None = None) -> dict[int, Discounts | None]:
    both = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(n).alias("n")) for c, n in ((1, "toxic"), (0, "ordinary"))]))
    seen = counts.select((F.col(by) if by else F.lit(0)).alias("by"), both.alias("x")).where("x.n > 0")
    seen = seen.groupBy("by", F.col("x.c").alias("c"), F.col("x.n").alias("n")).agg(F.count("*").alias("times")).toPandas()
    return {int(k): Discounts.of(*(x[c].to_numpy() for c in ("n", "times", "c"))) for k, x in seen.groupby("by")}


def _evidence(known: DataFrame, texts: DataFrame) -> DataFrame | None:
    """(family, key, value) of all expressions with a ratio other than 0, from labelled rows and all texts."""
    spark = known.sparkSession
    whole = {n: scratch_path(spark, f"toxic-{n}") for n in ("words", "runs", "pairs")}
    own_words = stored(_labelled(known, False), "words", whole["words"])
    runs = stored(_run_counts(own_words), "runs", whole["runs"])
    of_words, sizes = _discounts(own_words).get(0), {size: d for size, d in _discounts(runs, "size").items() if d is not None}
    # Only what says something is kept: whole counts leave the shared folder before larger ones are made.
    says = reduce(lambda a, b: a | b, [(F.col("size") == size) & d.says() for size, d in sizes.items()], F.lit(False))
    some = stored(runs.where(says), "toxic-said-runs")
    said = stored(own_words.where(of_words.says()) if of_words else own_words.where(F.lit(False)), "toxic-said-words")
    dropped(spark, whole["words"], whole["runs"])
    if of_words is None:
        return None
    own_pairs = stored(_labelled(known, True), "pairs", whole["pairs"])
    of_pairs = _discounts(own_pairs)[0]
    pairs = stored(own_pairs.where(of_pairs.says()), "toxic-said-pairs")
    contexts = stored(of_pairs.contexts(own_pairs).where("freed_t < 1 or freed_o < 1"), "toxic-contexts")
    dropped(spark, whole["pairs"])
    kinds = stored(_predecessors(texts, _marks(said.select("key").union(pairs.select("word")))), "toxic-kinds")
    total = float(kinds.where("word is null").first()["kinds"])
    shares = kinds.select(F.col("word").alias("_w"), (F.col("kinds") / total).alias("shared")).where("_w is not null")
    valued = pairs.join(shares, F.col("word") == F.col("_w")).join(contexts, F.col("before") == F.col("_b"))
    alone = contexts.select(F.col("_b").alias("before"), F.lit(0).cast("long").alias("word"), F.log(F.col("freed_t") / F.col("freed_o")).alias("value"))
    found = [
        said.join(shares, F.col("key") == F.col("_w")).select(F.lit(WORD).alias("family"), "key", of_words.ratio(F.col("shared")).alias("value")),
        _keyed(valued.select("before", "word", of_pairs.conditional(F.col("shared")).alias("value")).unionByName(alone)).select(F.lit(PAIR).alias("family"), "key", "value"),
    ]
    if sizes:
        counts = stored(_places(_all_words(texts), _marks(some.select("key"))), "toxic-places")
        places = {r["size"]: r["kinds"] for r in counts.where("key is null").collect()}
        of_places = counts.where("key is not null").select(F.col("size").alias("_s"), F.col("key").alias("_k"), F.col("kinds").alias("_places"))
        met = some.join(of_places, (F.col("size") == F.col("_s")) & (F.col("key") == F.col("_k")))
        values = [F.when(F.col("size") == size, d.ratio(F.col("_places") / float(places[size]))) for size, d in sizes.items()]
        found.append(met.select(F.lit(GRAM).alias("family"), "key", F.coalesce(*values).alias("value")))
    return stored(reduce(DataFrame.unionByName, found), "toxic-evidence")


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and slopes, none below 0: more evidence never makes a text less toxic."""
    live = np.arange(x.shape[1])
    while True:
        w = _newton(x[:, live], y)
        if not (w[1:] < 0).any():
            break
        live = np.delete(live, (w[1:] * np.maximum(x[:, live].std(axis=0), 1e-9)).argmin())
    out = np.zeros(x.shape[1] + 1)
    out[0], out[1 + live] = w[0], w[1:]
    return out


def _newton(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and slopes by Newton steps, slopes held down a little.

    A step is halved until the loss falls: a full one can leap to where every row is certain, and never comes back.
    """
    scale = np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.ones(len(x)), x / scale])
    w, hold = np.zeros(z.shape[1]), np.array([1e-6, *[1e-2] * x.shape[1]])

    def loss(w: np.ndarray) -> float:
        at = z @ w
        return float((np.logaddexp(0, at) - y * at).sum() + (hold * w * w).sum() / 2)

    now = loss(w)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(hold), z.T @ (y - p) - hold * w)
        while (ahead := loss(w + step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if ahead > now:
            break
        w, now = w + step, ahead
        if np.abs(step).max() < 1e-9:
            break
    return np.array([w[0], *(w[1:] / scale)])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from all texts and the labels of the rows that are not held out."""
    known = (
        labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) > 0))
        .groupBy(F.col("doc_id").alias("_labelled"))
        .agg(F.max("toxic").cast("long").alias("_toxic"))
    )
    n = known.count()
    chosen = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    joined = chosen.join(F.broadcast(known) if n <= HELD_IDS else known, F.col("_id") == F.col("_labelled"))
    rows = joined.select("text", F.col("_toxic").alias("toxic"), fold(F.col("_id")).alias("fold"), "_id")
    # Fold 1 fits the curve and is counted without its label.
    table = _evidence(rows.where("fold > 1").select("text", "toxic"), docs)
    none = np.zeros(0, np.uint64), np.zeros(0, np.float32)
    model = Model([none] * 3, np.zeros(FEATURES + 1))
    if table is not None and table.count() > HELD:
        model.table = table
    elif table is not None:
        for family in (WORD, PAIR, GRAM):
            own = table.where(F.col("family") == family).select("key", F.col("value").cast("float")).toArrow()
            keys, order = np.unique(own.column("key").to_numpy().view(np.uint64), return_index=True)
            model.held[family] = keys, own.column("value").to_numpy()[order]

    def part(all_folds: bool) -> DataFrame:
        some = rows if all_folds else rows.where("fold = 1")
        return some.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int((1 << 20) * min(1, sample * (1 if all_folds else 4) / max(n, 1))))

    seen = _featured(part(False).select("text", "toxic"), model).select("row.toxic", "x").toPandas()
    if seen["toxic"].nunique() != 2:
        seen = _featured(part(True).select("text", "toxic"), model).select("row.toxic", "x").toPandas()
    y = seen["toxic"].to_numpy(float)
    if seen["toxic"].nunique() == 2:
        model.weights = _logistic(np.array(seen["x"].to_list(), float), y)
    else:
        share = float(y.mean()) if len(y) else 0.0
        model.weights[0] = 500.0 if share == 1 else -500.0
    return model


def _featured(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (the whole input row) and the features ``x`` of its text."""
    rows = packed(docs)
    if model.table is not None:
        return _joined(rows, model.table)
    shared = model.shared(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(shared.value, np.zeros(0))
        for batch in batches:
            x = own.features(batch.column(0).field("text"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["row", "x"])

    return rows.mapInArrow(run, packed(docs).schema.add("x", ArrayType(DoubleType())))


def _joined(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The same by joins, for more expressions than a task can hold: texts' words meet their values in a shuffle.

    A word is looked up once, and its values are dealt ``PARTS`` times, so that a frequent one spans tasks.
    """
    numbered = stored(rows.withColumn("_n", F.monotonically_increasing_id()), "toxic-rows")

    def said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(1).to_numpy()
            for first, hashes, before, bounds, *_ in _expressions(batch.column(0)):
                n = np.repeat(numbers[first : first + len(bounds) - 1], np.diff(bounds))
                columns = [pa.array(n), _signed(hashes), _signed(_pair(before, hashes)), _signed(_context(before))]
                yield pa.RecordBatch.from_arrays(columns, names=["n", "word", "pair", "context"])

    def run_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            own = np.concatenate([h for _, h, *_ in words.located(texts.cast(pa.string()))])
            for size, word, hashes in words.grams(texts, SIZES):
                columns = [_signed(own[word]), pa.array(np.full(len(word), size >= LONG)), _signed(hashes)]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "long", "run"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            bounds = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
            flat = lists.flatten()
            values = np.column_stack([flat.field(i).to_numpy() for i in range(6)])
            x = _summed(values, bounds)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["n", "x"])

    def of(family: int, name: str) -> DataFrame:
        return table.where(F.col("family") == family).select(F.col("key").alias(name), F.col("value").alias(f"{name}_value"))

    texts = numbered.select(F.col("row.text").alias("text"), "_n")
    runs = _all_words(texts).select("text").mapInArrow(run_keys, "word long, long boolean, run long").join(of(GRAM, "run"), "run")
    value, of_long = F.col("run_value"), F.when(F.col("long"), F.col("run_value"))
    by_run = runs.groupBy("word").agg(*[F.coalesce(f, F.lit(0.0)).alias(n) for n, f in (("total", F.sum(of_long)), ("top", F.max(value)), ("top_long", F.max(of_long)))])
    own = of(WORD, "word").join(by_run, "word", "full").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    none = F.lit(0.0)
    met = (
        texts.mapInArrow(said, "n long, word long, pair long, context long")
        .withColumn("part", F.pmod("n", F.lit(PARTS)).cast("int"))
        .join(own, ["word", "part"], "left")
        .join(of(PAIR, "pair"), "pair", "left")
        .join(of(PAIR, "context"), "context", "left")
        .withColumn("masses", F.when(F.coalesce("pair_value", none) == 0, F.col("context_value")))
    )
    values = F.struct(
        *[F.coalesce(F.greatest(c, none) if c.startswith("top") else F.col(c), none).alias(c) for c in ("word_value", "total", "top", "top_long", "pair_value", "masses")]
    )
    x = met.groupBy("n").agg(F.collect_list(values).alias("v")).mapInArrow(summed, "n long, x array<double>")
    empty = F.array(*[none] * FEATURES)
    return numbered.join(x, F.col("_n") == F.col("n"), "left").select("row", F.coalesce("x", empty).alias("x"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (the whole input row) and its toxicity ``score``."""
    at = F.aggregate(
        F.zip_with("x", F.array(*map(F.lit, model.weights[1:].tolist())), lambda a, b: a * b), F.lit(float(model.weights[0])), lambda s, v: s + v
    )
    return _featured(docs, model).select("row", (1 / (1 + F.exp(-F.greatest(F.least(at, F.lit(500.0)), F.lit(-500.0))))).alias("score"))
