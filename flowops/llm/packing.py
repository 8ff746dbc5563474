"""Best-two-fit packing of tokenised documents into sequences of bounded length.

Lengths are whole numbers up to the sequence length, so the packing is decided on the histogram of piece
lengths: fill a sequence greedily with the longest piece that fits, then replace its smallest piece by two
unpacked pieces that fit the expanded gap more tightly, while that helps. A content that can be repeated is
repeated at once, for all its pieces. The driver sees the histogram and the list of contents, never a piece;
the n-th piece of a length then takes the n-th place of that length.

Defined cases: a null or empty text is one piece of the end token; equal doc_ids are packed row by row; a
null doc_id stays null. Only documents longer than a sequence are cut; the first piece takes the remainder.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from flowops.llm.common import stored

RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
END = 2
LENGTH = 1024

_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of a rank file; the special string in a text is its token."""
    if path not in _encodings:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
        )
    return _encodings[path]


def pieces_of(docs: DataFrame, length: int = LENGTH, end: int = END, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, the task that cut it (part) and how many
    pieces of its length that task had cut before (place). ``with_ids`` adds the ids themselves, little-endian
    and as wide as the vocabulary needs: two bytes each up to 65,536 tokens."""
    path = path or public_tokenizers.path(RANKS)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_to_numpy
        kind = np.min_scalar_type(max(encoding(path).max_token_value, end, 256)).newbyteorder("<")
        part = TaskContext.get().partitionId()
        cut = np.zeros(length + 1, np.int64)
        tail = np.array([end], np.uint32)
        for batch in batches:
            rows: list[tuple] = []
            kept: list[bytes] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([encode(text.as_py() or "", allowed_special="all"), tail]).astype("<u4", copy=False)
                # All pieces but the first are full.
                starts = [0, *range(len(ids) % length or length, len(ids), length)]
                for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    own = ids[start:stop]
                    n = len(own)
                    rows.append((doc, piece, start, n, zlib.crc32(own.tobytes()), part, int(cut[n])))
                    cut[n] += 1
                    if with_ids:
                        kept.append(own.astype(kind).tobytes())
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(types), types)]
            if with_ids:
                columns.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *["ids"] * with_ids])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema + ", ids binary" * with_ids)


def _unpacked(ids: pa.Array, length: np.ndarray) -> pa.Array:
    """Lists of ids from their bytes; all ids of a table are equally wide."""
    data, total = b"".join(ids.to_pylist()), int(length.sum())
    flat = np.frombuffer(data, f"<u{len(data) // total}" if total else "<u2")
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)).astype(np.int32)), pa.array(flat.astype(np.int32)))


def contents(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, list[int]]]:
    """(how many sequences, lengths of their pieces in falling order) for a histogram of piece lengths."""
    left = np.zeros(length + 1, np.int64)
    for size, n in histogram.items():
        left[size] = n

    def largest(limit: int, counts: np.ndarray) -> int:
        found = np.flatnonzero(counts[1 : limit + 1])
        return int(found[-1]) + 1 if len(found) else 0

    out = []
    while left.any():
        rest, gap, taken = left.copy(), length, []
        while gap and (size := largest(gap, rest)):
            n = min(gap // size, int(rest[size]))
            taken += [size] * n
            rest[size] -= n
            gap -= n * size
        while gap and (pair := _pair(rest, gap + taken[-1], taken[-1])):
            gap += taken[-1] - sum(pair)
            rest[taken.pop()] += 1
            for size in pair:
                rest[size] -= 1
            taken = sorted([*taken, *pair], reverse=True)
        sizes, needed = np.unique(taken, return_counts=True)
        times = int((left[sizes] // needed).min())
        left[sizes] -= times * needed
        out.append((times, taken))
    return out


def _pair(rest: np.ndarray, gap: int, more_than: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum up to ``gap``, if it is over ``more_than``."""
    there = np.flatnonzero(rest[: gap + 1])
    if not len(there):
        return None
    fits = np.zeros(gap + 1, np.int64)
    fits[there] = there
    fits = np.maximum.accumulate(fits)
    other = fits[gap - there]
    # A length paired with itself needs two; the next smaller one is the other choice.
    alone = (other == there) & (rest[there] < 2)
    other[alone] = fits[np.maximum(there[alone] - 1, 0)]
    sums = np.where(other > 0, there + other, 0)
    best = int(np.argmax(sums))
    return (int(there[best]), int(other[best])) if sums[best] > more_than else None


def _places(found: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first number of the length, pieces of it per sequence, first sequence, offset), sorted."""
    rows, used, sequence = [], {}, 0
    for times, taken in found:
        offset = 0
        for size in sorted(set(taken), reverse=True):
            n = taken.count(size)
            rows.append((size, used.get(size, 0), n, sequence, offset))
            used[size] = used.get(size, 0) + times * n
            offset += n * size
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def best_two_fit(
    docs: DataFrame, length: int = LENGTH, end: int = END, path: str | None = None, with_ids: bool = False, with_uses: bool = False
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``; offsets are gapless from 0.

    ``with_uses`` tells equal pieces of a doc_id apart by ``use``, from 0 in the order of their places.
    """
    pieces = stored(pieces_of(docs, length, end, path, with_ids), "pieces")
    per_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(per_task.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-starts")
    histogram = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(contents(histogram, length))
    lookup = (places[:, 0] << 44) | places[:, 1]
    numbered = pieces.join(starts.drop("n"), ["part", "length"]).withColumn("number", F.col("first") + F.col("place"))
    given = [c for c in pieces.columns if c not in ("part", "place")]
    source, added = numbered.select(*given, "number"), ["sequence_id long", "offset long"]
    if with_uses:
        # Numbers of a length rise with sequence and offset. Pieces move here, so their ids are still narrow.
        equal = Window.partitionBy("doc_id", "piece", "length", "ids_crc32").orderBy("number")
        source = source.withColumn("use", F.row_number().over(equal) - 1)
        added.append("use int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = places[np.searchsorted(lookup, (size << 44) | number, "right") - 1]
            n = number - at[:, 1]
            sequence, offset = at[:, 3] + n // at[:, 2], at[:, 4] + n % at[:, 2] * size
            own = [_unpacked(batch.column(c), size) if c == "ids" else batch.column(c) for c in given]
            uses = [batch.column("use")] if with_uses else []
            yield pa.RecordBatch.from_arrays([*own, pa.array(sequence), pa.array(offset), *uses], names=[*given, *[c.split()[0] for c in added]])

    kinds = [f"{c} {'array<int>' if c == 'ids' else kind}" for c, kind in source.select(*given).dtypes]
    return source.mapInArrow(run, ", ".join([*kinds, *added]))
