"""Contiguous records of a fixed width: written one file per range partition with its cut points, read in ranges.

A file holds 100-byte records without line ends, so any record is found by arithmetic and files are read by many
tasks. The writer stores the first key of every part beside the parts; readers of the cut points can say in which
part a key must lie, and ``partition_check`` holds every part to that.

Paths are opened in the tasks by ``pyarrow.fs``: local and mounted folders, and the stores it has a client for.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "flowops_records"
# The widths of a record and its key, and the names of the cut points and of the mark of a whole output.
KEY_BYTES = 10
RECORD_BYTES = 100
CUT_POINTS = "_partition.lst"
DONE = "_SUCCESS"
# Bytes of a range, and of what is decoded at once; whole records.
RANGE_BYTES = 1_280_000 * RECORD_BYTES
BLOCK_BYTES = 40_000 * RECORD_BYTES

SCHEMA = "key string, payload string, archivo string, inicio bigint"


@dataclass
class Range(InputPartition):
    path: str
    first: int
    end: int


@dataclass
class Part(WriterCommitMessage):
    """A file a task has written: its number, its name so far, rows, first key."""

    number: int
    draft: str
    rows: int
    first: str | None


def parts_of(path: str) -> tuple[pa.fs.FileSystem, str, list[tuple[str, int]]]:
    """The store, the folder, and (file, size) of its parts in order."""
    system, root = pa.fs.FileSystem.from_uri(path)
    found = system.get_file_info(pa.fs.FileSelector(root))
    return system, root, sorted((i.path, i.size) for i in found if i.is_file and i.base_name.startswith("part-"))


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.range_bytes = options["path"], int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[Range]:
        system, root, parts = parts_of(self.path)
        if system.get_file_info(f"{root}/{DONE}").type == pa.fs.FileType.NotFound:
            raise FileNotFoundError(f"no {DONE} in {self.path}: the output is not whole")
        odd = [p for p, size in parts if size % RECORD_BYTES]
        if odd:
            raise ValueError(f"not a whole number of records: {odd[0]}")
        step = max(self.range_bytes // RECORD_BYTES, 1) * RECORD_BYTES
        return [Range(p, at, min(at + step, size)) for p, size in parts for at in range(0, size, step)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.first == partition.end:
            return
        system = pa.fs.FileSystem.from_uri(self.path)[0]
        with system.open_input_file(partition.path) as file:
            file.seek(partition.first)
            for at in range(partition.first, partition.end, BLOCK_BYTES):
                raw = np.frombuffer(file.read(min(BLOCK_BYTES, partition.end - at)), np.uint8).reshape(-1, RECORD_BYTES)
                cells = [_texts(raw[:, :KEY_BYTES]), _texts(raw[:, KEY_BYTES:])]
                place = [pa.repeat(partition.path, len(raw)), pa.repeat(pa.scalar(partition.first, pa.int64()), len(raw))]
                yield pa.RecordBatch.from_arrays([*cells, *place], names=["key", "payload", "archivo", "inicio"])


def _texts(cells: np.ndarray) -> pa.Array:
    """Rows of bytes as texts."""
    width = cells.shape[1]
    offsets = np.arange(len(cells) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(cells), [None, pa.py_buffer(offsets), pa.py_buffer(cells.tobytes())]).cast(pa.string())


class Writer(DataSourceArrowWriter):
    """Each task writes a draft; the commit gives the drafts their names, then come cut points and the mark."""

    def __init__(self, path: str):
        self.path, self.run = path, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        system, root = pa.fs.FileSystem.from_uri(self.path)
        system.create_dir(root)
        number, rows, first = TaskContext.get().partitionId(), 0, None
        draft = f"{root}/_draft-{self.run}-{TaskContext.get().taskAttemptId()}"
        with system.open_output_stream(draft) as out:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                cells = [batch.column(n).cast(pa.binary()) for n in ("key", "payload")]
                for cell, width in zip(cells, (KEY_BYTES, RECORD_BYTES - KEY_BYTES)):
                    sizes = cell.value_lengths() if hasattr(cell, "value_lengths") else pa.compute.binary_length(cell)
                    if cell.null_count or pa.compute.min_max(sizes).as_py() != {"min": width, "max": width}:
                        raise ValueError(f"a record must be a key of {KEY_BYTES} bytes and a payload up to {RECORD_BYTES}")
                first = cells[0][0].as_py().decode() if first is None else first
                whole = [np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in cells]
                out.write(np.concatenate(whole, axis=1).tobytes())
                rows += batch.num_rows
        return Part(number, draft, rows, first)

    def commit(self, messages: list[Part | None]) -> None:
        system, root = pa.fs.FileSystem.from_uri(self.path)
        kept = sorted((m for m in messages if m), key=lambda m: m.number)
        filled = [m for m in kept if m.rows]
        for i, part in enumerate(filled):
            system.move(part.draft, f"{root}/part-r-{i:05d}")
        for part in kept:
            if not part.rows:
                system.delete_file(part.draft)
        with system.open_output_stream(f"{root}/{CUT_POINTS}") as out:
            out.write("".join(p.first for p in filled[1:]).encode())
        with system.open_output_stream(f"{root}/{DONE}"):
            pass

    def abort(self, messages: list[Part | None]) -> None:
        system = pa.fs.FileSystem.from_uri(self.path)[0]
        for part in messages:
            if part:
                system.delete_file(part.draft)


class Records(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return Reader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return Writer(self.options["path"])


def write_contiguous(df: DataFrame, path: str) -> None:
    """(key, payload) rows as records without line ends, one file per partition in the order of the frame.

    The folder is new. It is whole once it has its mark; a failed write leaves parts under no name that is read.
    """
    df.sparkSession.dataSource.register(Records)
    df.select("key", "payload").write.format(FORMAT).mode("append").option("path", path).save()


def read_contiguous(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records as key and payload, with the file and the first byte of the range they were read from."""
    spark.dataSource.register(Records)
    return spark.read.format(FORMAT).options(path=path, rangeBytes=str(range_bytes)).load()


def cut_points(path: str) -> list[str]:
    """The stored first keys of all parts but the first: one key a part."""
    system, root = pa.fs.FileSystem.from_uri(path)
    with system.open_input_stream(f"{root}/{CUT_POINTS}") as stream:
        raw = stream.read().decode()
    return [raw[i : i + KEY_BYTES] for i in range(0, len(raw), KEY_BYTES)]


def partition_check(records: DataFrame, path: str) -> DataFrame:
    """Whether every part lies between its cut points: partes, cortes, registros, fuera (records outside), ok.

    A cut point may end one part and begin the next, as copies of one key can span parts.
    """
    cuts = cut_points(path)
    order = [p for p, _ in parts_of(path)[2]]
    spark = records.sparkSession
    bounds = [(p, cuts[i - 1] if i else None, cuts[i] if i < len(cuts) else None) for i, p in enumerate(order)]
    # One row a part.
    limits = spark.createDataFrame(bounds, "archivo string, desde string, hasta string")
    per_part = records.groupBy("archivo").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    outside = (F.col("low") < F.col("desde")) | (F.col("high") > F.col("hasta"))
    found = per_part.join(limits, "archivo", "left").agg(
        F.count(F.lit(1)).alias("partes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("registros"),
        F.count_if(F.coalesce(outside, F.lit(False))).alias("fuera"),
    )
    whole = (F.col("fuera") == 0) & (F.lit(len(cuts)) == F.greatest(F.col("partes") - 1, F.lit(0)))
    return found.select("registros", "fuera", whole.alias("ok"))
