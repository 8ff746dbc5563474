"""A source of class directories that loses nothing: every listed file is counted, every odd line is a row.

Files are planned into byte ranges of bounded size, so one file is read by many tasks and a task reads many small
files. Lines end at a line feed, a carriage return before it is no part of them, and they have no quotes: a line
is a row if it has as many fields as the header. Blank lines, lines with other field counts and lines that are not
UTF-8 are rejected with their place and reason. Every file's header is compared with the expected one.

Paths are opened in the tasks by ``pyarrow.fs``: local and mounted folders, and the stores it has a client for.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Tasks get the reader itself, so that executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "flowops_class_directories"
# Bytes of a range, and of the files of one task, at most 64 of them; one line may be longer.
RANGE_BYTES = 128 << 20
# Bytes worked on together.
BLOCK_BYTES = 4 << 20

OK = "ok"
NO_HEADER = "sin_cabecera"
REPEATED = "columnas_repetidas"
LABELLED = "etiqueta_presente"
OTHER = "cabecera_distinta"
BLANK = "vacia"
FIELDS = "campos"
ENCODING = "codificacion"

SCAN = (
    "archivo string, inicio bigint, lineas bigint, filas bigint, cabecera string, estado string, "
    "indice bigint, posicion bigint, motivo string, campos bigint, texto string"
)


@dataclass
class Ranges(InputPartition):
    """(path, size, first byte, byte after the last) of what one task reads."""

    parts: list[tuple[str, int, int, int]]


def listed(path: str, suffix: str) -> tuple[pa.fs.FileSystem, str, list[tuple[str, int]]]:
    """The store, its prefix in URIs, and (path, size) of all files below ``path``; hidden ones are left out."""
    system, root = pa.fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else unquote(path))
    found = []
    for info in system.get_file_info(pa.fs.FileSelector(root, recursive=True)):
        below = info.path[len(root.rstrip("/")) + 1 :].split("/")
        hidden = any(p[:1] in ("_", ".") and "=" not in p for p in below)
        if info.is_file and not hidden and below[-1].lower().endswith(suffix):
            found.append((info.path, info.size))
    prefix = path[: path.find("://") + 3] if "://" in path else "file://"
    return system, prefix, sorted(found, key=lambda f: (f[0].lower(), f[0]))


def header_of(system: pa.fs.FileSystem, path: str) -> tuple[list[str] | None, int]:
    """Column names in the first line, None for a file without bytes, and the place of the first byte after it."""
    with system.open_input_stream(path) as stream:
        held = b""
        while b"\n" not in held and (data := stream.read(1 << 16)):
            held += data
    if not held:
        return None, 0
    line, end, _ = held.partition(b"\n")
    text = line.removesuffix(b"\r").decode("utf-8-sig", "replace")
    return text.split(","), len(line) + len(end)


def state_of(names: list[str] | None, expected: list[str], label: str) -> str:
    if names is None:
        return NO_HEADER
    if len(set(names)) < len(names):
        return REPEATED
    if label in names:
        return LABELLED
    return OK if names == expected else OTHER


def line_blocks(stream, first: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of blocks of whole lines that begin from ``first`` on and before ``end``."""
    held, at = b"", first
    while at < end:
        data = stream.read(BLOCK_BYTES)
        if not data:
            if held:
                yield at, held
            return
        held += data
        cut = held.rfind(b"\n") + 1
        if at + cut > end:
            cut = held.find(b"\n", max(0, end - 1 - at)) + 1
        if cut:
            yield at, held[:cut]
            at, held = at + cut, held[cut:]


def first_line(system: pa.fs.FileSystem, path: str, at: int) -> int:
    """Where the first line begins that does not begin before ``at``."""
    with system.open_input_file(path) as file:
        file.seek(at - 1)
        seen = at - 1
        while data := file.read(1 << 16):
            if b"\n" in data:
                return seen + data.index(b"\n") + 1
            seen += len(data)
    return seen


def judged(block: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line of a block, its number of fields, and its reason: 0 a row, 1 blank, 2 fields, 3 encoding."""
    raw = np.frombuffer(block, np.uint8)
    ends = np.flatnonzero(raw == 10)
    if not len(ends) or ends[-1] != len(raw) - 1:
        ends = np.append(ends, len(raw))
    starts = np.concatenate([[0], ends[:-1] + 1])
    stops = ends - ((ends > starts) & (raw[np.maximum(ends - 1, 0)] == 13))
    commas = np.flatnonzero(raw == 44)
    fields = np.searchsorted(commas, stops) - np.searchsorted(commas, starts) + 1
    reason = np.where(stops == starts, 1, np.where(fields != width, 2, 0))
    try:
        block.decode()
    except UnicodeDecodeError:
        for i in np.flatnonzero(reason == 0).tolist():
            try:
                block[starts[i] : stops[i]].decode()
            except UnicodeDecodeError:
                reason[i] = 3
    return starts, stops, np.where(stops == starts, 0, fields), reason


def parsed(block: bytes, starts: np.ndarray, stops: np.ndarray, whole: bool, names: list[str]) -> list[pa.Array]:
    """The fields of some lines as one text array per column."""
    plain = block if whole else b"\n".join(block[a:b] for a, b in zip(starts.tolist(), stops.tolist())) + b"\n"
    if b"\r" in plain.replace(b"\r\n", b"\n"):
        # A carriage return inside a line belongs to a field.
        cells = [block[a:b].decode().split(",") for a, b in zip(starts.tolist(), stops.tolist())]
        return [pa.array(c, pa.string()) for c in zip(*cells)]
    table = pa.csv.read_csv(
        pa.BufferReader(plain),
        pa.csv.ReadOptions(use_threads=False, block_size=max(len(plain), 1), column_names=names),
        pa.csv.ParseOptions(quote_char=False, ignore_empty_lines=False),
        pa.csv.ConvertOptions(column_types={n: pa.string() for n in names}, strings_can_be_null=False),
    )
    return [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in table.columns]


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.what = options["path"], options["what"]
        self.suffix, self.label = options.get("suffix", ".csv").lower(), options["label"]
        self.names = options["names"].split(",")
        self.range_bytes = int(options["rangebytes"])
        self.failfast = options.get("mode", "failfast").lower() == "failfast"

    def partitions(self) -> list[Ranges]:
        plans, held, size = [], [], 0
        for path, length in listed(self.path, self.suffix)[2]:
            for at in range(0, max(length, 1), self.range_bytes):
                end = min(at + self.range_bytes, length)
                held.append((path, length, at, end))
                # A file costs something to open, however small it is.
                size += end - at + self.range_bytes / 64
                if size >= self.range_bytes:
                    plans.append(Ranges(held))
                    held, size = [], 0
        return plans + [Ranges(held)] * bool(held) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        system, root = pa.fs.FileSystem.from_uri(self.path)
        prefix = self.path[: self.path.find("://") + 3] if "://" in self.path else "file://"
        for path, _, at, end in partition.parts:
            yield from self.range(system, path, prefix + quote(path), at, end)

    def range(self, system: pa.fs.FileSystem, path: str, name: str, at: int, end: int) -> Iterator[pa.RecordBatch]:
        names, behind = header_of(system, path)
        state = state_of(names, self.names, self.label)
        rows = self.what == "rows"
        if rows and state != OK:
            if self.failfast:
                raise ValueError(f"{state}: {name}")
            return
        first = behind if at == 0 or at < behind else first_line(system, path, at)
        lines = good = 0
        rejects: list[tuple] = []
        if state not in (OK, NO_HEADER) and at == 0:
            rejects.append((-1, 0, state, len(names), ",".join(names)))
        with system.open_input_file(path) as file:
            file.seek(first)
            for place, block in line_blocks(file, first, end):
                starts, stops, fields, reason = judged(block, len(self.names))
                keep = reason == 0
                if rows:
                    if self.failfast and not keep.all():
                        i = int(np.argmin(keep))
                        raise ValueError(f"{(BLANK, FIELDS, ENCODING)[reason[i] - 1]}: {name}, byte {place + starts[i]}")
                    if keep.any():
                        cells = parsed(block, starts[keep], stops[keep], bool(keep.all()), self.names)
                        n = len(cells[0])
                        places = [pa.repeat(name, n), pa.array(place + starts[keep], pa.int64())]
                        yield pa.RecordBatch.from_arrays([*cells, *places], names=[*self.names, "archivo", "posicion"])
                elif state == OK:
                    good += int(keep.sum())
                    for i in np.flatnonzero(~keep).tolist():
                        text = block[starts[i] : stops[i]].decode("utf-8", "replace")
                        rejects.append((lines + i, int(place + starts[i]), (BLANK, FIELDS, ENCODING)[reason[i] - 1], int(fields[i]), text))
                        if len(rejects) >= 10_000:
                            yield self.rejected(name, at, rejects)
                            rejects = []
                lines += len(starts)
        if not rows:
            if rejects:
                yield self.rejected(name, at, rejects)
            header = None if names is None or at else ",".join(names)
            yield self.batch([(name, at, lines, good, header, state, None, None, None, None, None)])

    def rejected(self, name: str, at: int, rejects: list[tuple]) -> pa.RecordBatch:
        return self.batch([(name, at, None, None, None, None, *r) for r in rejects])

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"bigint": pa.int64(), "string": pa.string()}
        fields = [f.split() for f in SCAN.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


class ClassDirectories(DataSource):
    """Options: path, names (the expected columns, joined by commas), label, what ("scan" or "rows"), rangeBytes,
    suffix, and for rows mode ("failfast", or "drop" to leave out what the scan lists as rejected)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        if self.options.get("what") == "scan":
            return SCAN
        return ", ".join(f"`{n}` string" for n in self.options["names"].split(",")) + ", archivo string, posicion bigint"

    def reader(self, schema) -> DataSourceReader:
        return Reader({k.lower(): v for k, v in self.options.items()})


def expected_header(path: str, label: str = "Label", suffix: str = ".csv") -> list[str]:
    """Columns of the first file below ``path`` that has a header, checked for use as a source."""
    system, _, found = listed(path, suffix)
    if not found:
        raise ValueError(f"no {suffix} file below {path}")
    for file, _ in found:
        names, _ = header_of(system, file)
        if names is not None:
            state = state_of(names, names, label)
            if state != OK:
                raise ValueError(f"{state}: {file}")
            return names
    raise ValueError(f"{NO_HEADER}: every file below {path}")


def _load(spark: SparkSession, path: str, what: str, names: list[str] | None, label: str, **options) -> DataFrame:
    spark.dataSource.register(ClassDirectories)
    names = names or expected_header(path, label)
    reader = spark.read.format(FORMAT).options(path=path, what=what, names=",".join(names), label=label)
    return reader.options(**{"rangeBytes": str(RANGE_BYTES), **options}).load()


def scan(spark: SparkSession, path: str, names: list[str] | None = None, label: str = "Label", **options) -> DataFrame:
    """One pass over all files: a row per range with its counts, and a row per rejected line."""
    return _load(spark, path, "scan", names, label, **options)


def read_rows(spark: SparkSession, path: str, names: list[str] | None = None, label: str = "Label", **options) -> DataFrame:
    """The rows themselves, every field as text, with the file and the byte each row begins at.

    A rejected line fails the read and names its place; with ``mode="drop"`` it is left to ``rejected``.
    """
    return _load(spark, path, "rows", names, label, **options)


def file_inventory(scanned: DataFrame) -> DataFrame:
    """Lines, rows and rejected lines of every listed file, with the state of its header."""
    ranges = scanned.where("motivo IS NULL")
    files = ranges.groupBy("archivo").agg(
        F.sum("lineas").alias("lineas"), F.sum("filas").alias("filas"), F.max("estado").alias("estado")
    )
    return files.select("archivo", "lineas", "filas", (F.col("lineas") - F.col("filas")).alias("rechazadas"), "estado")


def rejected(scanned: DataFrame) -> DataFrame:
    """File, line, reason, fields and text of what is no row; the header is line 1.

    A range knows its own lines only; what comes before it in the file is a running sum over the file's ranges.
    """
    before = Window.partitionBy("archivo").orderBy("inicio").rowsBetween(Window.unboundedPreceding, -1)
    ranges = scanned.where("motivo IS NULL").select(
        "archivo", "inicio", F.coalesce(F.sum("lineas").over(before), F.lit(0)).alias("antes")
    )
    lines = scanned.where("motivo IS NOT NULL").select("archivo", "inicio", "indice", "motivo", "campos", "texto")
    return lines.join(ranges, ["archivo", "inicio"]).select(
        "archivo", (F.col("antes") + F.col("indice") + 2).alias("linea"), "motivo", "campos", "texto"
    )


def source_checks(classes: DataFrame, label: str = "Label") -> DataFrame:
    """Whether a source can be used, from one row per class (filas, rechazadas, archivos_malos): name, count, ok.

    Headers agree, there are rows at all, every class has some, and no line is rejected.
    """
    found = classes.agg(
        F.coalesce(F.sum("archivos_malos"), F.lit(0)).alias("bad"),
        F.coalesce(F.sum("filas"), F.lit(0)).alias("rows"),
        F.count_if(F.col("filas") == 0).alias("none"),
        F.coalesce(F.sum("rechazadas"), F.lit(0)).alias("odd"),
    )
    tests = {"cabeceras_iguales": ("bad", F.col("bad") == 0), "hay_filas": ("rows", F.col("rows") > 0),
             "clases_con_filas": ("none", F.col("none") == 0), "sin_lineas_rechazadas": ("odd", F.col("odd") == 0)}
    rows = [F.struct(F.lit(n).alias("comprobacion"), F.col(c).cast("bigint").alias("valor"), ok.alias("ok")) for n, (c, ok) in tests.items()]
    return found.select(F.inline(F.array(*rows)))
