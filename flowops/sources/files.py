"""Reading files: declared CSV, raw text CSV, directories of classes, thresholds, sort outputs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from fnmatch import fnmatch

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from flowops.functions.columns import qcol
from flowops.spec import Spec

# Bytes of a file that are hashed at once.
HASH_BYTES = 4 << 20

# The directory that holds the benign class, and the widths of a fixed-width record.
BENIGN_DIRECTORY = "Benign_Final"
KEY_BYTES = 10
RECORD_BYTES = 100


def read_text_csv(spark: SparkSession, path: str, spec: Spec) -> DataFrame:
    """Every column as text, exactly as written; a missing field is an empty text."""
    raw = _csv(spark, spec.text_schema).csv(path)
    return raw.select(*[F.coalesce(qcol(c), F.lit("")).alias(c) for c in spec.columns])


def read_csv(spark: SparkSession, path: str, spec: Spec) -> DataFrame:
    """Declared schema. Floats are read as text and cast, so every spelling of infinity survives."""
    floats = set(spec.floats)
    schema = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name in floats else f.dataType, True)
            for f in spec.schema.fields
        ]
    )
    raw = _csv(spark, schema).csv(path)
    return raw.select(
        *[qcol(c).try_cast("double").alias(c) if c in floats else qcol(c) for c in spec.columns]
    )


def _csv(spark: SparkSession, schema: T.StructType):
    # With enforceSchema off, a file whose header differs from the schema fails the read.
    return spark.read.schema(schema).options(
        header=True, mode="PERMISSIVE", encoding="UTF-8", enforceSchema=False
    )


def directory_label(path: Column) -> Column:
    """Class name from the parent directory of a file, ``name`` or ``column=name``."""
    parent = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    folder = F.regexp_replace(F.url_decode(parent), "^[^=]+=", "")
    return F.when(folder == BENIGN_DIRECTORY, F.lit("Benign")).otherwise(folder)


def read_class_directories(
    spark: SparkSession, path: str, spec: Spec, suffix: str = "*.csv"
) -> DataFrame:
    """All CSV files below a directory, with the label taken from each file's directory.

    Adds the label and ``archivo``. Rows with a wrong number of fields fail the read.
    """
    source = [f for f in spec.text_schema.fields if f.name != spec.label]
    raw = (
        _csv(spark, T.StructType(source))
        # Without pruning every plan parses whole rows, so a count checks headers and field counts too.
        .options(mode="FAILFAST", recursiveFileLookup=True, pathGlobFilter=suffix, columnPruning=False)
        .csv(path)
    )
    file = F.col("_metadata.file_path")
    return raw.select(
        *[F.coalesce(qcol(f.name), F.lit("")).alias(f.name) for f in source],
        directory_label(file).alias(spec.label),
        file.alias("archivo"),
    )


def source_header(spark: SparkSession, path: str, label: str = "Label", suffix: str = "*.csv") -> list[str]:
    """Column names in the first line of one file below ``path``, checked for use as a source.

    The other files are held to this header by the scan itself, which compares every file's header
    with the declared schema; no extra pass over the data is needed.
    """
    first = (
        spark.read.options(recursiveFileLookup=True, pathGlobFilter=suffix).text(path).limit(1).first()
    )
    if first is None:
        raise ValueError(f"no rows in any {suffix} file below {path}")
    names = first["value"].lstrip("\ufeff").split(",")
    if len(set(names)) != len(names):
        raise ValueError(f"repeated column names: {names}")
    if label in names:
        raise ValueError(f"the source already has a column {label!r}")
    return names


def with_class(df: DataFrame, label: str = "Label", file: str = "archivo") -> DataFrame:
    """The class of each row from the directory of its file.

    A directory name that is empty or holds a comma or line break cannot be a class and fails.
    """
    name = directory_label(F.col(file))
    usable = F.when(name.rlike(r"^[^,\r\n]+$"), name).otherwise(
        F.raise_error(F.concat(F.lit("not a usable class name: "), name))
    )
    return df.withColumn(label, usable)


def inventory(rows: DataFrame, label: str = "Label") -> DataFrame:
    """Rows per file and class of rows that were read; ``checked.file_inventory`` also has files without any.

    Rows are counted per file; the class is read off the few file names.
    """
    files = rows.groupBy("archivo").agg(F.count(F.lit(1)).alias("filas"))
    return with_class(files, label).select(label, "archivo", "filas")


def read_thresholds(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """A threshold file (``umbrales`` keyed by column) as a threshold table; bare Infinity is a number."""
    whole, real = ("conteo", "nulos"), ("min", "max", "media", "p50", "p75", "p90", "p95", "p99")
    cell = T.StructType(
        [T.StructField(n, T.LongType()) for n in whole] + [T.StructField(n, T.DoubleType()) for n in real]
    )
    names = list(columns)
    schema = T.StructType(
        [T.StructField("umbrales", T.StructType([T.StructField(c, cell) for c in names]))]
    )
    one = spark.read.schema(schema).option("multiLine", True).json(path)
    rows = [
        F.struct(
            F.lit(c).alias("columna"),
            *[F.col(f"umbrales.`{c}`").getField(n).alias(n) for n in (*whole, *real)],
        )
        for c in names
    ]
    return one.select(F.inline(F.array(*rows)))


# Where a record was read: file and first byte of the split. Within a split rows keep their order.
PLACE = ("archivo", "inicio")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.file_block_start").alias(PLACE[1])
    )


def read_sorted_pairs(spark: SparkSession, path: str, placed: bool = False) -> DataFrame:
    """Pairs from a secondary-sort output; separator lines, which start with a dash, are skipped."""
    parts = F.split(F.trim("value"), r"\s+")
    return (
        _lines(spark, path)
        .where(~F.trim("value").startswith("-"))
        .select(
            parts[0].cast("int").alias("protocol"), parts[1].cast("int").alias("rate"), *[p for p in PLACE if placed]
        )
    )


def read_record_lines(spark: SparkSession, path: str, placed: bool = False) -> DataFrame:
    """Fixed-width records written one to a line, as key and payload."""
    return _lines(spark, path).select(
        F.substring("value", 1, KEY_BYTES).alias("key"),
        F.substring("value", KEY_BYTES + 1, RECORD_BYTES - KEY_BYTES).alias("payload"),
        *[p for p in PLACE if placed],
    )


def content_manifest(df: DataFrame, name: str, content: str) -> DataFrame:
    """Name, size in bytes and SHA-256 of the contents a table holds, one row each."""
    data = F.coalesce(qcol(content).cast("binary"), F.lit("").cast("binary"))
    return df.select(
        qcol(name).alias("ruta"), F.octet_length(data).cast("bigint").alias("bytes"), F.sha2(data, 256).alias("sha256")
    )


def manifest(spark: SparkSession, path: str, suffix: str = "*") -> DataFrame:
    """Path relative to ``path``, size and SHA-256 of every file below it, empty ones included.

    A digest is sequential, so a file is one task's, which streams it in blocks through ``pyarrow.fs`` and holds
    one block, however large the file is. Only names and sizes are listed on the driver.
    """
    store, root = pa.fs.FileSystem.from_uri(path)
    listing = store.get_file_info(pa.fs.FileSelector(root, recursive=True))
    chosen = [i for i in listing if i.is_file and fnmatch(i.base_name, suffix) and not i.base_name.startswith(".")]
    below = len(root.rstrip("/")) + 1
    rows = [(i.path, i.path[below:], i.size) for i in chosen]
    files = spark.createDataFrame(rows, "path string, ruta string, bytes bigint")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = pa.fs.FileSystem.from_uri(path)[0]
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                digest = hashlib.sha256()
                with system.open_input_stream(row.column("path")[0].as_py()) as stream:
                    while block := stream.read(HASH_BYTES):
                        digest.update(block)
                named = [row.column("ruta"), row.column("bytes"), pa.array([digest.hexdigest()])]
                yield pa.RecordBatch.from_arrays(named, names=["ruta", "bytes", "sha256"])

    spread = files.repartition(spark.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(digests, "ruta string, bytes bigint, sha256 string")
