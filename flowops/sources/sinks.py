"""Writing results: normalised CSV and JSON, sorted lines, and publication after validation."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from flowops.functions.columns import decimal_text, is_finite, qcol, round_decimals

# Fixed value: the mark of a whole output.
DONE = "_SUCCESS"
# Codec for JSON lines of whole tables, where names that repeat in every row are most of the text.
JSON_CODEC = "lz4"
# Codec for whole tables as CSV, and most rows of one compressed file: no file of them is split, so tasks share files.
CSV_CODEC = "lz4"
FILE_ROWS = 1 << 16


def as_text(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Every cell as the text the CSV contract asks for.

    Empty for NULL, NaN and infinities; floats with fixed decimals, trailing zeros cut but one kept;
    booleans as 1 and 0.
    """
    def cell(f: T.StructField) -> Column:
        c = qcol(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            text = decimal_text(c, decimals)
        elif isinstance(f.dataType, T.BooleanType):
            text = F.when(c, F.lit("1")).when(~c, F.lit("0"))
        else:
            text = c.cast("string")
        return F.coalesce(text, F.lit("")).alias(f.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, decimals: int = 6, single_file: bool = False) -> None:
    """Normalised CSV with a header. ``single_file`` is for result tables of a few rows only."""
    text = as_text(df, decimals)
    if single_file:
        text = text.coalesce(1)
    text.write.options(header=True, emptyValue="", encoding="UTF-8").csv(path)


def write_raw_csv(df: DataFrame, path: str, partition_by: str | None = None, compression: str = "none") -> None:
    """CSV with the shortest exact text of every number; infinities spelled ``inf`` and ``-inf``.

    Compressed, a task begins a new file after ``FILE_ROWS`` rows. With ``partition_by``, a task has a file in every directory it has rows of. Where the session allows so many
    open files (``spark.sql.maxConcurrentOutputFileWriters``), rows are neither shuffled nor sorted for it.
    """
    def cell(f: T.StructField) -> Column:
        c = qcol(f.name)
        if not isinstance(f.dataType, T.DoubleType):
            return c
        return (
            F.when(c == float("inf"), F.lit("inf"))
            .when(c == float("-inf"), F.lit("-inf"))
            .otherwise(c.cast("string"))
            .alias(f.name)
        )

    writer = df.select(*[cell(f) for f in df.schema.fields]).write.options(
        header=True, encoding="UTF-8", compression=compression
    )
    if compression != "none":
        writer = writer.option("maxRecordsPerFile", FILE_ROWS)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def write_json(df: DataFrame, path: str, decimals: int = 6, compression: str = "none") -> None:
    """JSON lines; non-finite numbers become null, floats are rounded."""
    def cell(f: T.StructField) -> Column:
        c = qcol(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            return F.when(is_finite(c), round_decimals(c.cast("double"), decimals)).alias(f.name)
        return c

    df.select(*[cell(f) for f in df.schema.fields]).write.options(ignoreNullFields=False, compression=compression).json(path)


def write_lines(df: DataFrame, path: str, separator: str = " ") -> None:
    """Columns joined into one line each, in the order and partitions of the frame."""
    df.select(F.concat_ws(separator, *[qcol(c).cast("string") for c in df.columns]).alias("value")).write.text(path)


def write_records(df: DataFrame, path: str) -> None:
    """Fixed-width columns joined without a separator, one record to a line, in the order of the frame."""
    df.select(F.concat(*[qcol(c) for c in df.columns]).alias("value")).write.text(path)


def publish(df: DataFrame, checks: DataFrame, path: str) -> None:
    """Write only when every check holds, beside the target; the whole folder then gets its name in one step.

    A write that fails leaves nothing at the target and no draft, and a target that is there is not touched.
    """
    failed = [r["comprobacion"] for r in checks.where(~F.col("ok")).select("comprobacion").collect()]
    if failed:
        raise ValueError(f"not published, failed checks: {failed}")
    context = df.sparkSession.sparkContext
    named = context._jvm.org.apache.hadoop.fs.Path
    target, draft = path.rstrip("/"), f"{path.rstrip('/')}.partial-{uuid.uuid4().hex}"
    store = named(target).getFileSystem(context._jsc.hadoopConfiguration())
    if store.exists(named(target)):
        raise FileExistsError(f"already published: {target}")
    try:
        df.write.parquet(draft)
        if not store.exists(named(draft, DONE)):
            raise OSError(f"no {DONE} in {draft}")
        if not store.rename(named(draft), named(target)):
            raise OSError(f"{draft} could not be renamed")
    finally:
        store.delete(named(draft), True)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """A folder that carries the mark of a whole output; any other fails."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path, DONE)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        raise FileNotFoundError(f"no {DONE} in {path}")
    return spark.read.parquet(path)


def write_thresholds(limits: DataFrame, path: str) -> None:
    """A threshold table as one JSON object, keyed by column under ``umbrales``.

    The table has one row per threshold column. Spark writes an infinity as a quoted word, which the
    reader takes back as a number.
    """
    cells = F.struct(*[qcol(c) for c in limits.columns if c != "columna"])
    keyed = F.map_from_entries(F.collect_list(F.struct("columna", cells)))
    limits.agg(keyed.alias("umbrales")).coalesce(1).write.json(path)
