"""Stored intermediate tables, row carrying, distributed running positions and connected components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flowops.session import cut_lineage, scratch_path

# Characters between words, as a class of a regular expression.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of an Arrow batch: texts are long, and a task holds a few batches at once.
BATCH_ROWS = 1000

# Setting under which the shuffles of a query are removed when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Cells that one group is cut into where rows of a group are numbered.
CELLS = 4096


def tuned(spark: SparkSession) -> SparkSession:
    """The session with batches small enough for long texts; set by the named queries and the pipeline."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: a lost executor loses nothing of it.

    The shuffles of the write leave the disk with its end, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path, before = path or scratch_path(spark, name), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *paths: str) -> None:
    """Tables of this run that nothing reads any more leave the shared folder."""
    for path in paths:
        named = spark._jvm.org.apache.hadoop.fs.Path(path)
        named.getFileSystem(spark._jsc.hadoopConfiguration()).delete(named, True)


def packed(df: DataFrame) -> DataFrame:
    """Whole rows as one struct ``row``: work columns beside it cannot clash with those of the caller."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def cell_of(key: Column, cells: int = CELLS) -> Column:
    """A cell number from the first 8 hex digits of a digest."""
    return (F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % cells).cast("int")


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    amount: Column,
    into: str,
) -> DataFrame:
    """Sum of ``amount`` over the rows before each row of its group, without sorting a group in one task.

    ``df`` has a column ``cell``; rows of a group are taken by cell, inside a cell by ``order``. Sums per
    (group, cell) are at most ``CELLS`` rows for a group, only these are run over in one window.
    """
    # As a struct a null group is an ordinary key, and window and join need one exchange of the rows only.
    keyed = df.withColumn("_group", F.struct(*group))
    inside = Window.partitionBy("_group", "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("_group").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = keyed.groupBy("_group", "cell").agg(F.sum(amount).alias("_sum"))
    starts = sums.select("_group", "cell", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    here = keyed.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return (
        here.join(starts, ["_group", "cell"])
        .withColumn(into, F.col("_start") + F.col("_inside"))
        .drop("_start", "_inside", "_group")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links (a, b): one row (id, component) per linked id, smallest id as name.

    Alternating large and small stars; every round is checkpointed, and rounds end when the links stop
    changing. Nothing is collected but a count and a checksum.
    """
    links = cut_lineage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())

    def lowest(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m"))

    seen = state(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(lowest(both), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        least = lowest(large)
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .where("u <> v")
            .distinct()
        )
        links = cut_lineage(small)
        now = state(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def default_shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


