"""Session-level facts the operators need: the shared folder, cut lineage and settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A single-process session without that setting (a test, a shell) gets a folder of its own, as it has
    no other machine to share with; any other session must say where its shared folder is.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    created = tempfile.mkdtemp(prefix="flowops-")
    spark.conf.set("spark.checkpoint.dir", created)
    return created


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/flowops-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Nothing of it is lost with an executor, and Catalyst knows its size when it plans what follows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small intermediate result (one row per group, never base rows)."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


# Runtime settings for wide tables, set by the named queries on their session. Generated methods above
# 8000 bytes of bytecode are never compiled by the JVM's JIT, so plans that wide run faster on Spark's
# per-operator projections.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Directories a task writes to at once; only rows of further ones are sorted first.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark
