import os

import duckdb
import pytest

TABLES = ("documents", "embeddings", "labels", "conversations", "benchmark")


@pytest.fixture(scope="session")
def docs(spark):
    """A frame of (doc_id, text, source) rows with columns whose names the operators use themselves."""

    def make(rows, **extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", 7, "row", None) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, source string, size int, row string, shard int")

    return make


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    yield con
    con.close()
