"""Every query against its SQL on an independent engine: same columns, types and values."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    yield con
    con.close()


def _sorted(rows, columns):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [
        tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in at) for r in rows
    ]
    return sorted(plain, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert _sorted(df.collect(), df.columns) == _sorted(cursor.fetchall(), columns)


def test_manifest(spark, sf_dir):
    import hashlib

    rows = {r["ruta"]: r for r in QUERIES["file_manifest"](spark, sf_dir).collect()}
    assert set(rows) == {f"{t}.parquet" for t in TABLES}
    with open(os.path.join(sf_dir, "region.parquet"), "rb") as f:
        content = f.read()
    assert rows["region.parquet"]["bytes"] == len(content)
    assert rows["region.parquet"]["sha256"] == hashlib.sha256(content).hexdigest()


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["Attack_Family", "cantidad", "porcentaje"]
    assert abs(sum(r["porcentaje"] for r in result.collect()) - 100) < 1e-4
