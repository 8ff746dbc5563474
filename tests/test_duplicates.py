"""Whole rows counted by digest first, against plain grouping."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from flowops.operators import duplicates, profiling
from flowops.session import shared_dir


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(9)
    cells = lambda: (rng.choice([None, 0.0, -0.0, math.nan, 1.5, math.inf]), rng.choice([None, 0, 1]), rng.choice([None, "", "a", "b"]))
    data = [cells() for _ in range(300)] + [(float(i), i, "x") for i in range(200)] + [(7.0, 7, "hot")] * 150
    # A NULL leaves a hash as it is, so these rows share their digests.
    data += [(None, 3, None), (None, None, "z"), (None, None, None)]
    return spark.createDataFrame(data, "x double, n int, t string").repartition(5)


@pytest.mark.parametrize("marks", [1 << 24, 64])
def test_distinct_rows_equal_grouping(rows, monkeypatch, marks):
    monkeypatch.setattr(duplicates, "MARKS", marks)
    got = duplicates.distinct_rows(rows, sums={"s": F.when(F.col("n").isNull(), 1).otherwise(0)}).first()
    assert got["rows"] == rows.count()
    assert got["distinct"] == rows.groupBy("x", "n", "t").count().count()
    assert got["s"] == rows.where("n IS NULL").count()
    some = duplicates.distinct_rows(rows, ["n", "t"]).first()
    assert some["distinct"] == rows.groupBy("n", "t").count().count()


def test_equal_digests_of_different_rows_are_told_apart(spark, monkeypatch):
    """With one digest for all rows every row is grouped by its columns."""
    monkeypatch.setattr(duplicates.F, "xxhash64", lambda *cells: F.lit(5).cast("bigint"))
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "a")], "n int, t string")
    assert tuple(duplicates.distinct_rows(df).first()) == (4, 3)


def test_distinct_rows_of_nothing(spark):
    none = spark.createDataFrame([], "x double, t string")
    assert tuple(duplicates.distinct_rows(none, sums={"s": F.lit(1)}).first()) == (0, 0, 0)
    assert tuple(duplicates.dedup_report(none).first())[:3] == (0, 0, 0)


def test_only_repeated_rows_are_shuffled_whole(spark):
    """What is grouped by all columns comes from the join with the marks, which few rows pass."""
    wide = spark.range(5_000).select(*[(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(20)])
    wide = wide.unionByName(wide.where("c0 < 50"))
    found = duplicates.distinct_rows(wide)
    row = found.first()
    assert (row["rows"], row["distinct"]) == (5_050, 5_000)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    grouped = plan[plan.index("Aggregate [c0") :]
    assert "Join Inner" in grouped and "strategy=broadcast" in grouped
    word, bit = duplicates._mark(F.xxhash64(*wide.columns))
    placed = wide.select(word.alias("w"), bit.alias("b"))
    assert placed.groupBy("w", "b").count().where("count > 1").agg(F.sum("count")).first()[0] < 150


def test_validation_of_repeated_rows(rows):
    from dataclasses import replace

    from flowops.spec import FLOW

    spec = replace(FLOW, columns=("x", "n", "t"), integers=("n",), texts=("t",), label="t")
    got = profiling.validation(rows, spec).first()
    assert got["registros"] == rows.count() and got["columnas"] == 3
    assert got["nulos"] == sum(rows.where(f"{c} IS NULL").count() for c in ("x", "n", "t"))
    assert got["duplicados"] == rows.count() - rows.groupBy("x", "n", "t").count().count()


def test_text_rows_are_read_once(spark, tmp_path):
    names = [f"c{i}" for i in range(9)]
    rows = [("a", "b,c", *"1234567"), ("a,b", "c", *"1234567"), ("a", "b,c", *"1234567"), ("1.1", None, *"1234567")]
    rows += [("1.1", "", *"1234567"), ("1.10", "", *"1234567"), ("1.1", *"1234567", ""), (None,) * 9, ("",) * 9]
    spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).write.csv(f"{tmp_path}/t", emptyValue="")
    texts = spark.read.schema(", ".join(f"{n} string" for n in names)).csv(f"{tmp_path}/t", mode="PERMISSIVE")
    before = set(os.listdir(shared_dir(spark).removeprefix("file://")))
    report = duplicates.text_dedup_report(texts, names)
    kinds = {tuple(x or "" for x in r) for r in rows}
    got = report.first()
    assert (got["antes"], got["despues"]) == (len(rows), len(kinds))
    # Nothing was counted ahead in a scan of its own.
    assert set(os.listdir(shared_dir(spark).removeprefix("file://"))) == before


def _shuffled_bytes(report):
    """Bytes of the rows in the widest exchange, before compression."""
    def sizes(plan):
        own = plan.metrics().get("dataSize")
        yield own.get().value() if own.isDefined() else 0
        below = plan.children().iterator()
        while below.hasNext():
            yield from sizes(below.next())

    report.collect()
    return max(sizes(report._jdf.queryExecution().executedPlan()))


def test_text_rows_are_shuffled_as_lines(spark):
    """40 fields of 3 bytes are 160 bytes in a line, and 8 bytes and a padded word each in an array."""
    names = [f"c{i}" for i in range(40)]
    texts = spark.range(0, 2_000, 1, 2).select(*[(F.col("id") % 900 + 100).cast("string").alias(n) for n in names])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _shuffled_bytes(duplicates.text_dedup_report(texts, names)) < 250 * 2_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_text_rows_that_hold_the_separator_are_told_apart(spark):
    s = duplicates.SEPARATOR
    rows = [(f"a{s}b", "c", ""), ("a", f"b{s}c", None), ("a", "b", f"c{s}"), ("a", "b", "c"), ("a", f"b{s}c", ""), (s, "", ""), ("", s, ""), ("", "", s), ("", None, "")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    kinds = {tuple(x or "" for x in r) for r in rows}
    assert tuple(duplicates.text_dedup_report(df, ["a", "b", "c"]).first())[:2] == (len(rows), len(kinds))
    one = spark.createDataFrame([(s,), (s,), (f"a{s}",), (None,), ("",)], "a string")
    assert tuple(duplicates.text_dedup_report(one, ["a"]).first())[:2] == (5, 3)
