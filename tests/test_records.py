"""Contiguous records: written without line ends, with cut points, read in any ranges."""

import os

import pytest
from pyspark.sql import functions as F

from flowops.operators import ordering
from flowops.sources import files, records


@pytest.fixture(scope="module")
def rows(spark):
    keys = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 777).otherwise(F.col("id") * 7919 % 10_007).alias("n"), "id")
    return keys.select(F.format_string("%010d", F.col("n")).alias("key"), F.rpad(F.col("id").cast("string"), 90, " ").alias("payload"))


@pytest.fixture(scope="module")
def written(rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tera") / "out")
    records.write_contiguous(ordering.total_sort(rows, 4), path)
    return path


def test_files_hold_records_alone(rows, written):
    parts = sorted(n for n in os.listdir(written) if n.startswith("part-"))
    assert parts == [f"part-r-{i:05d}" for i in range(len(parts))] and len(parts) == 4
    assert set(os.listdir(written)) - set(parts) == {"_partition.lst", "_SUCCESS"}
    raw = b"".join(open(os.path.join(written, n), "rb").read() for n in parts)
    got = [raw[i : i + 100] for i in range(0, len(raw), 100)]
    assert [r[:10] for r in got] == sorted(r[:10] for r in got)
    assert sorted(got) == sorted((r["key"] + r["payload"]).encode() for r in rows.collect())


@pytest.mark.parametrize("size", [30_000, 1 << 20])
def test_any_range_reads_the_same(spark, rows, written, monkeypatch, size):
    monkeypatch.setattr(records, "BLOCK_BYTES", 300)
    back = records.read_contiguous(spark, written, size)
    assert sorted(map(tuple, back.select("key", "payload").collect())) == sorted(map(tuple, rows.collect()))
    check = ordering.order_check(back, ["key"], files.PLACE).first()
    assert tuple(check) == (5000, 0, 0, True)


def test_cut_points(spark, written, tmp_path):
    cuts = records.cut_points(written)
    assert len(cuts) == 3 and cuts == sorted(cuts)
    assert tuple(records.partition_check(records.read_contiguous(spark, written), written).first()) == (5000, 0, True)
    # Another order of the parts is noticed.
    import shutil

    wrong = str(tmp_path / "wrong")
    shutil.copytree(written, wrong)
    first, last = (os.path.join(wrong, f"part-r-0000{i}") for i in (0, 3))
    low, high = open(first, "rb").read(), open(last, "rb").read()
    open(first, "wb").write(high)
    open(last, "wb").write(low)
    row = records.partition_check(records.read_contiguous(spark, wrong), wrong).first()
    assert row["fuera"] == 2 and not row["ok"]


def test_unfinished_and_odd_files_are_refused(spark, tmp_path):
    path = str(tmp_path / "half")
    os.makedirs(path)
    open(os.path.join(path, "part-r-00000"), "wb").write(b"x" * 150)
    with pytest.raises(Exception, match="_SUCCESS"):
        records.read_contiguous(spark, path).collect()
    open(os.path.join(path, "_SUCCESS"), "wb").close()
    with pytest.raises(Exception, match="whole number of records"):
        records.read_contiguous(spark, path).collect()


def test_a_failed_write_is_not_read(spark, tmp_path):
    short = spark.createDataFrame([("0000000001", "short")], "key string, payload string")
    path = str(tmp_path / "bad")
    with pytest.raises(Exception, match="a record must be"):
        records.write_contiguous(short, path)
    assert not any(n.startswith("part-") or n == "_SUCCESS" for n in (os.listdir(path) if os.path.exists(path) else []))


def test_no_records(spark, tmp_path):
    path = str(tmp_path / "none")
    records.write_contiguous(spark.createDataFrame([], "key string, payload string"), path)
    assert records.read_contiguous(spark, path).count() == 0
    assert records.cut_points(path) == []
