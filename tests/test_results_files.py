import json
import os

import pytest
from dataclasses import replace
from pyspark.sql import functions as F

from flowops.operators import duplicates, reconcile
from flowops.operators.percentiles import Limits
from flowops.sources import files, sinks
from flowops.spec import FLOW

MINI = replace(FLOW, columns=("x", "n", "Label"), integers=("n",))


def test_reconcile(spark):
    base = [("a", 1.0, "u"), ("b", 2.0, ""), ("c", 1e12, "w"), ("d", 4.0, "x"), ("gone", 5.0, "y"), (None, 1.0, "z")]
    other = [("a", 1.0 + 1e-7, "u"), ("b", 2.001, None), ("c", 1e12 * (1 + 1e-10), "w"), ("d", 4.0, "X"), ("new", 5.0, "y"), (None, 1.0, "z")]
    schema = "k string, v double, t string"
    got = reconcile.reconcile(spark.createDataFrame(base, schema), spark.createDataFrame(other, schema), ["k"]).collect()
    assert {(r["k"], r["columna"], r["estado"]) for r in got} == {
        ("b", "v", "distinta"), ("d", "t", "distinta"), ("gone", None, "falta"), ("new", None, "sobra"),
    }


def test_reconcile_pairs_repeated_keys_as_multisets(spark):
    schema = "k string, v double, t string"
    base = [("k", 1.0, "a"), ("k", 1.0, "a"), ("k", 9.0, "b"), ("k", 10.0, "b"), ("m", 1.0, None), ("m", 1.0, None), (None, 3.0, "n"), (None, 3.0, "n")]
    other = [("k", 10.0, "b"), ("k", 1.0, "a"), ("k", 9.0 + 1e-7, "b"), ("k", 2.0, "a"), ("m", 1.0, ""), (None, 3.0, "n"), (None, 3.0, "n"), (None, 4.0, "n")]
    got = reconcile.reconcile(spark.createDataFrame(base, schema), spark.createDataFrame(other, schema), ["k"]).collect()
    # One copy of (1.0, a) is left against (2.0, a); 9 is near enough; a copy of m is missing; a NULL key has one row more.
    assert sorted(map(tuple, got), key=str) == sorted(
        [("k", "v", "1.0", "2.0", "distinta"), ("m", None, None, None, "falta"), (None, None, None, None, "sobra")], key=str
    )


def test_reconcile_needs_equal_headers(spark):
    a = spark.createDataFrame([("k", 1)], "k string, v int")
    with pytest.raises(ValueError, match="headers differ"):
        reconcile.reconcile(a, a.withColumnRenamed("v", "w"), ["k"])


def test_set_difference(spark):
    a = spark.createDataFrame([("x",), ("y",)], "v string")
    b = spark.createDataFrame([("y",), ("z",), ("z",)], "v string")
    assert {tuple(r) for r in reconcile.set_difference(a, b, "v").collect()} == {("x", "falta"), ("z", "sobra")}


def test_expectations_fail_fast(spark):
    wide = spark.createDataFrame([(3, 4)], "a int, b int")
    rows = {r["comprobacion"]: r["ok"] for r in reconcile.expectations(wide, {"a": 3, "b": 5}).collect()}
    assert rows == {"a": True, "b": False}
    with pytest.raises(Exception, match="expectation failed: b"):
        reconcile.expectations(wide, {"a": 3, "b": 5}, fail_fast=True).collect()


def test_pivot_with_total(spark):
    df = spark.createDataFrame([("Q1", "p", 1.25), ("Q1", "d", 2.0), ("Q2", "p", 0.5)], "q string, m string, s double")
    table = reconcile.pivot_with_total(df, "q", "m", ["p", "d"], F.first("s"), "TOTAL")
    assert {tuple(r) for r in table.collect()} == {("Q1", 1.25, 2.0), ("Q2", 0.5, None), ("TOTAL", 1.75, 2.0)}


def test_text_duplicates(spark):
    df = spark.createDataFrame([("1.10", None), ("1.1", ""), ("1.1", None)], "a string, b string")
    row = duplicates.text_dedup_report(df, ["a", "b"]).first()
    assert tuple(row) == (3, 2, 1, 33.333333)


def test_duplicate_examples_break_ties_by_key(spark):
    df = spark.createDataFrame([(2, "b"), (1, "b"), (1, "b"), (2, "b"), (0, "z")], "a int, b string")
    assert [tuple(r) for r in duplicates.most_repeated(df, ["a", "b"], 2).collect()] == [(2, 1, "b"), (2, 2, "b")]


def _write(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding=encoding) as f:
        f.write(text)


def test_csv_spellings_of_infinity(spark, tmp_path):
    _write(tmp_path, "a.csv", "x,n,Label\ninf,1,a\n-inf,2,a\nInf,3,a\nNaN,4,a\n,5,\n1.10,6,b\n")
    got = [r["x"] for r in files.read_csv(spark, str(tmp_path), MINI).orderBy("n").collect()]
    assert got[:3] == [float("inf"), float("-inf"), float("inf")]
    assert got[3] != got[3] and got[4] is None and got[5] == 1.1
    texts = [r["x"] for r in files.read_text_csv(spark, str(tmp_path), MINI).orderBy("n").collect()]
    assert texts == ["inf", "-inf", "Inf", "NaN", "", "1.10"]


def test_class_directories(spark, tmp_path):
    root = str(tmp_path)
    _write(os.path.join(root, "Benign_Final"), "one.csv", "x,n\n1.0,1\n2.0,2\n", "utf-8-sig")
    _write(os.path.join(root, "XSS"), "two.csv", "x,n\n3.0,3\n")
    assert files.source_header(spark, root) == ["x", "n"]
    rows = files.read_class_directories(spark, root, MINI)
    assert sorted((r["Label"], r["x"], r["n"]) for r in rows.collect()) == [("Benign", "1.0", "1"), ("Benign", "2.0", "2"), ("XSS", "3.0", "3")]
    assert {(r["Label"], r["filas"]) for r in files.inventory(rows).collect()} == {("Benign", 2), ("XSS", 1)}


def test_class_directories_reject_other_headers_and_short_rows(spark, tmp_path):
    good, bad, short = (str(tmp_path / n) for n in ("good", "bad", "short"))
    for root in (bad, short):
        _write(os.path.join(root, "A"), "one.csv", "x,n\n1.0,1\n")
    _write(os.path.join(bad, "B"), "two.csv", "x,other\n3.0,3\n")
    with pytest.raises(Exception):
        files.read_class_directories(spark, bad, MINI).collect()
    with pytest.raises(Exception):
        files.inventory(files.read_class_directories(spark, bad, MINI)).collect()
    with pytest.raises(Exception):
        files.read_class_directories(spark, bad, MINI).select("x").collect()
    _write(os.path.join(short, "B"), "two.csv", "x,n\n3.0\n")
    with pytest.raises(Exception):
        files.read_class_directories(spark, short, MINI).collect()
    with pytest.raises(Exception):
        files.inventory(files.read_class_directories(spark, short, MINI)).collect()
    _write(os.path.join(good, "A"), "one.csv", "x,n,Label\n1.0,1,a\n")
    with pytest.raises(ValueError, match="already has a column"):
        files.source_header(spark, good)


def test_class_name_with_a_comma_fails(spark, tmp_path):
    _write(os.path.join(str(tmp_path), "A,B"), "one.csv", "x,n\n1.0,1\n")
    with pytest.raises(Exception, match="not a usable class name"):
        files.inventory(files.read_class_directories(spark, str(tmp_path), MINI)).collect()


def test_thresholds_file_with_bare_infinity(spark, tmp_path):
    cell = {"conteo": 3, "nulos": 0, "min": 0.5, "max": float("inf"), "media": float("inf"), **{f"p{p}": float(p) for p in (50, 75, 90, 95, 99)}}
    _write(tmp_path, "t.json", json.dumps({"umbrales": {"Tot size": cell}}, indent=2))
    table = files.read_thresholds(spark, str(tmp_path / "t.json"), ["Tot size"])
    row = table.first()
    assert row["max"] == float("inf") and row["p95"] == 95.0
    limit = Limits.from_table(table).at("Tot size", 95)
    assert spark.range(1).select(limit.alias("v")).first()["v"] == 95.0


def test_result_csv_text(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, float("inf"), True, 7), ("b", 2.0, None, False, None)], "k string, v double, w double, f boolean, n int")
    sinks.write_csv(df, str(tmp_path / "out"), single_file=True)
    part = [n for n in os.listdir(tmp_path / "out") if n.startswith("part")]
    with open(tmp_path / "out" / part[0], encoding="utf-8") as f:
        assert f.read().splitlines() == ["k,v,w,f,n", "a,1.5,,1,7", "b,2.0,,0,"]


def test_json_sink(spark, tmp_path):
    sinks.write_json(spark.createDataFrame([(1.23456789, float("nan"))], "a double, b double"), str(tmp_path / "j"))
    part = [n for n in os.listdir(tmp_path / "j") if n.startswith("part") and os.path.getsize(tmp_path / "j" / n)]
    with open(tmp_path / "j" / part[0], encoding="utf-8") as f:
        assert json.loads(f.readline()) == {"a": 1.234568, "b": None}


def test_sort_outputs(spark, tmp_path):
    _write(tmp_path, "part-r-00000", "------------------------------------------------\n6\t10\n6\t11\n")
    got = [tuple(r) for r in files.read_sorted_pairs(spark, str(tmp_path / "part-r-00000")).collect()]
    assert got == [(6, 10), (6, 11)]


def test_publish_only_after_checks(spark, tmp_path):
    df = spark.range(3)
    failed = spark.createDataFrame([("filas", False)], "comprobacion string, ok boolean")
    passed = failed.withColumn("ok", F.lit(True))
    with pytest.raises(ValueError, match="failed checks"):
        sinks.publish(df, failed, str(tmp_path / "no"))
    assert os.listdir(tmp_path) == []
    sinks.publish(df, passed, str(tmp_path / "yes"))
    assert sinks.read_published(spark, str(tmp_path / "yes")).count() == 3
    with pytest.raises(FileExistsError):
        sinks.publish(df, passed, str(tmp_path / "yes"))
    assert os.listdir(tmp_path) == ["yes"]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    passed = spark.createDataFrame([("filas", True)], "comprobacion string, ok boolean")
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("v"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, passed, str(tmp_path / "never"))
    assert os.listdir(tmp_path) == []
    spark.range(3).write.parquet(str(tmp_path / "half"))
    os.remove(tmp_path / "half" / "_SUCCESS")
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, str(tmp_path / "half"))


def test_manifest_hashes_in_blocks(spark, tmp_path, monkeypatch):
    import hashlib

    monkeypatch.setattr(files, "HASH_BYTES", 1000)
    content = {"a.bin": os.urandom(12_345), "b c.bin": b"", "d/e.bin": b"x" * 1000}
    for name, data in content.items():
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = {r["ruta"]: (r["bytes"], r["sha256"]) for r in files.manifest(spark, str(tmp_path), "*.bin").collect()}
    assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in content.items()}


@pytest.mark.parametrize("a,b,same", [
    ("inf", "5.0", False), ("nan", "5.0", False), ("inf", "-inf", False), ("1.0", "2.0", False),
    ("inf", "Infinity", True), ("nan", "NaN", True), ("1.0", "1.0000000001", True), ("", None, True),
])
def test_non_finite_cells(spark, a, b, same):
    from flowops.operators import reconcile

    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(reconcile.same_value(F.col("a"), F.col("b"))).first()[0] is same


def test_json_lines_of_a_whole_table_are_compressed(spark, tmp_path):
    from flowops.sources import sinks

    rows = spark.range(2000).selectExpr("id", "id / 4D AS a_long_name_in_every_row")
    sizes = []
    for codec in ("none", sinks.JSON_CODEC):
        path = tmp_path / codec
        sinks.write_json(rows, str(path), compression=codec)
        sizes.append(sum(f.stat().st_size for f in path.glob("part-*")))
        assert sorted(spark.read.schema(rows.schema).json(str(path)).collect()) == sorted(rows.collect())
    assert 4 * sizes[1] < sizes[0]


def test_directories_are_written_where_rows_lie(spark, tmp_path):
    from flowops.session import tune
    from flowops.sources import sinks

    rows = tune(spark).range(0, 400, 1, 4).selectExpr("id", "CAST(id % 3 AS string) AS clase")
    sinks.write_raw_csv(rows, str(tmp_path / "out"), "clase")
    # A file per task and directory: no row was moved to another task.
    assert [len(list((tmp_path / "out" / f"clase={c}").glob("part-*"))) for c in range(3)] == [4, 4, 4]
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted(int(r["id"]) for r in back.collect()) == list(range(400))


def test_compressed_csv_is_written_in_files_of_few_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_ROWS", 100)
    rows = spark.range(0, 250, 1, 1).selectExpr(
        "CASE WHEN id % 7 = 0 THEN CAST('-Infinity' AS DOUBLE) WHEN id % 5 > 0 THEN id / 4D END AS x", "id AS n",
        "element_at(array('a', 'b,c', '', '\"', NULL), CAST(id % 5 AS INT) + 1) AS Label",
    )
    sinks.write_raw_csv(rows, f"{tmp_path}/plain")
    sinks.write_raw_csv(rows, f"{tmp_path}/small", compression=sinks.CSV_CODEC)
    small = [str(f) for f in (tmp_path / "small").glob("part-*")]
    # A file of them is read by one task, so its rows are bounded.
    assert sorted(files.read_csv(spark, f, MINI).count() for f in small) == [50, 100, 100]
    for read in (files.read_csv, files.read_text_csv):
        got, want = (sorted(map(str, read(spark, f"{tmp_path}/{n}", MINI).collect())) for n in ("small", "plain"))
        assert got == want
    none = rows.where("n < 0")
    sinks.write_raw_csv(none, f"{tmp_path}/none", compression=sinks.CSV_CODEC)
    assert files.read_csv(spark, f"{tmp_path}/none", MINI).count() == 0


def test_csv_of_the_whole_table_is_compressed(spark, sf_dir):
    from pathlib import Path
    from flowops.plans import catalog
    from flowops.plans.flow_view import read_flows

    path = Path(catalog._written_csv(spark, sf_dir).removeprefix("file://"))
    sinks.write_raw_csv(read_flows(spark, sf_dir), f"{path}-plain")
    sizes = [sum(f.stat().st_size for f in p.glob("part-*")) for p in (path, Path(f"{path}-plain"))]
    assert 2 * sizes[0] < sizes[1]
