"""The checked source of class directories: nothing that is listed or written is lost."""

import os
import random

import pytest
from pyspark.sql import functions as F

from flowops.sources import checked, files


def _put(root, name, data):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def by_name(df, root):
    return {r["archivo"].split(f"{os.path.basename(root)}/")[-1]: r for r in df.collect()}


@pytest.fixture
def odd(tmp_path):
    root = str(tmp_path / "src")
    _put(root, "A/one.csv", b"x,n\n1,2\n\n3,4\n")
    _put(root, "A/header.csv", b"x,n\n")
    _put(root, "B/only header.CSV", b"x,n")
    _put(root, "Benign_Final/bom.csv", b"\xef\xbb\xbfx,n\r\n5,6\r\n7\r\n\r\n8,9,10\r\n11,12")
    _put(root, "Benign_Final/bytes.csv", b"x,n\n\xff,1\n\xc3\xa9,2\na\rb,3\n")
    _put(root, "C/nothing.csv", b"")
    _put(root, "_hidden/no.csv", b"y\n1\n")
    _put(root, "A/notes.txt", b"y\n")
    return root


def test_every_listed_file_is_counted(spark, odd):
    got = by_name(checked.file_inventory(checked.scan(spark, odd)), odd)
    assert {n: (r["lineas"], r["filas"], r["rechazadas"], r["estado"]) for n, r in got.items()} == {
        "A/one.csv": (3, 2, 1, "ok"),
        "A/header.csv": (0, 0, 0, "ok"),
        "B/only%20header.CSV": (0, 0, 0, "ok"),
        "Benign_Final/bom.csv": (5, 2, 3, "ok"),
        "Benign_Final/bytes.csv": (3, 2, 1, "ok"),
        "C/nothing.csv": (0, 0, 0, "sin_cabecera"),
    }


def test_rejected_lines_have_place_and_reason(spark, odd):
    got = checked.rejected(checked.scan(spark, odd))
    assert {(r["archivo"].rsplit("/", 1)[-1], r["linea"], r["motivo"], r["campos"], r["texto"]) for r in got.collect()} == {
        ("one.csv", 3, "vacia", 0, ""),
        ("bom.csv", 3, "campos", 1, "7"),
        ("bom.csv", 4, "vacia", 0, ""),
        ("bom.csv", 5, "campos", 3, "8,9,10"),
        ("bytes.csv", 2, "codificacion", 2, "�,1"),
    }


def test_rows_fail_fast_or_leave_rejects_out(spark, odd):
    with pytest.raises(Exception, match="vacia|campos|codificacion|sin_cabecera"):
        checked.read_rows(spark, odd).collect()
    got = checked.read_rows(spark, odd, mode="drop")
    named = got.select("x", "n", files.directory_label(F.col("archivo")).alias("clase"))
    assert {tuple(r) for r in named.collect()} == {
        ("1", "2", "A"), ("3", "4", "A"), ("5", "6", "Benign"), ("11", "12", "Benign"), ("é", "2", "Benign"), ("a\rb", "3", "Benign"),
    }


@pytest.mark.parametrize("header,state", [(b"x,m\n1,2\n", "cabecera_distinta"), (b"x,x\n1,2\n", "columnas_repetidas"), (b"x,Label\n1,a\n", "etiqueta_presente")])
def test_other_headers(spark, tmp_path, header, state):
    root = str(tmp_path / "h")
    _put(root, "A/a.csv", b"x,n\n1,2\n")
    _put(root, "B/b.csv", header)
    scanned = checked.scan(spark, root)
    row = by_name(checked.file_inventory(scanned), root)["B/b.csv"]
    assert (row["lineas"], row["filas"], row["estado"]) == (1, 0, state)
    assert [(r["linea"], r["motivo"]) for r in checked.rejected(scanned).collect()] == [(1, state)]
    with pytest.raises(Exception, match=state):
        checked.read_rows(spark, root).collect()
    assert checked.read_rows(spark, root, mode="drop").count() == 1


def test_unusable_first_header(tmp_path):
    root = str(tmp_path / "u")
    with pytest.raises(Exception):
        checked.expected_header(root)
    _put(root, "A/a.csv", b"")
    with pytest.raises(ValueError, match="sin_cabecera"):
        checked.expected_header(root)
    _put(root, "A/b.csv", b"Label,x\n")
    with pytest.raises(ValueError, match="etiqueta_presente"):
        checked.expected_header(root)


@pytest.mark.parametrize("size,block", [(3, 3), (7, 4), (1000, 64)])
def test_any_cut_gives_the_same_lines(spark, tmp_path, monkeypatch, size, block):
    monkeypatch.setattr(checked, "BLOCK_BYTES", block)
    rng = random.Random(size)
    root = str(tmp_path / "r")
    want_rows, want_rejects = [], []
    for f in range(6):
        lines = [rng.choice(["1,2", "", "33,444", "5", "6,7,8", "é,ñ", ",", "long" * 20 + ",x"]) for _ in range(rng.randint(0, 25))]
        ending = rng.choice(["\n", "\r\n"])
        ended = rng.random() < 0.5
        text = ending.join(["x,n", *lines]) + ending * ended
        if lines and not lines[-1] and not ended:
            # Nothing behind the last line end is no line.
            lines.pop()
        _put(root, f"c{f}/f.csv", text.encode())
        want_rows += [(f"c{f}", *line.split(",")) for line in lines if line.count(",") == 1]
        want_rejects += [(f"c{f}", i + 2, line) for i, line in enumerate(lines) if line.count(",") != 1]
    rows = checked.read_rows(spark, root, mode="drop", rangeBytes=str(size))
    got = rows.select(files.directory_label(F.col("archivo")), "x", "n").collect()
    assert sorted(map(tuple, got)) == sorted(want_rows)
    assert rows.select("archivo", "posicion").distinct().count() == len(want_rows)
    scanned = checked.scan(spark, root, rangeBytes=str(size))
    found = checked.rejected(scanned).select(files.directory_label(F.col("archivo")), "linea", "texto").collect()
    assert sorted(map(tuple, found)) == sorted(want_rejects)
    assert checked.file_inventory(scanned).count() == 6


def test_a_file_is_read_by_many_tasks(spark, tmp_path):
    root = str(tmp_path / "big")
    _put(root, "A/a.csv", b"x,n\n" + b"".join(b"%d,%d\n" % (i, i) for i in range(500_000)))
    rows = checked.read_rows(spark, root, rangeBytes=str(1 << 20))
    assert rows.rdd.getNumPartitions() >= 6
    assert rows.agg(F.sum(F.col("x").cast("long"))).first()[0] == 500_000 * 499_999 // 2


def test_source_checks(spark):
    good = spark.createDataFrame([("A", 2, 0, 0), ("B", 1, 0, 0)], "Label string, filas long, rechazadas long, archivos_malos long")
    assert all(r["ok"] for r in checked.source_checks(good).collect())
    bad = spark.createDataFrame([("A", 2, 1, 0), ("B", 0, 0, 1)], good.schema)
    assert {r["comprobacion"]: (r["valor"], r["ok"]) for r in checked.source_checks(bad).collect()} == {
        "cabeceras_iguales": (1, False), "hay_filas": (2, True), "clases_con_filas": (1, False), "sin_lineas_rechazadas": (1, False),
    }
