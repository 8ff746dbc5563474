import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from flowops.functions import columns as c
from flowops.operators import cleaning, deriving, groups, profiling
from flowops.spec import FLOW, LABEL_FAMILY, family_dimension, protocol_dimension

INF, NAN = float("inf"), float("nan")
LARGEST = 1.7976931348623157e308
VALUES = [1.5, None, NAN, INF, -INF, LARGEST, 0.0, -0.0]
MINI = replace(FLOW, columns=("Label", "x", "n"), integers=("n",), distinct=("Label", "x"))


@pytest.fixture(scope="module")
def missing(spark):
    rows = [("a", x, i) for i, x in enumerate(VALUES)]
    return spark.createDataFrame(rows, "Label string, x double, n bigint")


def test_finite(missing):
    got = [r[0] for r in missing.orderBy("n").select(c.is_finite(F.col("x"))).collect()]
    assert got == [True, False, False, False, False, True, True, True]


def test_nullify_keeps_rows(missing):
    got = [r["x"] for r in cleaning.nullify(missing, ["x"]).orderBy("n").collect()]
    assert got == [1.5, None, None, None, None, LARGEST, 0.0, -0.0]


def test_rounding_passes_special_values_and_large_numbers(spark):
    xs = [0.1234565, 2.5e-7, 1e300, INF, -INF, 123456789.1234567, -0.5]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(c.round_decimals(F.col("x"))).collect()]
    assert got == [round(x * 1e6) / 1e6 if abs(x) < 9e9 else x for x in xs]


def test_clean_rows_and_report(missing):
    assert sorted(r["n"] for r in cleaning.clean_rows(missing, MINI).collect()) == [0, 5, 6, 7]
    report = cleaning.clean_report(missing, MINI).collect()
    assert [tuple(r) for r in report] == [("x", 4, 0, 4)]


def test_clean_report_of_empty_table(missing):
    assert cleaning.clean_report(missing.limit(0), MINI).collect() == []


def test_validation_counts_copies(spark, missing):
    row = profiling.validation(missing.union(missing.where("n IN (1, 3)")), MINI).first()
    assert tuple(row) == (10, 3, 2, 3, 2)


def test_profile(missing):
    rows = {r["columna"]: r for r in profiling.column_profile(missing, MINI).collect()}
    x = rows["x"]
    assert (x["tipo"], x["celdas_no_validas"], x["minimo_valido"], x["maximo_valido"]) == ("decimal", 4, 0.0, LARGEST)
    # 1.5, NULL, NaN, inf, -inf, the largest double, and one zero.
    assert x["distintos"] == 7
    assert rows["n"]["tipo"] == "entero" and rows["n"]["distintos"] is None
    assert rows["Label"]["tipo"] == "texto" and rows["Label"]["distintos"] == 1
    assert rows["Label"]["minimo_valido"] is None


def test_percentage_and_ratio_of_nothing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    got = df.select(c.pct(F.col("a"), F.col("b")), c.ratio(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (0.0, 0.0), (25.0, 0.25)]


def test_first_positive_wins_not_largest(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.2, 0.9), (0.0, 0.1), (-1.0, 0.0)], "a double, b double")
    got = [r[0] for r in df.select(c.first_positive(["a", "b"], "otro")).collect()]
    assert got == ["otro", "a", "b", "otro"]


def test_bands_include_their_upper_bound(spark):
    low, high = 0.25, 0.5
    xs = [0.0, low, math.nextafter(low, 1), high, math.nextafter(high, 1)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(c.band(F.col("x"), F.lit(low), F.lit(high), deriving.BANDS)).collect()]
    assert got == ["bajo", "bajo", "medio", "medio", "alto"]


def test_decimal_text(spark):
    df = spark.createDataFrame([(3.0,), (3.25,), (0.0000004,), (1e7,), (INF,), (NAN,), (None,)], "x double")
    got = [r[0] for r in df.select(c.decimal_text(F.col("x"))).collect()]
    assert got == ["3.0", "3.25", "0.0", "10000000.0", "", "", ""]


def test_null_markers(spark):
    texts = ["1.10", "inf", "", "NA", "N/A", "NULL", "null", "NaN", "nan", " NA ", "\tnan\t", None, "None"]
    df = spark.createDataFrame([(t, "x") for t in texts], "a string, b string")
    rows = {r["columna"]: r for r in cleaning.null_marker_report(df, ["a", "b"]).collect()}
    assert rows["a"]["celdas_nulas"] == 10 and rows["b"]["celdas_nulas"] == 0
    assert rows["a"]["filas_con_nulo"] == 10


def test_labels_unknown_and_missing(spark):
    labels = [*LABEL_FAMILY, "Unknown", None]
    df = spark.createDataFrame([(label,) for label in labels], "Label string")
    mapped = {r["Label"]: r["Attack_Family"] for r in deriving.lookup(df, family_dimension(spark), "Label").collect()}
    assert mapped == {**LABEL_FAMILY, "Unknown": None, None: None}
    assert mapped["VulnerabilityScan"] == "Recon"
    split = {r["Traffic_Type"]: r["cantidad"] for r in groups.traffic_split(df, FLOW).collect()}
    assert split == {"Benign": 1, "Malicious": len(labels) - 1}
    # The filter follows SQL: a missing label is neither equal nor unequal.
    assert groups.malicious_share(df, FLOW).first()["cantidad"] == len(labels) - 2


def test_protocol_names(spark):
    got = {r[0]: r[1] for r in protocol_dimension(spark).collect()}
    assert got == {0: "HOPOPT", 1: "ICMP", 6: "TCP", 17: "UDP", 47: "GRE"}


def test_top_attacks_breaks_ties_by_name(spark):
    df = spark.createDataFrame([(x,) for x in "bbaaccdBenign".split("d")[0]] + [("Benign",)] * 4, "Label string")
    got = [r["Label"] for r in groups.top_attacks(df, FLOW, 2).collect()]
    assert got == ["a", "b"]


def test_profile_makes_pairs_of_counted_columns_only(spark):
    from flowops.spec import Spec

    rows = spark.createDataFrame([(1, 2.5, "a"), (None, float("inf"), None), (3, -1.0, "b")], "n long, x double, t string")
    spec = Spec(columns=("n", "x", "t"), integers=("n",), texts=("t",), label="t")
    found = profiling.column_profile(rows, spec)
    assert "_kw" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = [(r["columna"], r["celdas_no_validas"], r["distintos"], r["minimo_valido"], r["maximo_valido"]) for r in found.collect()]
    assert got == [("n", 1, None, 1.0, 3.0), ("x", 1, None, -1.0, 2.5), ("t", 1, None, None, None)]
    assert profiling.column_profile(rows.where("n > 9"), spec).count() == 0
