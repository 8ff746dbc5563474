import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowops.operators import percentiles as p

WANTED = {
    "m": p.median("x"),
    "p25": p.Wanted("x", 0.25),
    "r50": p.nearest_rank("x", 0.5),
    "r95": p.nearest_rank("x", 0.95),
    "r99": p.nearest_rank("x", 0.99),
    "y50": p.median("y"),
}


def nearest(values, fraction):
    ordered = sorted(values)
    return ordered[max(0, min(len(ordered) - 1, math.ceil(fraction * len(ordered)) - 1))]


def brute(rows):
    out = {}
    for g in {r[0] for r in rows}:
        x = [r[1] for r in rows if r[0] == g and r[1] is not None]
        y = [r[2] for r in rows if r[0] == g and r[2] is not None]
        out[g] = {
            "m": float(np.percentile(x, 50)) if x else None,
            "p25": float(np.percentile(x, 25)) if x else None,
            "r50": nearest(x, 0.5) if x else None,
            "r95": nearest(x, 0.95) if x else None,
            "r99": nearest(x, 0.99) if x else None,
            "y50": float(np.percentile(y, 50)) if y else None,
        }
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    # One group holds a third of the rows, one value a third of that; one group has no value of x.
    data = [("hot", 7.0 if i % 3 == 0 else rng.lognormvariate(0, 3), float(i % 11)) for i in range(3000)]
    data += [(rng.choice("abc"), rng.gauss(0, 5), rng.choice([None, 1.0, 2.0])) for _ in range(6000)]
    data += [("one", 4.5, None), ("none", None, 3.0), (None, 1.0, 1.0), (None, 2.0, 4.0)]
    return data


def test_selection_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g string, x double, y double")
    want = brute(rows)
    got = {r["g"]: r for r in p.select_percentiles(df, ["g"], WANTED).collect()}
    assert set(got) == set(want)
    for g, w in want.items():
        for k, v in w.items():
            assert (got[g][k] is None) == (v is None), (g, k)
            if v is not None:
                assert math.isclose(got[g][k], v, rel_tol=1e-12, abs_tol=1e-12), (g, k)


def test_intervals_too_many_to_broadcast(spark, rows):
    """With many groups the intervals are shuffled to the values, with equal results."""
    data = [(f"{r[0]}{i % 400}", *r[1:]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        found = p.select_percentiles(df, ["g"], WANTED)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
        got = {r["g"]: r for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    want = brute(data)
    assert len(got) > 1000
    for g, w in want.items():
        if any(v is not None for v in w.values()):
            assert all(v is None and got[g][k] is None or math.isclose(got[g][k], v, rel_tol=1e-12, abs_tol=1e-12) for k, v in w.items())


def test_overlapping_brackets_are_one_interval(spark):
    values = spark.createDataFrame([(0, float(v)) for v in range(1, 2001)], "_c int, _v double")
    wanted = {f"p{i}": p.Wanted("x", 0.5 + i / 1e6, linear=i % 2 == 0) for i in range(6)} | {"top": p.nearest_rank("x", 0.99)}
    found = p._intervals(values, [], ["x"], wanted).collect()
    assert sorted(len(r["_asked"]) for r in found) == [1, 6]
    ordered = sorted((r["_low"], r["_high"]) for r in found)
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


@pytest.mark.parametrize("by", [["g"], []])
def test_summary_joins_aggregates_and_percentiles(spark, rows, by):
    df = spark.createDataFrame(rows, "g string, x double, y double")
    aggregates = [F.count(F.lit(1)).alias("n"), F.max("x").alias("top")]
    got = {r["g"] if by else "all": r for r in p.group_summary(df, by, aggregates, WANTED).collect()}
    want = brute(rows if by else [("all", *r[1:]) for r in rows])
    assert set(got) == set(want)
    for g, w in want.items():
        own = [r for r in rows if not by or r[0] == g]
        assert got[g]["n"] == len(own)
        assert got[g]["top"] == max((r[1] for r in own if r[1] is not None), default=None)
        assert all(v is None and got[g][k] is None or math.isclose(got[g][k], v, rel_tol=1e-12) for k, v in w.items())


def test_extreme_values_and_signs(spark):
    values = [-math.inf, -1e300, -2.5, -5e-324, 0.0, -0.0, 5e-324, 1.0, 1.0000000001, 1e300, math.inf, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(v for v in values if not math.isnan(v))
    for fraction in (0.05, 0.3, 0.5, 0.8, 0.99):
        got = p.select_percentiles(df, [], {"r": p.nearest_rank("x", fraction)}).first()["r"]
        assert got == nearest(ordered, fraction)


@pytest.mark.parametrize("n", [1, 20, 100])
def test_nearest_rank(spark, n):
    df = spark.range(1, n + 1).select(F.col("id").cast("double").alias("v"))
    row = p.Limits.of(df, ["v"]).table().first()
    for percent in p.THRESHOLD_PERCENTS:
        assert row[f"p{percent}"] == nearest(range(1, n + 1), percent / 100)


def test_thresholds_keep_infinities_and_count_nulls(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),), (None,), (2.0,)], "v double")
    row = p.Limits.of(df, ["v"]).table().first()
    assert (row["conteo"], row["nulos"], row["min"], row["max"], row["media"]) == (3, 1, 1.0, float("inf"), float("inf"))
    assert (row["p50"], row["p99"]) == (2.0, float("inf"))


def test_thresholds_of_nothing(spark):
    row = p.Limits.of(spark.createDataFrame([], "v double"), ["v"]).table().first()
    assert (row["conteo"], row["p50"], row["max"]) == (0, 0.0, 0.0)
