import hashlib
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from flowops.operators import ordering, sampling


def exact_quotas(counts, target, minimum=1):
    """Largest remainder with rational arithmetic."""
    spare = target - minimum * len(counts)
    weights = {k: n - minimum for k, n in counts.items()}
    total = sum(weights.values())
    shares = {k: Fraction(spare * w, total) if total else Fraction(0) for k, w in weights.items()}
    quotas = {k: minimum + int(s) for k, s in shares.items()}
    left = target - sum(quotas.values())
    for k in sorted(counts, key=lambda k: (-(shares[k] - int(shares[k])), k))[:left]:
        quotas[k] += 1
    return quotas


@pytest.mark.parametrize(
    "counts,target",
    [
        ({"a": 1, "b": 10, "c": 100}, 20),
        ({"a": 5, "b": 5, "c": 5}, 7),
        ({"a": 3, "b": 4}, 7),
        ({"a": 1, "b": 1}, 2),
        ({"huge": 3 * 10**11, "b": 7, "c": 6 * 10**11}, 10**9),
    ],
)
def test_class_quotas(spark, counts, target):
    df = spark.createDataFrame(list(counts.items()), "Label string, filas bigint")
    got = {r["Label"]: r["cuota"] for r in sampling.class_quotas(df, target, "Label").collect()}
    assert got == exact_quotas(counts, target)
    assert sum(got.values()) == target


@pytest.mark.parametrize(
    "counts,target,message",
    [({"a": 0, "b": 5}, 3, "too few rows"), ({"a": 2, "b": 2}, 5, "larger than the population"),
     ({"a": 5, "b": 5, "c": 5}, 2, "smaller than the number of classes")],
)
def test_quota_guards(spark, counts, target, message):
    df = spark.createDataFrame(list(counts.items()), "Label string, filas bigint")
    with pytest.raises(Exception, match=message):
        sampling.class_quotas(df, target, "Label").collect()


@pytest.mark.parametrize("few", [True, False])
def test_sample_is_exact_with_a_hot_stratum(spark, few):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(6000)]
    df = spark.createDataFrame(rows, "id bigint, g string")
    counts = Counter(g for _, g in rows)
    quotas = {g: n // 4 for g, n in counts.items()}
    table = spark.createDataFrame(list(quotas.items()), "g string, cuota bigint")
    got = [tuple(r) for r in sampling.stratified_sample(df, ["g"], table, ["id"], 9, few).collect()]
    want = set()
    for g in counts:
        ordered = sorted((hashlib.md5(f"9|{i}".encode()).hexdigest(), i) for i, h in rows if h == g)
        want |= {(i, g) for _, i in ordered[: quotas[g]]}
    assert len(got) == len(want) and set(got) == want


def test_sample_whole_population_and_nothing(spark):
    df = spark.createDataFrame([(i, "a" if i < 5 else "b") for i in range(9)], "id bigint, g string")
    table = spark.createDataFrame([("a", 5), ("b", 0)], "g string, cuota bigint")
    got = sorted(r["id"] for r in sampling.stratified_sample(df, ["g"], table, ["id"], 1).collect())
    assert got == [0, 1, 2, 3, 4]


def test_sample_checks_notice_a_missing_class(spark):
    quotas = spark.createDataFrame([("a", 2), ("b", 1)], "g string, cuota bigint")
    sample = spark.createDataFrame([("a",), ("a",), ("c",)], "g string")
    rows = {r["comprobacion"]: r for r in sampling.sample_checks(sample, quotas, "g", 3, 1).collect()}
    assert rows["filas"]["ok"] and rows["columnas"]["ok"]
    assert not rows["clases_faltantes"]["ok"] and not rows["clases_extra"]["ok"]


def test_sort_splits_copies_and_stays_ordered(spark):
    rows = [(6, 10)] * 5000 + [(i % 3, (i * 37) % 101) for i in range(3000)]
    df = spark.createDataFrame(rows, "protocol int, rate int").repartition(5)
    ordered = ordering.secondary_sort(df, 4)
    got = [tuple(r) for r in ordered.collect()]
    assert got == sorted(rows)
    sizes = ordered.withColumn("part", F.spark_partition_id()).where("protocol = 6").groupBy("part").count().collect()
    assert len(sizes) > 1, "the copies of one record must not all lie in one partition"
    check = ordering.order_check(ordered, ["protocol", "rate"]).first()
    assert tuple(check) == (len(rows), 0, 0, True)


def test_order_check_finds_inversions(spark):
    inside = spark.createDataFrame([(1,), (3,), (2,)], "k int").coalesce(1)
    row = ordering.order_check(inside, ["k"]).first()
    assert (row["descensos_internos"], row["ordenado"]) == (1, False)
    across = spark.sparkContext.parallelize([(5,), (1,)], 2).toDF("k int")
    row = ordering.order_check(across, ["k"]).first()
    assert (row["descensos_internos"], row["descensos_entre_partes"], row["ordenado"]) == (0, 1, False)


def test_derived_records(spark):
    from flowops.spec import FLOW

    rates = [0.5, 1.5, 2.5, 1234567890.0, float("inf"), None]
    df = spark.createDataFrame([(r, 6, "L" * 95) for r in rates], "Rate double, `Protocol Type` bigint, Label string")
    assert [r["rate"] for r in ordering.sort_pairs(df, FLOW).collect()] == [0, 2, 2, 1234567890]
    record = ordering.fixed_width_records(df, FLOW).first()
    assert record["key"] == "0000000000" and record["payload"] == "L" * 90


def test_sample_quality(spark):
    rows = [("a", "1"), ("a", "1"), ("NA", None), ("b", " nan ")]
    got = sampling.sample_quality(spark.createDataFrame(rows, "x string, y string")).first()
    assert tuple(got) == (4, 2, 1, 3, 3, 2)


def test_order_check_of_files_in_part_order(spark, tmp_path):
    from flowops.sources import files, sinks

    rows = [(6, i % 9) for i in range(500)] + [(1, 5)] * 700
    pairs = spark.createDataFrame(rows, "protocol int, rate int").repartition(3)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    sinks.write_lines(ordering.secondary_sort(pairs, 4), good)
    sinks.write_lines(pairs, bad)
    check = lambda path: ordering.order_check(files.read_sorted_pairs(spark, path, True), ["protocol", "rate"], files.PLACE).first()
    assert tuple(check(good)) == (len(rows), 0, 0, True)
    assert check(bad)["descensos_internos"] > 0 and not check(bad)["ordenado"]


def test_no_array_per_record_in_the_sort(spark):
    df = spark.createDataFrame([(1, 2)] * 30 + [(3, 4)] * 60, "protocol int, rate int")
    plan = ordering.secondary_sort(df, 4)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "sequence" not in plan


def test_guards_as_rows(spark):
    counts = spark.createDataFrame([("a", 0), ("b", 5)], "g string, filas bigint")
    got = {r["comprobacion"]: r["ok"] for r in sampling.quota_guards(counts, 6, "g").collect()}
    assert got == {"poblacion_suficiente": False, "muestra_cubre_clases": True, "clases_con_filas": False}


def test_checks_per_file(spark):
    quotas = spark.createDataFrame([("a", "f", 1), ("a", "g", 1)], "k string, file string, cuota bigint")
    sample = spark.createDataFrame([("a", "f"), ("a", "f")], "k string, file string")
    rows = {r["comprobacion"]: r for r in sampling.sample_checks(sample, quotas, "k", 2, 2, "file").collect()}
    assert rows["clases_con_otra_cuota"]["ok"]
    assert rows["archivos_faltantes"]["actual"] == 1 and rows["archivos_con_otra_cuota"]["actual"] == 2


def water_level(weights, rooms, units):
    """Shares by their definition: the level that spends all units, then largest remainders."""
    from fractions import Fraction

    breaks = sorted({Fraction(r, w) for w, r in zip(weights, rooms)})
    spent = lambda level: sum(min(Fraction(r), w * level) for w, r in zip(weights, rooms))
    below = max([b for b in breaks if spent(b) <= units], default=Fraction(0))
    open_weight = sum(w for w, r in zip(weights, rooms) if Fraction(r, w) > below)
    level = below + ((units - spent(below)) / open_weight if open_weight else 0)
    return [min(Fraction(r), w * level) for w, r in zip(weights, rooms)]


def capped_brute(rows, target):
    """rows: (name, weight, capacity, minimum)."""
    got = {n: m for n, _, _, m in rows}
    units = target - sum(got.values())
    for tier in (True, False):
        own = sorted((n, w if tier else 1, c - m) for n, w, c, m in rows if (w > 0) == tier)
        if not own:
            continue
        here = min(units, sum(r for *_, r in own))
        exact = water_level([w for _, w, _ in own], [r for *_, r in own], here)
        whole = [int(e) for e in exact]
        order = sorted(range(len(own)), key=lambda i: (-(exact[i] - whole[i]), own[i][0]))
        # Equal shares of weight-less strata have equal remainders, also where these are whole.
        if not tier:
            order = [i for i in order if exact[i] < own[i][2]] + [i for i in order if exact[i] == own[i][2]]
        for i in order[: here - sum(whole)]:
            whole[i] += 1
        for (n, *_), w in zip(own, whole):
            got[n] += w
        units -= here
    return got


@pytest.mark.parametrize("seed", range(6))
def test_capped_quotas_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, goals = [], {}
    for case in range(40):
        own = []
        for i in range(rng.randint(1, 9)):
            capacity = rng.choice([0, 1, 3, 10, 1000, 10**12 - rng.randint(0, 9)])
            own.append((f"s{i}", rng.choice([0, 0, 1, 2, 7, 500, 10**12 - i]), capacity, rng.randint(0, min(capacity, 2))))
        low, high = sum(o[3] for o in own), sum(o[2] for o in own)
        goals[case] = rng.choice([low, high, (low + high) // 2, low + (high - low) // 7])
        rows += [(case, *o, goals[case]) for o in own]
    df = spark.createDataFrame(rows, "c int, s string, w bigint, cap bigint, least bigint, goal bigint")
    got = {}
    for r in sampling.capped_quotas(df, F.col("goal"), "w", "cap", ["s"], "least", ["c"]).collect():
        got.setdefault(r["c"], {})[r["s"]] = r["cuota"]
    for case, goal in goals.items():
        own = [r[1:5] for r in rows if r[0] == case]
        assert got[case] == capped_brute(own, goal), (own, goal)
        assert sum(got[case].values()) == goal


@pytest.mark.parametrize("rows,target,message", [
    ([("a", 1, 2, 0), ("b", 1, 2, 0)], 5, "capacities are below"),
    ([("a", 1, 2, 2), ("b", 1, 2, 2)], 3, "below the sum of the minimums"),
    ([("a", 1, 2, 3)], 3, "above its capacity"),
    ([("a", -1, 2, 0)], 1, "cannot be negative"),
    ([("a", 10**13, 2, 0)], 1, "10\\*\\*12"),
])
def test_capped_quotas_refuse(spark, rows, target, message):
    df = spark.createDataFrame(rows, "s string, w bigint, cap bigint, least bigint")
    with pytest.raises(Exception, match=message):
        sampling.capped_quotas(df, target, "w", "cap", ["s"], "least").collect()


@pytest.mark.parametrize("few", [True, False])
def test_sample_is_exact_with_repeated_and_null_keys(spark, few):
    rows = [(i % 7 if i % 5 else None, "g", f"row {i}") for i in range(90)] + [(1, None, f"n {i}") for i in range(9)]
    df = spark.createDataFrame(rows, "id bigint, g string, text string").repartition(4)
    for quota in (1, 17, 40, 89, 90):
        table = spark.createDataFrame([("g", quota), (None, 4)], "g string, cuota bigint")
        got = [tuple(r) for r in sampling.stratified_sample(df, ["g"], table, ["id"], 3, few).collect()]
        assert len(got) == len(set(got)) == quota + 4
        assert sum(r[1] is None for r in got) == 4
        again = sampling.stratified_sample(df.repartition(3), ["g"], table, ["id"], 3, few).collect()
        assert set(map(tuple, again)) == set(got)


def test_whole_rows_are_read_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id % 3 AS g", "repeat('x', 50) AS text").write.parquet(path)
    df = spark.read.parquet(path)
    table = spark.createDataFrame([(0, 10), (1, 20), (2, 30)], "g bigint, cuota bigint")
    plan = sampling.stratified_sample(df, ["g"], table, ["id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("text:string") == 1 or plan.count("FileScan parquet") == 2
    assert sum("text" in line for line in plan.splitlines() if "ReadSchema" in line) == 1


def test_record_keys_are_padded_as_numbers(spark):
    from flowops.spec import FLOW

    rows = spark.createDataFrame([("a", 6, r) for r in (0.5, 1.5, -7.0, 123456789.0, 2147483647.0)], "Label string, `Protocol Type` long, Rate double")
    records = ordering.fixed_width_records(rows, FLOW)
    assert [r["key"] for r in records.collect()] == ["0000000000", "0000000002", "-000000007", "0123456789", "2147483647"]
