"""Exact-size stratified sampling: integer quotas, selection, checks, comparison with the population."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowops.functions.columns import is_null_marker, pct, qcol
from flowops.operators.cleaning import NULL_MARKERS
from flowops.session import written

WHOLE = "decimal(38,0)"
# Two bytes of the hash: 65,536 buckets per stratum.
BUCKET_DIGITS = 4
# Strata that are few enough for their cuts, some forty bytes each, to be sent to every task.
FEW_STRATA = 500_000


def _fail_if(test: Column, message: str) -> Column:
    """NULL, or an error when the test holds; evaluated inside the plan, without an extra job."""
    return F.when(test, F.raise_error(F.lit(message)).cast("bigint"))


def strata_counts(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    return df.groupBy(*map(qcol, strata)).agg(F.count(F.lit(1)).alias("filas"))


def _largest_remainder(
    groups: DataFrame, units: Column, weight: Column, within: Sequence[str], ties: Sequence[Column]
) -> DataFrame:
    """Adds ``_units``: ``units`` split in proportion to ``weight``, exact to the last unit.

    Integer arithmetic on decimals: floor of each share, then one unit more for the largest
    remainders. ``groups`` has one row per stratum.
    """
    scope = Window.partitionBy(*map(qcol, within))
    weighed = groups.withColumns({"_w": weight.cast(WHOLE), "_t": units.cast(WHOLE)}).withColumn(
        "_all", F.sum("_w").over(scope).cast(WHOLE)
    )
    positive = F.col("_all") > 0
    floors = weighed.withColumns(
        {
            "_floor": F.when(positive, F.expr("CAST(_t * _w AS decimal(38,0)) div _all")).otherwise(0),
            "_rest": F.when(positive, F.expr("CAST(_t * _w AS decimal(38,0)) % _all")).otherwise(0),
        }
    ).withColumn("_left", F.col("_t") - F.sum("_floor").over(scope))
    order = scope.orderBy(F.desc("_rest"), *ties)
    extra = F.when(F.row_number().over(order) <= F.col("_left"), 1).otherwise(0)
    return floors.withColumn("_units", F.col("_floor") + extra).drop(
        "_w", "_t", "_all", "_floor", "_rest", "_left"
    )


def class_quotas(
    counts: DataFrame, target: int | Column, label: str, minimum: int = 1, rows: str = "filas"
) -> DataFrame:
    """Quota per class: ``minimum`` rows each, the rest in proportion to the rows beyond it.

    ``counts`` has one row per class, which is all that the unpartitioned window orders.
    """
    everything = Window.partitionBy()
    n = F.col(rows)
    total, classes = F.sum(n).over(everything), F.count(F.lit(1)).over(everything)
    guarded = counts.withColumn(
        "_spare",
        F.coalesce(
            _fail_if(n < minimum, "a class has too few rows to be preserved"),
            _fail_if(total < target, "the sample is larger than the population"),
            _fail_if(classes * minimum > target, "the sample is smaller than the number of classes"),
            F.lit(target) - classes * minimum,
        ),
    )
    split = _largest_remainder(guarded, F.col("_spare"), n - minimum, [], [qcol(label).asc()])
    return split.select(
        qcol(label), rows, (F.col("_units") + minimum).cast("bigint").alias("cuota")
    )


def file_quotas(
    counts: DataFrame, quotas: DataFrame, label: str, file: str, rows: str = "filas"
) -> DataFrame:
    """Quota per file inside each class, in proportion to its rows.

    One row per file; the class quotas are joined without a hint, so their size decides the plan.
    """
    joined = counts.join(quotas.select(qcol(label), F.col("cuota").alias("_class")), label)
    split = _largest_remainder(
        joined, F.col("_class"), F.col(rows), [label], [F.lower(qcol(file)).asc(), qcol(file).asc()]
    )
    return split.select(
        qcol(label), qcol(file), rows, F.col("_units").cast("bigint").alias("cuota")
    )


def capped_quotas(
    groups: DataFrame,
    target: int | Column,
    weight: str,
    capacity: str,
    ties: Sequence[str],
    minimum: int | str = 0,
    within: Sequence[str] = (),
) -> DataFrame:
    """Adds ``cuota``: ``target`` units in proportion to any weights, none above its capacity.

    Every stratum (one row each, inside each ``within``) gets its minimum first. Where a share would reach the
    room that is left, the stratum is filled and the rest is shared anew, which ends at one level of units per
    weight; it is found by break points: in order of room per weight, a stratum is full if sharing what the
    earlier ones leave would reach its room. Remainders go to the largest, ties in order of ``ties``. Strata
    of weight 0 get units only once all others are full, one each in turn. Exact for sizes and weights up to 10**12.
    """
    scope = Window.partitionBy(*map(qcol, within))
    least = qcol(minimum) if isinstance(minimum, str) else F.lit(minimum)
    sized = groups.withColumns(
        {"_w": qcol(weight).cast(WHOLE), "_least": least.cast(WHOLE), "_cap": qcol(capacity).cast(WHOLE), "_goal": F.lit(target).cast(WHOLE)}
    )
    most = F.lit(10**12)
    guards = [
        _fail_if((F.col("_w") < 0) | (F.col("_cap") < 0) | (F.col("_least") < 0), "weights, capacities and minimums cannot be negative"),
        _fail_if((F.col("_w") > most) | (F.col("_cap") > most), "weights and capacities above 10**12 cannot be shared exactly"),
        _fail_if(F.col("_least") > F.col("_cap"), "a minimum is above its capacity"),
        _fail_if(F.sum("_least").over(scope) > F.col("_goal"), "the target is below the sum of the minimums"),
        _fail_if(F.sum("_cap").over(scope) < F.col("_goal"), "the capacities are below the target"),
    ]
    room = (F.coalesce(*guards, F.col("_cap")) - F.col("_least")).cast(WHOLE)
    rest = F.col("_goal") - F.sum("_least").over(scope)
    roomy = sized.select("*", room.alias("_room"), rest.cast(WHOLE).alias("_rest_all"))
    first = F.least("_rest_all", F.coalesce(F.sum(F.when(F.col("_w") > 0, F.col("_room"))).over(scope), F.lit(0)))
    tiers = roomy.select("*", (F.col("_w") == 0).alias("_tier"), F.greatest("_w", F.lit(1)).cast(WHOLE).alias("_v"), first.cast(WHOLE).alias("_first"))
    share = F.when(F.col("_tier"), F.col("_rest_all") - F.col("_first")).otherwise(F.col("_first")).cast(WHOLE)
    # Room per weight as three whole numbers, the fraction to 24 digits.
    parts = tiers.select("*", share.alias("_share"), F.expr("_room div _v").alias("_q1"), F.expr("CAST((_room % _v) * 1000000000000 AS decimal(38,0))").alias("_r1"))
    parts = parts.select("*", F.expr("_r1 div _v").alias("_q2"), F.expr("CAST((_r1 % _v) * 1000000000000 AS decimal(38,0)) div _v").alias("_q3"))
    own = [*map(qcol, within), F.col("_tier")]
    filling = Window.partitionBy(*own).orderBy("_q1", "_q2", "_q3", *map(qcol, ties))
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        "*",
        F.coalesce(F.sum("_room").over(earlier), F.lit(0)).cast(WHOLE).alias("_full"),
        (F.sum("_v").over(Window.partitionBy(*own)) - F.coalesce(F.sum("_v").over(earlier), F.lit(0))).cast(WHOLE).alias("_open"),
    )
    reaches = F.expr("CAST((_share - _full) * _v AS decimal(38,0)) >= CAST(_room * _open AS decimal(38,0))")
    until = filling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    capped = before.select("*", F.min(reaches).over(until).alias("_capped"))
    left = F.col("_share") - F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_room"))).over(Window.partitionBy(*own)), F.lit(0))
    free = F.when(F.col("_capped"), 0).otherwise(F.col("_v"))
    split = _largest_remainder(capped.withColumn("_left_all", left), F.col("_left_all"), free, [*within, "_tier"], [*map(qcol, ties)])
    units = F.col("_least") + F.when(F.col("_capped"), F.col("_room")).otherwise(F.col("_units"))
    return split.select(*[qcol(c) for c in groups.columns], units.cast("bigint").alias("cuota"))


def two_level_quotas(df: DataFrame, target: int | Column, label: str, file: str) -> DataFrame:
    """Class quotas, then file quotas, from one count of the rows per file."""
    files = strata_counts(df, [label, file])
    classes = files.groupBy(qcol(label)).agg(F.sum("filas").alias("filas"))
    return file_quotas(files, class_quotas(classes, target, label), label, file)


def stratified_sample(
    df: DataFrame,
    strata: Sequence[str],
    quotas: DataFrame,
    key: Sequence[str],
    seed: int,
    few_strata: bool = True,
) -> DataFrame:
    """Exactly ``cuota`` whole rows of every stratum: those with the smallest hash of seed and key.

    No stratum is in one task, and whole rows are read once. Strata, keys and hashes alone decide: rows are
    counted per hash bucket, which map-side aggregation shrinks to at most 65,536 rows per stratum; their
    running count names the bucket where the quota is reached, and ranks inside it give the last hash and key
    that belong to the sample. These bounds are written as a table, and a whole row only passes a comparison.
    Where rows of one key straddle the bound, those of that key are ranked by all their columns.
    ``few_strata`` sends the bounds to every task and fails beyond ``FEW_STRATA`` strata; without it they
    are joined by a shuffle.
    """
    place = F.struct(
        F.md5(F.concat_ws("|", F.lit(str(seed)), *[qcol(k).cast("string") for k in key])).alias("h"),
        *[qcol(k).alias(f"k{i}") for i, k in enumerate(key)],
    )
    columns = [qcol(c) for c in strata]
    keyed = df.select(*columns, place.alias("_place")).withColumn("_bucket", F.substring("_place.h", 1, BUCKET_DIGITS))
    order = Window.partitionBy(*columns).orderBy("_bucket")
    filled = keyed.groupBy(*columns, "_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_upto", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    wanted = quotas.select(*columns, F.col("cuota").alias("_quota"))
    buckets = (
        _join_strata(filled, wanted, strata)
        .where((F.col("_upto") - F.col("_n") < F.col("_quota")) & (F.col("_upto") >= F.col("_quota")))
        .select(*columns, F.col("_bucket").alias("_cut"), (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_take"))
    )
    rank = Window.partitionBy(*columns).orderBy("_place")
    inside = _join_strata(keyed, buckets, strata).where(F.col("_bucket") == F.col("_cut"))
    ranked = inside.select(*columns, "_place", "_take", F.row_number().over(rank).alias("_rank"))
    ends = ranked.groupBy(*columns).agg(
        F.max(F.when(F.col("_rank") <= F.col("_take"), F.col("_place"))).alias("_last"), F.max("_take").alias("_take")
    )
    # Of the rows that equal the last place, so many belong to the sample and so many are there.
    at_end = _join_strata(ranked.drop("_take"), ends, strata).where(F.col("_place") == F.col("_last"))
    bounds = written(
        at_end.groupBy(*columns).agg(
            F.max("_last").alias("_last"),
            F.sum(F.when(F.col("_rank") <= F.col("_take"), 1)).alias("_wanted"),
            F.count(F.lit(1)).alias("_there"),
        ),
        "bounds",
    )
    if few_strata and bounds.limit(FEW_STRATA + 1).count() > FEW_STRATA:
        raise ValueError("too many strata to be sent to every task")
    cuts = F.broadcast(bounds) if few_strata else bounds
    own = [qcol(c) for c in df.columns]
    placed = _join_strata(df.withColumn("_place", place), cuts, strata)
    straddles = bounds.where("_wanted < _there")
    if straddles.isEmpty():
        return placed.where(F.col("_place") <= F.col("_last")).select(*own)
    whole = placed.where((F.col("_place") < F.col("_last")) | (F.col("_place") == F.col("_last")) & (F.col("_wanted") == F.col("_there")))
    tied = placed.where((F.col("_place") == F.col("_last")) & (F.col("_wanted") < F.col("_there")))
    texts = F.struct(*[c.cast("string") for c in own])
    chosen = tied.withColumn("_rank", F.row_number().over(Window.partitionBy(*columns).orderBy(texts)))
    return whole.select(*own).unionByName(chosen.where("_rank <= _wanted").select(*own))


def _join_strata(left: DataFrame, right: DataFrame, strata: Sequence[str]) -> DataFrame:
    l, r = left.alias("l"), right.alias("r")
    test = F.lit(True)
    for s in strata:
        test = test & F.col(f"l.`{s}`").eqNullSafe(F.col(f"r.`{s}`"))
    extra = [c for c in right.columns if c not in strata]
    return l.join(r, test).select("l.*", *[F.col(f"r.`{c}`") for c in extra])


def sample_distribution(population: DataFrame, sample: DataFrame, label: str) -> DataFrame:
    """Share of each class in population and sample, and the difference in percentage points.

    Both counts go through one grouping, so a class missing on one side counts as zero.
    """
    both = population.select(qcol(label), F.lit(0).alias("_side")).unionByName(
        sample.select(qcol(label), F.lit(1).alias("_side"))
    )
    counts = both.groupBy(qcol(label)).agg(
        F.count_if(F.col("_side") == 0).alias("original_count"),
        F.count_if(F.col("_side") == 1).alias("sample_count"),
    )
    everything = Window.partitionBy()
    shares = counts.withColumns(
        {
            "_original": pct(F.col("original_count"), F.sum("original_count").over(everything), None),
            "_sampled": pct(F.col("sample_count"), F.sum("sample_count").over(everything), None),
        }
    )
    original, sampled = F.col("_original"), F.col("_sampled")
    return shares.select(
        qcol(label),
        "original_count",
        F.round(original, 6).alias("original_percentage"),
        "sample_count",
        F.round(sampled, 6).alias("sample_percentage"),
        F.round(sampled - original, 6).alias("difference_percentage_points"),
    ).orderBy(qcol(label))


def sample_checks(
    sample: DataFrame, quotas: DataFrame, label: str, target: int | Column, columns: int, file: str | None = None
) -> DataFrame:
    """Post-conditions of a sample as rows (comprobacion, esperado, actual, ok).

    Classes, and with ``file`` the files of each class, must be there as often as their quota says.
    """
    strata = [label, *([file] if file else [])]
    got = strata_counts(sample, strata).select(*map(qcol, strata), F.col("filas").alias("_n"), F.lit(0).alias("_q"))
    wanted = quotas.groupBy(*map(qcol, strata)).agg(F.sum("cuota").alias("_q")).select(
        *map(qcol, strata), F.lit(0).cast("bigint").alias("_n"), F.col("_q")
    )
    per_file = got.unionByName(wanted).groupBy(*map(qcol, strata)).agg(
        F.sum("_n").alias("_n"), F.sum("_q").alias("_q")
    )
    per_class = per_file.groupBy(qcol(label)).agg(
        F.sum("_n").alias("_n"),
        F.sum("_q").alias("_q"),
        F.count_if((F.col("_n") == 0) & (F.col("_q") > 0)).alias("_missing"),
        F.count_if((F.col("_n") > 0) & (F.col("_q") == 0)).alias("_extra"),
        F.count_if(F.col("_n") != F.col("_q")).alias("_different"),
    )
    wide = per_class.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count_if((F.col("_n") == 0) & (F.col("_q") > 0)).alias("missing"),
        F.count_if((F.col("_n") > 0) & (F.col("_q") == 0)).alias("extra"),
        F.count_if(F.col("_n") != F.col("_q")).alias("different"),
        *[F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(f"file_{n}") for n in ("missing", "extra", "different")],
    )
    expected = [
        ("filas", F.lit(target), F.col("rows")),
        ("columnas", F.lit(columns), F.lit(len(sample.columns))),
        ("clases_faltantes", F.lit(0), F.col("missing")),
        ("clases_extra", F.lit(0), F.col("extra")),
        ("clases_con_otra_cuota", F.lit(0), F.col("different")),
    ]
    if file:
        expected += [
            ("archivos_faltantes", F.lit(0), F.col("file_missing")),
            ("archivos_extra", F.lit(0), F.col("file_extra")),
            ("archivos_con_otra_cuota", F.lit(0), F.col("file_different")),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("comprobacion"),
            want.cast("bigint").alias("esperado"),
            have.cast("bigint").alias("actual"),
            (want.cast("bigint") == have.cast("bigint")).alias("ok"),
        )
        for name, want, have in expected
    ]
    return wide.select(F.inline(F.array(*rows)))


def quota_guards(counts: DataFrame, target: int | Column, label: str, minimum: int = 1, rows: str = "filas") -> DataFrame:
    """The conditions a sample needs, as rows (comprobacion, ok) instead of an error."""
    wide = counts.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("_rows"),
        F.count(F.lit(1)).alias("_classes"),
        F.count_if(F.col(rows) < minimum).alias("_small"),
    )
    t = F.lit(target).cast("bigint")
    tests = {
        "poblacion_suficiente": F.col("_rows") >= t,
        "muestra_cubre_clases": F.col("_classes") * minimum <= t,
        "clases_con_filas": F.col("_small") == 0,
    }
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("comprobacion"), test.alias("ok")) for n, test in tests.items()]))
    )


def sample_quality(sample: DataFrame) -> DataFrame:
    """Rows, columns, repeated and unique rows, missing cells and rows with any, as one record.

    Cells are compared as text. One scan: cells are counted per distinct row, weighted by its copies.
    """
    texts = sample.select(*[F.coalesce(qcol(c).cast("string"), F.lit("")).alias(c) for c in sample.columns])
    missing = [F.when(is_null_marker(qcol(c), NULL_MARKERS), 1).otherwise(0) for c in texts.columns]
    distinct = texts.groupBy(*map(qcol, texts.columns)).agg(F.count(F.lit(1)).alias("_copies"))
    marked = distinct.select("_copies", F.array(*missing).alias("_missing"))
    cells = F.aggregate("_missing", F.lit(0), lambda total, cell: total + cell)
    rows = F.coalesce(F.sum("_copies"), F.lit(0))
    return marked.select("_copies", cells.alias("_cells")).agg(
        rows.alias("filas"),
        F.lit(len(sample.columns)).cast("bigint").alias("columnas"),
        (rows - F.count(F.lit(1))).alias("filas_duplicadas"),
        F.count(F.lit(1)).alias("filas_unicas"),
        F.coalesce(F.sum(F.col("_copies") * F.col("_cells")), F.lit(0)).alias("celdas_nulas"),
        F.coalesce(F.sum(F.when(F.col("_cells") > 0, F.col("_copies"))), F.lit(0)).alias("filas_con_nulo"),
    )


def missing_cells(sample: DataFrame) -> DataFrame:
    """Missing cells per column (columna, celdas_nulas); cells are compared as text. One scan."""
    counts = sample.agg(
        *[F.count_if(is_null_marker(qcol(c).cast("string"), NULL_MARKERS)).alias(f"_{i}") for i, c in enumerate(sample.columns)]
    )
    rows = [F.struct(F.lit(c).alias("columna"), F.col(f"_{i}").alias("celdas_nulas")) for i, c in enumerate(sample.columns)]
    return counts.select(F.inline(F.array(*rows)))


def quality_report(distribution: DataFrame, quality: DataFrame, missing: DataFrame, checks: DataFrame, label: str, method: str) -> DataFrame:
    """Distribution, validation and method of a sample as one record, made of small tables only."""

    def listed(df: DataFrame, name: str, order: str) -> Column:
        return df.agg(F.sort_array(F.collect_list(F.struct(order, *[c for c in df.columns if c != order]))).alias(name)).scalar()

    return quality.select(
        F.lit(method).alias("metodo"),
        *[qcol(c) for c in quality.columns],
        listed(distribution, "distribucion", label).alias("distribucion"),
        listed(missing, "nulos", "columna").alias("nulos"),
        listed(checks, "comprobaciones", "comprobacion").alias("comprobaciones"),
    )


def seeded_order(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in a reproducible pseudo-random order, with their position.

    For tables of one row per source file: the position is numbered in one partition.
    """
    mixed = df.withColumn("_hash", F.md5(F.concat_ws("|", F.lit(str(seed)), qcol(key))))
    order = Window.orderBy("_hash", qcol(key))
    return mixed.withColumn("posicion", F.row_number().over(order).cast("bigint")).drop("_hash").orderBy("posicion")
