"""Comparing result tables, set differences, expectations and pivots of records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from flowops.functions.columns import is_finite, qcol

# Tolerances of a numeric comparison.
ABSOLUTE = 1e-6
RELATIVE = 1e-9


def _close(a: Column, b: Column, absolute: float, relative: float) -> Column:
    """Finite numbers within tolerance; otherwise only the same infinity, or both NaN."""
    limit = F.greatest(F.lit(absolute), F.lit(relative) * F.greatest(F.abs(a), F.abs(b)))
    return (a == b) | (is_finite(a) & is_finite(b) & (F.abs(a - b) <= limit))


def same_value(
    a: Column, b: Column, absolute: float = ABSOLUTE, relative: float = RELATIVE
) -> Column:
    """Equal texts, or texts that are both numbers within tolerance; a missing cell equals an empty one."""
    left, right = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    x, y = left.try_cast("double"), right.try_cast("double")
    return (left == right) | F.coalesce(_close(x, y, absolute, relative), F.lit(False))


def header_difference(expected: DataFrame, actual: DataFrame) -> list[str]:
    """Columns present on one side only, or in another order; empty when the headers agree."""
    if expected.columns == actual.columns:
        return []
    odd = sorted(set(expected.columns) ^ set(actual.columns))
    return odd or list(actual.columns)


def reconcile(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    absolute: float = ABSOLUTE,
    relative: float = RELATIVE,
) -> DataFrame:
    """Cells that differ beyond tolerance, and missing and extra rows.

    Columns: the keys, columna, esperado, actual, estado. Both tables are stacked, so NULL keys match. Rows of
    equal keys are compared as multisets: rows equal in every cell cancel, map side first, and what is left of
    a key is paired by rank over all cells, numbers by value. Rows without a partner are missing or extra.
    """
    odd = header_difference(expected, actual)
    if odd:
        raise ValueError(f"the headers differ: {odd}")
    cells = [c for c in expected.columns if c not in keys]

    def side(df: DataFrame, tag: int) -> DataFrame:
        return df.select(
            *[qcol(k) for k in keys],
            F.lit(tag).alias("_side"),
            F.array(*[F.coalesce(qcol(c).cast("string"), F.lit("")) for c in cells]).cast("array<string>").alias("_cells"),
        )

    def of(tag: int) -> Column:
        return F.first(F.when(F.col("_side") == tag, F.col("_cells")), ignorenulls=True)

    surplus = F.col("_a") - F.col("_b")
    left = (
        side(expected, 0)
        .unionByName(side(actual, 1))
        .groupBy(*[qcol(k) for k in keys], "_cells")
        .agg(F.count_if(F.col("_side") == 0).alias("_a"), F.count_if(F.col("_side") == 1).alias("_b"))
        .where(surplus != 0)
        .select(
            *[qcol(k) for k in keys],
            F.when(surplus > 0, 0).otherwise(1).alias("_side"),
            "_cells",
            F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs(surplus))).alias("_copy"),
        )
    )
    by_value = F.transform("_cells", lambda c: F.struct(c.try_cast("double").alias("n"), c.alias("t")))
    rank = Window.partitionBy(*[qcol(k) for k in keys], F.col("_side")).orderBy(by_value, "_copy")
    paired = (
        left.withColumn("_rank", F.row_number().over(rank))
        .groupBy(*[qcol(k) for k in keys], "_rank")
        .agg(
            F.count_if(F.col("_side") == 0).alias("_a"),
            F.count_if(F.col("_side") == 1).alias("_b"),
            of(0).alias("_x"),
            of(1).alias("_y"),
        )
    )
    nothing = F.lit(None).cast("string")

    def problem(test: Column, column: Column, a: Column, b: Column, state: str) -> Column:
        return F.when(
            test,
            F.struct(
                column.alias("columna"), a.alias("esperado"), b.alias("actual"),
                F.lit(state).alias("estado"),
            ),
        )

    a, b = F.col("_a"), F.col("_b")
    found = [
        problem(b == 0, nothing, nothing, nothing, "falta"),
        problem(a == 0, nothing, nothing, nothing, "sobra"),
        *[
            problem(
                (a == 1) & (b == 1) & ~same_value(F.col("_x")[i], F.col("_y")[i], absolute, relative),
                F.lit(c), F.col("_x")[i], F.col("_y")[i], "distinta",
            )
            for i, c in enumerate(cells)
        ],
    ]
    return paired.select(*[qcol(k) for k in keys], F.inline(F.array_compact(F.array(*found))))


def reconcile_summaries(
    expected: DataFrame, actual: DataFrame, ignore: Sequence[str] = (), key: str = "clave", value: str = "valor"
) -> DataFrame:
    """Differing values of the keys both summaries share, leaving out keys that describe the run."""
    shared = [
        t.where(~qcol(key).isin(list(ignore))) if ignore else t for t in (expected, actual)
    ]
    found = reconcile(shared[0], shared[1], [key])
    return found.where(F.col("estado") == "distinta").select(qcol(key), "esperado", "actual")


def set_difference(expected: DataFrame, actual: DataFrame, column: str) -> DataFrame:
    """Values on one side only (columna value, lado): ``falta`` or ``sobra``. One shuffle."""
    both = expected.select(qcol(column), F.lit(0).alias("_side")).unionByName(
        actual.select(qcol(column), F.lit(1).alias("_side"))
    )
    sides = both.groupBy(qcol(column)).agg(F.min("_side").alias("_a"), F.max("_side").alias("_b"))
    return sides.where(F.col("_a") == F.col("_b")).select(
        qcol(column), F.when(F.col("_a") == 0, F.lit("falta")).otherwise(F.lit("sobra")).alias("lado")
    )


def expectations(wide: DataFrame, expected: Mapping[str, object], fail_fast: bool = False) -> DataFrame:
    """A one-row table of observed numbers against expected ones: comprobacion, esperado, actual, ok."""
    rows = [
        F.struct(
            F.lit(name).alias("comprobacion"),
            _as_column(want).cast("double").alias("esperado"),
            qcol(name).cast("double").alias("actual"),
            F.coalesce(_as_column(want).cast("double") == qcol(name).cast("double"), F.lit(False)).alias("ok"),
        )
        for name, want in expected.items()
    ]
    checked = wide.select(F.inline(F.array(*rows)))
    if not fail_fast:
        return checked
    message = F.concat(F.lit("expectation failed: "), F.col("comprobacion"))
    return checked.withColumn("ok", F.when(F.col("ok"), True).otherwise(F.raise_error(message).cast("boolean")))


def _as_column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def pivot_with_total(
    df: DataFrame, row: str, column: str, values: Sequence[str], measure: Column, total: str
) -> DataFrame:
    """One row per ``row`` and one column per value, plus a row of column totals.

    The values are given, so no extra job looks for them.
    """
    table = df.groupBy(qcol(row)).pivot(column, list(values)).agg(measure)
    kinds = {f.name: f.dataType for f in table.schema.fields}

    def summed(c: str) -> Column:
        if isinstance(kinds[c], T.FractionalType):
            return F.round(F.sum(qcol(c)), 3).alias(c)
        return F.sum(qcol(c)).alias(c)

    bottom = table.agg(*[summed(v) for v in values]).select(F.lit(total).alias(row), *map(qcol, values))
    return table.unionByName(bottom)
