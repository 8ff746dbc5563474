"""Validation of a whole table and profiles of its columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowops.functions.columns import is_finite, is_infinite, pct, qcol
from flowops.operators.duplicates import distinct_rows
from flowops.operators.percentiles import Wanted, group_summary
from flowops.spec import Spec


def type_name(dtype: T.DataType) -> str:
    """Three names for all types: entero, decimal, texto."""
    if isinstance(dtype, T.IntegralType):
        return "entero"
    return "decimal" if isinstance(dtype, T.NumericType) else "texto"


def _add(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def validation(df: DataFrame, spec: Spec) -> DataFrame:
    """Rows, columns, NULL cells, infinite cells and repeated rows in one record; rows are counted by digest."""
    nulls = _add([F.when(qcol(c).isNull(), 1).otherwise(0) for c in spec.columns])
    infinite = _add([F.when(is_infinite(qcol(c)), 1).otherwise(0) for c in spec.floats])
    counts = distinct_rows(df, spec.columns, {"nulos": nulls, "infinitos": infinite})
    return counts.select(
        F.col("rows").alias("registros"),
        F.lit(len(spec.columns)).cast("bigint").alias("columnas"),
        "nulos",
        "infinitos",
        (F.col("rows") - F.col("distinct")).alias("duplicados"),
    )


def column_profile(df: DataFrame, spec: Spec) -> DataFrame:
    """Per column: type, invalid cells, exact distinct values (chosen columns), range of valid values.

    Cells of the columns with a distinct count are turned into (column, value) pairs and counted by them; what else
    is said of these columns follows from the values and their counts. A value repeated millions of times collapses
    before the shuffle. The other columns take one aggregation without keys, in a scan of their own.
    A missing value counts as one distinct value, an infinity as an ordinary one.
    """
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    whole, number, text = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string")

    def typed(c: str) -> tuple[Column, Column, Column]:
        if type_name(dtypes[c]) == "texto":
            return whole, number, qcol(c).cast("string")
        return (whole, qcol(c), text) if c in spec.floats else (qcol(c).cast("bigint"), number, text)

    def present(w: Column, n: Column, t: Column) -> Column:
        return w.isNotNull() | is_finite(n) | t.isNotNull()

    def said(w: Column, n: Column, t: Column, rows: Column) -> list[Column]:
        """Rows, invalid cells and ranges from cells that stand for ``rows`` each."""
        finite = F.when(is_finite(n), n)
        return [
            F.sum(rows).alias("_rows"), F.sum(F.when(~present(w, n, t), rows).otherwise(0)).alias("_invalid"), F.min(w).alias("_min_whole"),
            F.max(w).alias("_max_whole"), F.min(finite).alias("_min_number"), F.max(finite).alias("_max_number"),
        ]

    counted = [i for i, c in enumerate(spec.columns) if c in spec.distinct]
    plain = [i for i in range(len(spec.columns)) if i not in counted]
    found = []
    if counted:
        names = ("_kw", "_kn", "_kt")
        cells = [F.struct(F.lit(i).alias("_i"), *[v.alias(n) for v, n in zip(typed(spec.columns[i]), names)]) for i in counted]
        per_value = df.select(F.inline(F.array(*cells))).groupBy("_i", *names).agg(F.count(F.lit(1)).alias("_n"))
        found.append(per_value.groupBy("_i").agg(*said(*map(F.col, names), F.col("_n")), F.count(F.lit(1)).alias("_values")))
    if plain:
        one = F.lit(1).cast("bigint")
        wide = df.agg(*[F.struct(*said(*typed(spec.columns[i]), one)).alias(f"_{i}") for i in plain])
        rows = [F.struct(F.lit(i).alias("_i"), F.col(f"_{i}").alias("_c")) for i in plain]
        found.append(wide.select(F.inline(F.array(*rows))).select("_i", "_c.*", F.lit(None).cast("bigint").alias("_values")).where("_rows > 0"))
    per_column = reduce(DataFrame.unionByName, found)
    names = F.array(*[F.lit(c) for c in spec.columns])
    kinds = F.array(*[F.lit(type_name(dtypes[c])) for c in spec.columns])
    return per_column.orderBy("_i").select(
        names[F.col("_i")].alias("columna"),
        kinds[F.col("_i")].alias("tipo"),
        F.col("_invalid").alias("celdas_no_validas"),
        pct(F.col("_invalid"), F.col("_rows")).alias("pct_no_validas"),
        F.when(F.col("_i").isin(counted), F.col("_values")).alias("distintos"),
        F.coalesce(F.col("_min_number"), F.col("_min_whole").cast("double")).alias("minimo_valido"),
        F.coalesce(F.col("_max_number"), F.col("_max_whole").cast("double")).alias("maximo_valido"),
    )


# Names of the seven metrics.
METRICS = ("conteo", "suma", "media", "mediana", "minimo", "maximo", "desviacion_estandar")


def global_metrics(
    df: DataFrame, columns: tuple[str, ...], decimals: int = 6
) -> DataFrame:
    """Seven metrics per column in long form (columna, metrica, valor)."""
    aggregates, medians = [], {}
    for i, c in enumerate(columns):
        v = qcol(c).cast("double")
        aggregates += [
            F.count(v).cast("double").alias(f"{i}_conteo"),
            F.sum(v).alias(f"{i}_suma"),
            F.avg(v).alias(f"{i}_media"),
            F.min(v).alias(f"{i}_minimo"),
            F.max(v).alias(f"{i}_maximo"),
            F.stddev_samp(v).alias(f"{i}_desviacion_estandar"),
        ]
        medians[f"{i}_mediana"] = Wanted(c, 0.5)
    wide = group_summary(df, [], aggregates, medians)
    rows = [
        F.struct(
            F.lit(c).alias("columna"),
            F.lit(m).alias("metrica"),
            F.round(F.col(f"{i}_{m}"), decimals).alias("valor"),
        )
        for i, c in enumerate(columns)
        for m in METRICS
    ]
    return wide.select(F.inline(F.array(*rows)))
