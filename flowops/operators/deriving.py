"""Derived variables, their profile, and label classification."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from flowops.functions.columns import band, first_positive, horizontal_sum, qcol
from flowops.spec import Spec

# Names and texts of the derived variables.
BANDS = ("bajo", "medio", "alto")
NO_PROTOCOL = "otro"
DEFINITIONS = {
    "size_kb": "Tot size / 1024 (kilobytes)",
    "rate_mbps": "Rate / 1 000 000 (paquetes por segundo)",
    "coef_variacion": "Std / AVG (dispersion del tamaño de paquete)",
    "total_flags": "Suma de los siete indicadores de flags TCP",
    "protocolo_principal": "Protocolo con valor 1 en las columnas one-hot",
    "rango_iat": "IAT clasificado con los percentiles 50 y 95: bajo, medio, alto",
}
TEXT_VARIABLES = ("protocolo_principal", "rango_iat")
PREVIEW_ROWS = 1000


def lookup(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join to a dimension; unknown keys get NULL. Catalyst broadcasts it when its size allows."""
    return df.join(dimension, key, "left")


def derived_columns(spec: Spec, iat_p50: Column, iat_p95: Column) -> Mapping[str, Column]:
    mean = qcol(spec.mean)
    return {
        "size_kb": qcol(spec.size) / F.lit(1024.0),
        "rate_mbps": qcol(spec.rate) / F.lit(1_000_000.0),
        "coef_variacion": F.when(mean > 0, qcol(spec.deviation) / mean),
        "total_flags": horizontal_sum(spec.flags),
        "protocolo_principal": first_positive(spec.onehot, NO_PROTOCOL),
        "rango_iat": band(qcol(spec.iat), iat_p50, iat_p95, BANDS),
    }


def with_derived(df: DataFrame, spec: Spec, iat_p50: Column, iat_p95: Column) -> DataFrame:
    return df.withColumns(dict(derived_columns(spec, iat_p50, iat_p95)))


def derived_profile(df: DataFrame, spec: Spec) -> DataFrame:
    """Nulls, range and mean of the numeric derived variables, distinct values of the text ones.

    One scan: the rows are first grouped by the text variables, whose few combinations then give
    the distinct counts without expanding the rows.
    """
    numeric = [c for c in DEFINITIONS if c not in TEXT_VARIABLES]
    partial = df.groupBy(*TEXT_VARIABLES).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"{c}_count") for c in numeric],
        *[F.sum(c).alias(f"{c}_sum") for c in numeric],
        *[F.min(c).alias(f"{c}_min") for c in numeric],
        *[F.max(c).alias(f"{c}_max") for c in numeric],
    )
    wide = partial.agg(
        F.sum("_rows").alias("_rows"),
        *[F.sum(f"{c}_count").alias(f"{c}_count") for c in numeric],
        *[F.sum(f"{c}_sum").alias(f"{c}_sum") for c in numeric],
        *[F.min(f"{c}_min").alias(f"{c}_min") for c in numeric],
        *[F.max(f"{c}_max").alias(f"{c}_max") for c in numeric],
        *[F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_rows"))), F.lit(0)).alias(f"{c}_nulls") for c in TEXT_VARIABLES],
        *[F.count_distinct(c).alias(f"{c}_distinct") for c in TEXT_VARIABLES],
    )
    nothing = F.lit(None).cast("double")
    rows = []
    for c, text in DEFINITIONS.items():
        is_text = c in TEXT_VARIABLES
        count = F.col(f"{c}_count") if not is_text else None
        rows.append(
            F.struct(
                F.lit(c).alias("columna"),
                F.lit("texto" if is_text else "decimal").alias("tipo"),
                (F.col(f"{c}_nulls") if is_text else F.col("_rows") - count).alias("nulos"),
                (nothing if is_text else F.col(f"{c}_min")).alias("minimo"),
                (nothing if is_text else F.col(f"{c}_max")).alias("maximo"),
                (nothing if is_text else F.when(count > 0, F.col(f"{c}_sum") / count)).alias("media"),
                (F.col(f"{c}_distinct") if is_text else F.lit(None).cast("bigint")).alias("distintos"),
                F.lit(text).alias("definicion"),
            )
        )
    rounded = {k: F.round(F.col(k), spec.decimals) for k in ("minimo", "maximo", "media")}
    return wide.select(F.inline(F.array(*rows))).withColumns(rounded)


def derived_preview(df: DataFrame, spec: Spec, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows, in a fixed order, of the source columns next to the derived ones."""
    names = [spec.label, spec.protocol, spec.rate, spec.size, spec.iat, *DEFINITIONS]
    chosen = df.select(*map(qcol, names))
    return chosen.orderBy(*map(qcol, names)).limit(rows)
