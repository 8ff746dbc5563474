"""Cleaning: rounding on ingest, invalid cells, rows with invalid cells, missing-value markers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from flowops.functions.columns import (
    is_finite, is_null_marker, is_valid, null_non_finite, qcol, round_decimals,
)
from flowops.spec import Spec

# Spellings of a missing cell in raw text.
NULL_MARKERS = ("", "NA", "N/A", "NULL", "null", "NaN", "nan")


def round_floats(df: DataFrame, spec: Spec) -> DataFrame:
    """Every float column rounded to the decimals of the contract."""
    floats = set(spec.floats)
    return df.select(
        *[
            round_decimals(qcol(c), spec.decimals).alias(c) if c in floats else qcol(c)
            for c in df.columns
        ]
    )


def nullify(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN and infinities become NULL in the named columns; rows stay."""
    chosen = set(columns)
    return df.select(
        *[null_non_finite(qcol(c)).alias(c) if c in chosen else qcol(c) for c in df.columns]
    )


def _all_valid(spec: Spec):
    magnitudes = [F.abs(qcol(c)) for c in spec.floats]
    present = reduce(lambda a, b: a & b, [qcol(c).isNotNull() for c in spec.columns])
    return present & (F.greatest(F.lit(0.0), *magnitudes) < F.lit(float("inf")))


def clean_rows(df: DataFrame, spec: Spec) -> DataFrame:
    """Rows whose cells are all valid.

    Two predicates over all columns rather than one per column, which keeps planning short. NaN
    orders above infinity, so the largest magnitude tells whether every float is finite.
    """
    return df.where(_all_valid(spec))


def clean_and_round(df: DataFrame, spec: Spec) -> DataFrame:
    """Clean rows with rounded floats.

    Rounding never changes whether a cell is valid, so rows are filtered on the raw cells first;
    then Catalyst rounds only the columns a later step really reads.
    """
    return round_floats(clean_rows(df, spec), spec)


KEPT = "_kept"


def with_kept(df: DataFrame, spec: Spec) -> DataFrame:
    """Every row with a flag whether the cleaning rule keeps it, which is then worked out once a row."""
    return df.withColumn(KEPT, _all_valid(spec))


def clean_counts(spec: Spec) -> list:
    """Aggregates over ``with_kept`` that the report of a cleaning is made of.

    What is left afterwards is counted on the rows that the cleaning rule keeps.
    """
    kept = F.col(KEPT)
    marks = [F.when(is_valid(c, spec.floats), 0).otherwise(1) for c in spec.columns]
    finite = is_finite(qcol(spec.rate)) if spec.rate in spec.columns else F.lit(True)
    return [
        F.count_if(~kept).alias("_removed"),
        *[F.sum(mark).alias(f"_{i}") for i, mark in enumerate(marks)],
        *[F.sum(F.when(kept, mark).otherwise(0)).alias(f"_left_{i}") for i, mark in enumerate(marks)],
        F.count_if(finite).alias("_finite"),
        F.count_if(~finite).alias("_rejected"),
    ]


def clean_report(df: DataFrame, spec: Spec) -> DataFrame:
    """Per affected column: invalid cells before and after, and rows removed. One scan."""
    return clean_summary(with_kept(df, spec).agg(*clean_counts(spec)), spec)


def clean_summary(counts: DataFrame, spec: Spec) -> DataFrame:
    """The same from one record of ``clean_counts``, however it was come by."""
    rows = [
        F.struct(
            F.lit(c).alias("columna"),
            F.col(f"_{i}").alias("valores_no_validos_antes"),
            F.col(f"_left_{i}").alias("valores_no_validos_despues"),
            F.col("_removed").alias("filas_eliminadas"),
        )
        for i, c in enumerate(spec.columns)
    ]
    return counts.select(F.inline(F.array(*rows))).where(F.col("valores_no_validos_antes") > 0)


def finite_summary(counts: DataFrame) -> DataFrame:
    """Rows with a finite rate and rows rejected, from the same record."""
    return counts.select(F.col("_finite").alias("validas"), F.col("_rejected").alias("rechazadas"))


def finite_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows with a finite value and rows rejected."""
    finite = is_finite(qcol(column))
    return df.agg(
        F.count_if(finite).alias("validas"), F.count_if(~finite).alias("rechazadas")
    )


def null_marker_report(
    texts: DataFrame, columns: Sequence[str], markers: Sequence[str] = NULL_MARKERS
) -> DataFrame:
    """Missing cells per column of an all-text table, and rows with at least one. One scan."""
    missing = [is_null_marker(qcol(c), markers) for c in columns]
    wide = texts.agg(
        F.count_if(reduce(lambda a, b: a | b, missing)).alias("_rows"),
        *[F.count_if(m).alias(f"{i}_cells") for i, m in enumerate(missing)],
    )
    rows = [
        F.struct(F.lit(c).alias("columna"), F.col(f"{i}_cells").alias("celdas_nulas"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)), F.col("_rows").alias("filas_con_nulo"))
