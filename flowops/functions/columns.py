"""Scalar column expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

INFINITY = float("inf")

# Above this magnitude neighbouring doubles lie further apart than 1e-6.
ROUNDING_LIMIT = 9.0e9


def qcol(name: str) -> Column:
    """Column by exact name; names may contain spaces and dots."""
    return F.col(f"`{name}`")


def is_infinite(c: Column) -> Column:
    return F.abs(c) == F.lit(INFINITY)


def is_finite(c: Column) -> Column:
    """True or False, never NULL: a NULL, NaN or infinite value is not finite.

    Spark orders NaN above infinity, so one comparison rejects both.
    """
    return F.coalesce(F.abs(c) < F.lit(INFINITY), F.lit(False))


def is_valid(name: str, floats: Iterable[str]) -> Column:
    """A float is valid when finite, any other cell when not NULL."""
    return is_finite(qcol(name)) if name in set(floats) else qcol(name).isNotNull()


def null_non_finite(c: Column) -> Column:
    return F.when(is_finite(c), c)


def round_decimals(c: Column, decimals: int = 6) -> Column:
    """Round half-even on the scaled double, the rule of NumPy; NULL, NaN and infinities pass through.

    ``F.round`` goes through a decimal object per value; ``rint`` is one machine instruction, and
    these columns are rounded for every row of the table.
    """
    scale = float(10**decimals)
    limit = ROUNDING_LIMIT * 1e6 / scale
    return F.when(F.abs(c) < F.lit(limit), F.rint(c * F.lit(scale)) / F.lit(scale)).otherwise(c)


def pct(part: Column, total: Column, decimals: int | None = 6) -> Column:
    """Percentage of a total; 0.0 when the total is zero or missing."""
    share = F.when(total != 0, part / total * F.lit(100.0)).otherwise(F.lit(0.0))
    return share if decimals is None else F.round(share, decimals)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient; 0.0 when the denominator is zero or missing."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def to_mb(size: Column) -> Column:
    return size / F.lit(1024.0 * 1024.0)


def traffic_type(label: Column, benign: str) -> Column:
    """Two classes; a NULL label counts as Malicious."""
    return F.when(label == benign, F.lit("Benign")).otherwise(F.lit("Malicious"))


def horizontal_sum(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [qcol(n) for n in names])


def first_positive(names: Sequence[str], default: str) -> Column:
    """Name of the first column, in the given order, that is above zero."""
    return F.coalesce(*[F.when(qcol(n) > 0, F.lit(n)) for n in names], F.lit(default))


def band(c: Column, low: Column, high: Column, names: tuple[str, str, str]) -> Column:
    """Three classes with inclusive upper bounds; NULL and NaN fall in the last one."""
    return (
        F.when(c <= low, F.lit(names[0])).when(c <= high, F.lit(names[1])).otherwise(F.lit(names[2]))
    )


def decimal_text(c: Column, decimals: int = 6) -> Column:
    """Fixed decimals without trailing zeros but at least one; empty for NULL, NaN and infinities."""
    fixed = F.format_string(f"%.{decimals}f", c.cast("double"))
    trimmed = F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")
    return F.when(is_finite(c.cast("double")), trimmed).otherwise(F.lit(""))


def is_null_marker(c: Column, markers: Sequence[str]) -> Column:
    """Whether a text cell is one of the spellings of a missing value; NULL counts as empty."""
    return F.trim(F.coalesce(c, F.lit("")), F.lit(" \t\n\r\f\v")).isin(list(markers))
