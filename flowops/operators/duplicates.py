"""Duplicate rows: by whole row, by key columns, and by raw text.

Wide rows are counted by digest first: 64 bits of each row are grouped, and only rows whose digest may repeat
are grouped by all their columns. A row of another digest than all others differs from all others, so the
counts are exact, whatever the digests of the rest. Rows of few columns are grouped as they are, raw text in one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flowops.functions.columns import pct, qcol
from flowops.session import written

TOP_GROUPS = 10
# Columns from which a row is wide: fewer are hardly larger than a digest, and one scan does.
WIDE = 8
# Bits that mark repeated digests, 64 to a row of the table every task gets: 262,144 rows at most. With many more
# repeated digests than bits, rows that do not repeat are grouped by all their columns too, with the same result.
MARKS = 1 << 24
# Between the fields of a line of raw text: the unit separator, which few texts hold.
SEPARATOR = "\x1f"


def _copies(df: DataFrame, columns: Sequence[str], name: str = "_copies") -> DataFrame:
    """Distinct rows with their number of copies; copies collapse before the shuffle."""
    return df.groupBy(*map(qcol, columns)).agg(F.count(F.lit(1)).alias(name))


def _mark(digest: Column) -> tuple[Column, Column]:
    """Row of the mark table and bit in it."""
    place = F.pmod(digest, F.lit(MARKS))
    return F.shiftright(place, 6), (place % 64).cast("int")


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """One record: rows, distinct, and the sum of each of ``sums`` over all rows (0 for none).

    Two scans. The first shuffles a digest, its count and the sums; equal rows have equal digests, as hashing
    treats zeros and NaN as grouping does. The second shuffles the rows whose digest is marked as repeated.
    """
    names, sums = list(columns or df.columns), dict(sums or {})
    cells = [qcol(c) for c in names]
    hashed = df.select(
        F.xxhash64(*cells).alias("_d"), *[c.cast("bigint").alias(f"_s{i}") for i, c in enumerate(sums.values())]
    )
    added = [F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))]
    word, bit = _mark(F.col("_d"))
    one = F.when(F.col("_k") > 1, F.expr("shiftleft(1L, _bit)")).otherwise(F.lit(0).cast("bigint"))
    marks = written(
        hashed.groupBy("_d")
        .agg(F.count(F.lit(1)).alias("_k"), *added)
        .select("*", word.alias("_word"), bit.alias("_bit"))
        .groupBy("_word")
        .agg(F.sum("_k").alias("_k"), F.bit_or(one).alias("_bits"), *added),
        "digests",
    )
    # At most MARKS / 64 rows, whatever the input.
    repeated = F.broadcast(marks.where("_bits <> 0").select("_word", "_bits"))
    placed = df.select(*cells, F.xxhash64(*cells).alias("_d")).select(*cells, word.alias("_word"), bit.alias("_bit"))
    candidates = placed.join(repeated, "_word").where(F.getbit("_bits", "_bit") == 1)
    full = _copies(candidates, names).agg(
        F.struct(F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("kinds")).alias("f")
    )
    totals = marks.agg(
        F.coalesce(F.sum("_k"), F.lit(0)).alias("rows"),
        *[F.coalesce(F.sum(f"_s{i}"), F.lit(0)).alias(n) for i, n in enumerate(sums)],
    )
    alone = F.col("rows") - F.col("_f.rows")
    return totals.withColumn("_f", full.scalar()).select("rows", (alone + F.col("_f.kinds")).alias("distinct"), *sums)


def dedup_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows before and after removing repeated rows."""
    names = list(columns or df.columns)
    if len(names) < WIDE:
        rows = F.coalesce(F.sum("_copies"), F.lit(0))
        counts = _copies(df, names).agg(rows.alias("antes"), F.count(F.lit(1)).alias("despues"))
    else:
        counts = distinct_rows(df, names).select(F.col("rows").alias("antes"), F.col("distinct").alias("despues"))
    removed = F.col("antes") - F.col("despues")
    return counts.select(
        "antes",
        "despues",
        removed.alias("eliminados"),
        pct(removed, F.col("antes")).alias("reduccion_pct"),
    )


def text_dedup_report(texts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As ``dedup_report`` on raw text: ``1.10`` and ``1.1`` differ, a missing field equals an empty one.

    One scan, grouped by the fields as one line: to parse text again costs more than whole rows in the shuffle, and
    one key of any width compiles where dozens of columns do not. A line takes less of the shuffle than an array of its
    fields and tells them apart as long as none of them holds the separator; where one does, the array joins the key.
    """
    fields = [F.coalesce(qcol(c), F.lit("")) for c in columns]
    line = F.concat_ws(SEPARATOR, *fields)
    keys = [line.alias("_line")]
    if len(fields) > 1:
        unclear = F.octet_length(F.substring_index(line, SEPARATOR, len(fields))) < F.octet_length(line)
        keys.append(F.when(unclear, F.array(*fields)).alias("_fields"))
    return dedup_report(texts.select(*keys))


def dedup_criteria_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Whole-row and key-only duplicates: rows by digest, keys from a scan of the key columns."""
    keys = _copies(df, key).agg(F.count(F.lit(1)).alias("k"))
    counts = distinct_rows(df).select(
        F.col("rows").alias("_before"), F.col("distinct").alias("_full"), keys.scalar().alias("_keys")
    )
    before = F.col("_before")

    def row(criterion: str, names: str, after: str):
        left = F.col(after)
        return F.struct(
            F.lit(criterion).alias("criterio"),
            F.lit(names).alias("columnas_clave"),
            before.alias("filas_antes"),
            left.alias("filas_despues"),
            (before - left).alias("duplicados_eliminados"),
            pct(before - left, before).alias("pct_duplicados"),
        )

    return counts.select(
        F.inline(
            F.array(
                row("filas_completas", f"las {len(df.columns)} columnas", "_full"),
                row("columnas_clave", ", ".join(key), "_keys"),
            )
        )
    )


def most_repeated(df: DataFrame, key: Sequence[str], rows: int = TOP_GROUPS) -> DataFrame:
    """The most frequent keys; ties in key order."""
    return (
        _copies(df, key, "apariciones")
        .select("apariciones", *map(qcol, key))
        .orderBy(F.desc("apariciones"), *[qcol(c).asc() for c in key])
        .limit(rows)
    )
