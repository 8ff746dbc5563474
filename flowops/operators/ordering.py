"""Secondary and total sorts of derived records, and a check that an output really is ordered."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from flowops.functions.columns import is_finite, qcol
from flowops.spec import Spec

KEY_WIDTH = 10
PAYLOAD_WIDTH = 90


def sort_pairs(df: DataFrame, spec: Spec) -> DataFrame:
    """(protocol, rate) integer pairs of the rows with a finite rate; halves round to even."""
    return df.where(is_finite(qcol(spec.rate))).select(
        qcol(spec.protocol).cast("int").alias("protocol"),
        F.rint(qcol(spec.rate)).cast("int").alias("rate"),
    )


def fixed_width_records(df: DataFrame, spec: Spec) -> DataFrame:
    """A zero-padded 10-character key and a 90-character payload, cut or padded with spaces."""
    number = F.rint(qcol(spec.rate)).cast("int")
    # Padding a text is far cheaper than a format, which only a sign needs.
    key = F.when(number >= 0, F.lpad(number.cast("string"), KEY_WIDTH, "0")).otherwise(F.format_string(f"%0{KEY_WIDTH}d", number))
    payload = F.concat_ws("|", qcol(spec.label), qcol(spec.protocol).cast("string"))
    return df.where(is_finite(qcol(spec.rate))).select(
        key.alias("key"),
        F.rpad(F.substring(payload, 1, PAYLOAD_WIDTH), PAYLOAD_WIDTH, " ").alias("payload"),
    )


def sort_records(df: DataFrame, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Total order by ``by``, then by the remaining columns, in range partitions.

    A row number behind the columns is part of the range key, so the copies of one record, even a third
    of the table, span partitions and no task or row holds them together.
    """
    order = [*by, *[c for c in df.columns if c not in by]]
    keys = [*[qcol(c) for c in order], F.col("_row")]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).select(*[qcol(c) for c in df.columns])


def secondary_sort(pairs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Groups in order of protocol, rates ascending inside each; a large group spans partitions."""
    return sort_records(pairs, ["protocol", "rate"], partitions)


def total_sort(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """Records in order of their key."""
    return sort_records(records, ["key"], partitions)


def order_check(df: DataFrame, by: Sequence[str], place: Sequence[str] = ()) -> DataFrame:
    """Rows, descents inside parts and descents between consecutive parts.

    The rows stream past once where they lie, one summary row per part leaves the tasks. A part is a
    partition, or with ``place`` (file and start of a split) what was read from there, in that order.
    Columns: filas, descensos_internos, descensos_entre_partes, ordenado.
    """
    names = list(by)
    keyed = df.select(*[qcol(c) for c in place], *[qcol(c) for c in names])
    fields = {f.name: f.dataType.simpleString() for f in keyed.schema.fields}
    ends = ", ".join(f"{side}{i} {fields[c]}" for side in ("f", "l") for i, c in enumerate(names))
    where = "".join(f"p{i} {fields[c]}, " for i, c in enumerate(place))
    schema = f"part int, {where}n bigint, descents bigint, {ends}"

    parts = keyed.mapInArrow(_summariser(len(place)), schema)
    first = F.struct(*[F.col(f"f{i}") for i in range(len(names))])
    last = F.struct(*[F.col(f"l{i}") for i in range(len(names))])
    previous = F.lag(last).over(Window.orderBy(*([f"p{i}" for i in range(len(place))] or ["part"])))
    between = parts.withColumn("crossed", F.when(previous > first, 1).otherwise(0))
    totals = between.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("filas"),
        F.coalesce(F.sum("descents"), F.lit(0)).alias("descensos_internos"),
        F.coalesce(F.sum("crossed"), F.lit(0)).cast("bigint").alias("descensos_entre_partes"),
    )
    return totals.withColumn(
        "ordenado", (F.col("descensos_internos") == 0) & (F.col("descensos_entre_partes") == 0)
    )


def _summariser(places: int):
    """The per-partition function, self-contained so that workers need not have this package."""

    def descents(batch: pa.RecordBatch) -> int:
        n = batch.num_rows - 1
        if n < 1:
            return 0
        down = pa.array([False] * n)
        same = pa.array([True] * n)
        for column in batch.columns:
            here, there = column.slice(0, n), column.slice(1, n)
            down = pc.or_(down, pc.and_(same, pc.less(there, here)))
            same = pc.and_(same, pc.equal(there, here))
        return pc.sum(down).as_py() or 0

    def row(batch: pa.RecordBatch, at: int) -> tuple:
        return tuple(column[at].as_py() for column in batch.columns)

    def segments(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Runs of rows read from one place."""
        cuts = {0, batch.num_rows}
        for column in batch.columns[:places]:
            changed = pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1))
            cuts |= {i + 1 for i in pc.indices_nonzero(changed).to_pylist()}
        ordered = sorted(cuts)
        for start, stop in zip(ordered, ordered[1:]):
            yield batch.slice(start, stop - start)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = first = last = types = None
        rows = down = 0

        def summary() -> pa.RecordBatch:
            where, keys = types[:places], types[places:]
            kinds = [pa.int32(), *where, pa.int64(), pa.int64(), *keys, *keys]
            cells = [TaskContext.get().partitionId(), *place, rows, down, *first, *last]
            names = ["part", *[f"p{i}" for i in range(places)], "n", "descents"]
            names += [f"{side}{i}" for side in ("f", "l") for i in range(len(keys))]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names)

        for whole in batches:
            for part in segments(whole) if whole.num_rows else ():
                here, batch = row(part, 0)[:places], part.select(range(places, part.num_columns))
                if rows and here != place:
                    yield summary()
                    first = last = None
                    rows = down = 0
                place, types = here, part.schema.types
                head = row(batch, 0)
                down += descents(batch) + (last is not None and head < last)
                first = head if first is None else first
                last = row(batch, batch.num_rows - 1)
                rows += batch.num_rows
        if rows:
            yield summary()

    return summarise
