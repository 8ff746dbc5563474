"""Exact percentiles by selection: one plan for every input size and any number of groups, in two scans.

1. Values are counted by cells of a logarithmic scale (256 to an octave), with the smallest and largest
   value of each cell. Running counts over the cells of a group, a few thousand rows, name the cell that
   holds a rank, which brackets it from both sides. Brackets of a column that overlap become one interval.
2. Intervals are written as a table of their own and joined to the values on the group: Catalyst sees the
   size of that table, so it is broadcast below the session's threshold and shuffled beyond it. Values inside
   an interval are counted once, however many percentiles ask for it, so that map-side aggregation reduces
   a hot value before the shuffle. An interval is cut into 4,096 even cells; running counts name the ones
   that hold a rank and only their values are ordered.

A cell is a monotone function of the value, so every count is exact and no bracket can miss.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowops.functions.columns import qcol
from flowops.session import written

# The percents of the threshold table.
THRESHOLD_PERCENTS = (50, 75, 90, 95, 99)

PER_OCTAVE = 256
CELLS = 4096
# Beyond the exponents of doubles, so that infinities have a cell of their own.
EXPONENT = 1100


@dataclass(frozen=True)
class Wanted:
    """One percentile: ``linear`` interpolates between neighbours, otherwise nearest rank."""

    column: str
    fraction: float
    linear: bool = True


def median(column: str) -> Wanted:
    return Wanted(column, 0.5)


def nearest_rank(column: str, fraction: float) -> Wanted:
    return Wanted(column, fraction, linear=False)


def group_summary(
    df: DataFrame, by: Sequence[str], aggregates: Sequence[Column], percentiles: Mapping[str, Wanted]
) -> DataFrame:
    """Ordinary aggregates and exact percentiles, one row per group (one row when ``by`` is empty)."""
    plain = df.groupBy(*map(qcol, by)).agg(*aggregates)
    # Stacking and regrouping joins on NULL keys and on no key at all, without a join.
    stacked = plain.unionByName(_found(df, by, percentiles), allowMissingColumns=True)
    rest = [F.first(qcol(c), ignorenulls=True).alias(c) for c in plain.columns if c not in by]
    return _folded(stacked, by, rest, percentiles)


def select_percentiles(df: DataFrame, by: Sequence[str], percentiles: Mapping[str, Wanted]) -> DataFrame:
    """Exact percentiles by selection; one row per group that has any value."""
    return _folded(_found(df, by, percentiles), by, [], percentiles)


def _found(df: DataFrame, by: Sequence[str], percentiles: Mapping[str, Wanted]) -> DataFrame:
    """(by, _alias, _position, _at, _v): values around the positions asked for, with the rows up to each."""
    columns = sorted({w.column for w in percentiles.values()})
    cells = [F.struct(F.lit(i).alias("_c"), _number(c).alias("_v")) for i, c in enumerate(columns)]
    values = df.select(*map(qcol, by), F.inline(F.array(*cells))).where("_v IS NOT NULL")
    intervals = written(_intervals(values, by, columns, percentiles), "intervals")
    return _located(values, by, intervals)


def _folded(found: DataFrame, by: Sequence[str], rest: Sequence[Column], percentiles: Mapping[str, Wanted]) -> DataFrame:
    """The first values at or beyond the neighbours of each position, interpolated between them."""
    at, value, position = F.col("_at"), F.col("_v"), F.col("_position")
    ends, results = [], []
    for i, (name, wanted) in enumerate(percentiles.items()):
        own = F.col("_alias") == i
        ends.append(F.min(F.when(own & (at > F.floor(position)), value)).alias(f"_from_{i}"))
        low = F.col(f"_from_{i}")
        if not wanted.linear:
            results.append(low.alias(name))
            continue
        ends.append(F.min(F.when(own & (at > F.ceil(position)), value)).alias(f"_to_{i}"))
        ends.append(F.max(F.when(own, position - F.floor(position))).alias(f"_part_{i}"))
        high, part = F.col(f"_to_{i}"), F.col(f"_part_{i}")
        between = low * (F.lit(1.0) - part) + high * part
        results.append(F.when(low == high, low).otherwise(between).alias(name))
    folded = found.groupBy(*map(qcol, by)).agg(*rest, *ends)
    kept = [c for c in folded.columns if not any(c == f"_{e}_{i}" for e in ("from", "to", "part") for i in range(len(percentiles)))]
    return folded.select(*map(qcol, kept), *results)


def _number(column: str) -> Column:
    """The value as a double; NaN is no value."""
    return F.nanvl(qcol(column).cast("double"), F.lit(None).cast("double"))


def _cell(value: Column) -> Column:
    exponent = F.least(F.greatest(F.log2(F.abs(value)), F.lit(-float(EXPONENT))), F.lit(float(EXPONENT)))
    size = F.floor((exponent + F.lit(EXPONENT + 1.0)) * PER_OCTAVE).cast("int")
    return F.when(value > 0, size).when(value < 0, -size).otherwise(0)


def _position(wanted: Wanted) -> Column:
    n, fraction = F.col("_n"), F.lit(float(wanted.fraction))
    if wanted.linear:
        return (n - 1) * fraction
    return (F.greatest(F.ceil(fraction * n), F.lit(1)) - 1).cast("double")


def _holds(before: Column, upto: Column, position: Column) -> Column:
    """Whether rows ``before`` to ``upto`` have a neighbour of a position."""
    first, last = F.floor(position), F.ceil(position)
    return ((before <= first) & (first < upto)) | ((before <= last) & (last < upto))


def _intervals(values: DataFrame, by: Sequence[str], columns: Sequence[str], percentiles: Mapping[str, Wanted]) -> DataFrame:
    """Disjoint intervals of values per group and column: (_id, _low, _high, _below, _asked).

    ``_below`` is the number of rows under the interval, ``_asked`` the percentiles that lie in it with their
    positions.
    """
    keys = [*map(qcol, by), F.col("_c")]
    counted = values.groupBy(*keys, _cell(F.col("_v")).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_k"), F.min("_v").alias("_from"), F.max("_v").alias("_to")
    )
    group = Window.partitionBy(*keys)
    running = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = counted.withColumns({"_n": F.sum("_k").over(group), "_upto": F.sum("_k").over(running)})
    asked = F.array(*[
        F.struct(F.lit(columns.index(w.column)).alias("_of"), F.lit(i).alias("_alias"), _position(w).alias("_position"))
        for i, w in enumerate(percentiles.values())
    ])
    before = F.col("_upto") - F.col("_k")
    brackets = (
        ran.select("*", F.inline(asked))
        .where((F.col("_of") == F.col("_c")) & _holds(before, F.col("_upto"), F.col("_position")))
        .groupBy(*keys, "_alias")
        .agg(
            F.max("_position").alias("_position"),
            F.min("_from").alias("_low"),
            F.max("_to").alias("_high"),
            F.min(before).alias("_below"),
        )
    )
    # An interval begins where a bracket lies above all those before it.
    in_order = group.orderBy("_low", "_high", "_alias")
    reach = F.max("_high").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("_low") <= F.col("_reach"), 0).otherwise(1)
    numbered = brackets.withColumn("_reach", reach).withColumn(
        "_id", F.sum(begins).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return numbered.groupBy(*keys, "_id").agg(
        F.min("_low").alias("_low"),
        F.max("_high").alias("_high"),
        F.min("_below").alias("_below"),
        F.collect_list(F.struct("_alias", "_position")).alias("_asked"),
    )


def _located(values: DataFrame, by: Sequence[str], intervals: DataFrame) -> DataFrame:
    """(by, _v, _at, _alias, _position): the values of the cells that hold a position, with the rows up to each."""
    group = [*by, "_c"]
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    width = F.col("_high") - F.col("_low")
    even = F.floor((F.col("_v") - F.col("_low")) / width * F.lit(float(CELLS))).cast("int")
    cell = F.when((width > 0) & (width < float("inf")), even).otherwise(0)
    interval = [*map(qcol, group), F.col("_id")]
    counted = (
        _null_safe(values, intervals.drop("_below", "_asked"), group, inside)
        .groupBy(*interval, cell.alias("_cell"), "_v")
        .agg(F.count(F.lit(1)).alias("_k"))
    )
    running = Window.partitionBy(*interval).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = counted.groupBy(*interval, "_cell").agg(F.sum("_k").alias("_n"))
    before, upto = F.col("_below") + F.col("_upto") - F.col("_n"), F.col("_below") + F.col("_upto")
    own = F.filter("_asked", lambda a: _holds(before, upto, a["_position"]))
    ran = sums.select("*", F.sum("_n").over(running).alias("_upto"))
    holding = (
        _null_safe(ran, intervals.drop("_low", "_high"), [*group, "_id"])
        .select(*interval, "_cell", before.alias("_before"), own.alias("_asked"))
        .where(F.size("_asked") > 0)
    )
    within = Window.partitionBy(*interval, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.col("_before") + F.sum("_k").over(within)
    return (
        _null_safe(counted, holding, [*group, "_id", "_cell"])
        .select(*map(qcol, by), "_v", "_asked", at.alias("_at"))
        .select(*map(qcol, by), "_v", "_at", F.inline("_asked"))
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], test: Column | None = None) -> DataFrame:
    l, r = left.alias("l"), right.alias("r")
    test = F.lit(True) if test is None else test
    for k in keys:
        test = test & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    extra = [c for c in right.columns if c not in keys]
    return l.join(r, test).select("l.*", *[F.col(f"r.`{c}`") for c in extra])


class Limits:
    """Nearest-rank thresholds of several columns in a one-row frame, infinities included.

    ``at`` gives one of them as a scalar subquery: it is evaluated inside the plan that uses it, with
    only the percentiles that plan needs, and never collected. An empty column gives 0.0.
    """

    def __init__(
        self, wide: DataFrame, columns: Sequence[str], percents: Sequence[int] = THRESHOLD_PERCENTS
    ):
        self.wide, self._columns, self._percents = wide, list(columns), tuple(percents)

    @classmethod
    def of(
        cls,
        df: DataFrame,
        columns: Sequence[str],
        percents: Sequence[int] = THRESHOLD_PERCENTS,
    ) -> Limits:
        aggregates, wanted = [], {}
        for i, c in enumerate(columns):
            value = qcol(c)
            aggregates += [
                F.count(value).alias(f"{i}_conteo"),
                F.count_if(value.isNull()).alias(f"{i}_nulos"),
                F.min(value).alias(f"{i}_min"),
                F.max(value).alias(f"{i}_max"),
                F.avg(value).alias(f"{i}_media"),
            ]
            wanted.update({f"{i}_p{p}": nearest_rank(c, p / 100.0) for p in percents})
        return cls(group_summary(df, [], aggregates, wanted), columns, percents)

    @classmethod
    def from_table(cls, table: DataFrame) -> Limits:
        """From rows such as ``table`` gives, for thresholds kept in a file."""
        percents = [int(c[1:]) for c in table.columns if c.startswith("p")]
        numbers = [c for c in table.columns if c != "columna"]
        columns = [r["columna"] for r in table.select("columna").collect()]
        wide = table.agg(
            *[
                F.max(F.when(F.col("columna") == name, F.col(c))).alias(f"{i}_{c}")
                for i, name in enumerate(columns)
                for c in numbers
            ]
        )
        return cls(wide, columns, percents)

    def at(self, column: str, percent: int) -> Column:
        cell = F.coalesce(F.col(f"{self._columns.index(column)}_p{percent}"), F.lit(0.0))
        return self.wide.select(cell.alias("limit")).scalar()

    def table(self) -> DataFrame:
        """Columns: columna, conteo, nulos, min, max, media, p<percent>..."""
        zero = F.lit(0.0)
        reals = ["min", "max", "media", *[f"p{p}" for p in self._percents]]
        rows = [
            F.struct(
                F.lit(c).alias("columna"),
                F.col(f"{i}_conteo").alias("conteo"),
                F.col(f"{i}_nulos").alias("nulos"),
                *[F.coalesce(F.col(f"{i}_{r}"), zero).alias(r) for r in reals],
            )
            for i, c in enumerate(self._columns)
        ]
        return self.wide.select(F.inline(F.array(*rows)))
