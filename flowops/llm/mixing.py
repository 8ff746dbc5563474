"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight that changes linearly over training time 0..1. Its integral decides the source's
share of the tokens, its running integral says how much of that share is due at a time; the position of a
document is the time at which the demand for its source reaches the tokens that come before it.

Defined cases: a null or empty text has size 0; a null source is a source of its own, last in order; rows of
equal doc_id are separate rows with equal rank; without any word every target is 0 and nothing is taken.
Extra columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowops.llm.common import WORD, cell_of, packed, running

# Weight at the start and at the end of training, dealt to the sources by code point again and again.
# Their integrals are 5, 2 and 1.
SCHEDULES = ((2.5, 7.5), (2.0, 2.0), (1.5, 0.5))
SHARE = 1.5
REPEATS = 2
SEED = "mix"


def _dealt(values: Sequence[float], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (index % len(values) + 1).cast("int"))


def targets(
    sizes: DataFrame, schedules: Sequence[tuple[float, float]] = SCHEDULES, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """(source, source_size, target, lean) from one row (source, source_size) per source.

    A target stops at ``repeats`` times the source's size, what is over goes to the others by weight: in
    order of size over weight, a source is full if sharing the rest among it and all later ones would
    exceed its limit. ``lean`` is the relative slope of the schedule. Windows see one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("n", F.row_number().over(order) - 1).select(
        "source",
        "source_size",
        _dealt([(a + b) / 2 for a, b in schedules], F.col("n")).alias("weight"),
        _dealt([(b - a) / (b + a) for a, b in schedules], F.col("n")).alias("lean"),
        "n",
    )
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), "n").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.col("total") - repeats * F.col("full")) / (F.col("weights") - F.col("spent"))
    shared = (
        weighed.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("weights", F.sum("weight").over(Window.partitionBy()))
        .withColumn("full", F.coalesce(F.sum("source_size").over(filled), F.lit(0)))
        .withColumn("spent", F.coalesce(F.sum("weight").over(filled), F.lit(0.0)))
        .withColumn("level", level)
        .withColumn("open", F.when(F.col("level") * F.col("weight") < repeats * F.col("source_size"), F.col("level")))
    )
    # The level of the first source that is not full holds for all after it.
    least = F.min(F.when(F.col("open").isNotNull(), F.struct((F.col("source_size") / F.col("weight")).alias("r"), "n", "open"))).over(
        Window.partitionBy()
    )
    whole = (repeats * F.col("source_size")).cast("double")
    return shared.withColumn("rest", least["open"]).select(
        "source",
        "source_size",
        F.coalesce(F.least(whole, F.col("rest") * F.col("weight")), whole).alias("target"),
        "lean",
    )


def scheduled(docs: DataFrame, schedules=SCHEDULES, share: float = SHARE, repeats: int = REPEATS, seed: str = SEED) -> DataFrame:
    """``row`` (the whole input row), size, source_size, target, taken and ``positions`` of its uses in 0..1.

    Within a source documents come in the order of a digest of seed and doc_id. A use of a document counts
    if its middle lies below the target, so a source misses its target by half a document at most.
    """
    rank = F.md5(F.concat_ws(":", F.lit(seed), F.col("row.doc_id").cast("string")))
    rows = packed(docs).select(
        "row",
        F.col("row.source").alias("source"),
        F.coalesce(F.regexp_count(F.col("row.text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        rank.alias("rank"),
        cell_of(rank).alias("cell"),
    )
    ran = running(rows, ["source"], [F.col("rank"), F.col("size")], F.col("size"), "before")
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), schedules, share, repeats)
    goals = goals.withColumnRenamed("source", "_of")
    return ran.join(goals, ran["source"].eqNullSafe(goals["_of"])).select(
        "row", "size", "source_size", "target", *_uses(repeats)
    )


def _uses(repeats: int) -> list[Column]:
    def start(n: Column) -> Column:
        return F.col("before") + n * F.col("source_size")

    def taken(n: Column) -> Column:
        return start(n) + F.col("size") / 2 < F.col("target")

    def position(n: Column) -> Column:
        f, a = start(n) / F.col("target"), F.col("lean")
        return 2 * f / ((1 - a) + F.sqrt((1 - a) * (1 - a) + 4 * a * f))

    uses = F.filter(F.sequence(F.lit(0), F.lit(repeats - 1)), taken)
    return [(F.size(uses) * F.col("size")).cast("long").alias("taken"), F.transform(uses, position).alias("positions")]


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row per use of a document with the columns of ``docs``, range-sorted by position."""
    uses = scheduled(docs, **options).select("row", F.explode("positions").alias("position"))
    return uses.orderBy("position", F.col("row.doc_id")).select("row.*")
