"""A training corpus from raw documents: five operators, each stage written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowops.llm import lines, minhash, mixing, packing, toxicity
from flowops.llm.common import stored, tuned

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the models call toxic go."""
    labels = tuned(spark).read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    return toxicity.scored(docs, model).where("score < 0.5").select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines stay in one document only; texts and their lengths change with them.

    A text that loses no line keeps its value, null included.
    """
    tuned(spark)
    done = lines.line_dedup(docs)
    lost = F.col("n_dropped") > 0
    changed = {
        "text": F.when(lost, F.col("kept")).otherwise(F.col("row.text")),
        "n_chars": F.when(lost, F.length("kept")).otherwise(F.col("row.n_chars")),
    }
    kinds = dict(docs.dtypes)
    return done.select(*[changed[c].cast(kinds[c]).alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest doc_id.

    A document without words is like no other; rows of a doc_id stay or go together, those of a null one stay.
    """
    tuned(spark)
    gone = minhash.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def mixed_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and in the order in which the curriculum uses them.

    A document without words takes nothing of its source's target and is used once or twice if what comes before
    it lies below the target; sources without any word are left out.
    """
    return mixing.mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids, sequence and offset.

    A document that the mix takes twice gives its pieces twice, told apart by ``use`` (from 0); null and empty
    texts are a piece of the end token alone.
    """
    tuned(spark)
    return packing.best_two_fit(docs, with_ids=True, with_uses=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("minhash_dedup", without_near_duplicates),
    ("curriculum_mix", mixed_by_source),
    ("best_two_fit", packed_sequences),
]

# Models and tokenisers have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tuned(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
