"""The operators as named queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowops.llm import chat, embeddings, langid, lines, minhash, mixing, packing, resample, search, sharding, simhash, tokens, toxicity
from flowops.llm.common import stored, tuned


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    done = toxicity.scored(docs, model)
    return done.select(
        "row.doc_id",
        (toxicity.fold(F.col("row.doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    done = mixing.scheduled(docs)
    first = F.get("positions", F.lit(0)).alias("first_position")
    whole = done.select("row.doc_id", "size", "source_size", "target", "taken", first)
    return whole.orderBy("first_position", "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), tokens.token_count(F.col("text")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    segments = chat.formatted(given.unionByName(added))
    return chat.read_back(segments)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = stored(simhash.edited_fingerprints(docs), "fingerprints")
    own = done.select("doc_id", F.col("f0_0").alias("f0"), F.col("f1_0").alias("f1"))
    asked = own.where("doc_id % 20 = 0")
    counts = simhash.near(own, asked).groupBy(F.col("f0").alias("f0_0"), F.col("f1").alias("f1_0")).agg((F.sum("n") - 1).alias("n"))
    return done.join(counts, ["f0_0", "f1_0"], "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash.digits(F.col("f0_0"), F.col("f1_0")).alias("fingerprint"),
        simhash.digits(F.col("f0_1"), F.col("f1_1")).alias("edited_fingerprint"),
        simhash.likeness(*map(F.col, ("f0_0", "f1_0", "f0_1", "f1_1"))).alias("near_edited"),
        simhash.likeness(*map(F.col, ("f0_0", "f1_0", "f0_next", "f1_next"))).alias("near_next"),
        F.when(F.col("doc_id") % 20 == 0, F.col("n")).alias("n_near"),
    )


def op8_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_two_fit(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_embeddings(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op10_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    done = sharding.sharded(docs)
    grown = sharding.drawn(F.col("key"), sharding.layout(sharding.SHARDS + 1)).alias("grown_shard")
    return done.select("row.*", F.lit("key").alias("law"), "shard", F.col("slot").cast("long"), grown)


def op11_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.ranked(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = resample.resampled(docs, table(spark, sf_dir, "benchmark").select("text"))
    return done.select("doc_id", "n_features", "weight", "score", "rank")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    done = langid.identified(docs.select("doc_id", "text"), langid.fit(docs))
    held_out = F.coalesce(langid.fold(F.col("row.doc_id")) == 0, F.lit(False)).alias("held_out")
    return done.select("row.doc_id", held_out, "lang_pred", "score", "accepted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_dedup,
        op2_toxicity,
        op3_line_dedup,
        op4_curriculum_mix,
        op5_token_counts,
        op6_chat_format,
        op7_simhash,
        op8_best_two_fit,
        op9_embedding_dedup,
        op10_hash_tree_shards,
        op11_best_position_search,
        op12_importance_resampling,
        op13_language_id,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
