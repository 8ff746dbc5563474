"""SimHash fingerprints of 128 bits and their search by permuted block tables, all in built-in functions.

Terms are pairs of neighbouring words (the word itself where there is one only), in lower case, weighing as
often as they occur. Each term's 128 hash bits vote; a fingerprint bit is set if more than half of the votes
are. Two 32-bit counters share a long, so 64 sums count all votes and nothing is exploded by bit.

Fingerprints within a Hamming radius r agree in at least b - r of b blocks: each choice of b - r blocks is a
table keyed by them, and a pair is confirmed in the first table it meets in.

Defined cases: a null or empty text, or one without words, has no votes and the fingerprint of zeros; equal
doc_ids come in the order of their texts; a null doc_id is the last of the order.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowops.llm.common import default_shuffles

BITS = 128
RADIUS = 3
BLOCKS = 4
_LANES = (1 << 32) | 1


def terms(text: Column) -> Column:
    """Hashes of the pairs of neighbouring words of a text, as an array."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(hashes) < 2, hashes).otherwise(
        F.zip_with(F.slice(hashes, F.lit(1), F.size(hashes) - 1), F.slice(hashes, F.lit(2), F.size(hashes) - 1), lambda a, b: F.xxhash64(a, b))
    )


def _votes(name: str, half: int) -> list[Column]:
    return [F.sum(F.shiftrightunsigned(name, i).bitwiseAND(F.lit(_LANES))).alias(f"v{half}_{i}") for i in range(32)]


def _bits(half: int) -> Column:
    """The 64 bits of one half from its 32 pairs of counters and the number of votes ``n``."""

    def of(i: int) -> list[Column]:
        pair = F.col(f"v{half}_{i}")
        low, high = pair.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(pair, 32)
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        return [
            F.when(2 * low > F.col("n"), F.shiftleft(one, i)).otherwise(none),
            F.when(2 * high > F.col("n"), F.shiftleft(one, i + 32)).otherwise(none),
        ]

    return F.coalesce(reduce(lambda a, b: a.bitwiseOR(b), [x for i in range(32) for x in of(i)]), F.lit(0).cast("long"))


def voted(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` with the halves f0 and f1 of the fingerprint of ``text``; keys name a row."""
    each = texts.select(*keys, F.explode_outer(terms(F.col("text"))).alias("h")).withColumn("g", F.xxhash64("h"))
    counted = each.withColumn("g", F.when(F.col("h").isNotNull(), F.col("g"))).groupBy(*keys)
    return counted.agg(F.count("h").alias("n"), *_votes("h", 0), *_votes("g", 1)).select(
        *keys, _bits(0).alias("f0"), _bits(1).alias("f1")
    )


def digits(f0: Column, f1: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f0), 16, "0"), F.lpad(F.hex(f1), 16, "0")))


def likeness(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Share of equal bits."""
    return 1 - (F.bit_count(a0.bitwiseXOR(b0)) + F.bit_count(a1.bitwiseXOR(b1))) / F.lit(BITS)


def near(fingerprints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(f0, f1, g0, g1, n): for each distinct query fingerprint all distinct fingerprints within ``radius``,
    with the number of rows that have them. Complete for every radius below ``blocks``."""
    if not radius < blocks or 32 % blocks:
        raise ValueError("the radius must be below the number of blocks, a divisor of 32")
    width = 32 // blocks
    tables = list(combinations(range(blocks), blocks - radius))

    def key(name: str, chosen: tuple[int, ...]) -> Column:
        return F.concat(*[F.substring(name, b * width + 1, width) for b in chosen])

    def dealt(df: DataFrame, name: str) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(t).alias("t"), key(name, chosen).alias("key")) for t, chosen in enumerate(tables)])
        return df.withColumn("e", F.explode(entries)).select("*", "e.t", "e.key").drop("e")

    asked = queries.select("f0", "f1").distinct().withColumn("f", digits(F.col("f0"), F.col("f1")))
    held = fingerprints.groupBy(F.col("f0").alias("g0"), F.col("f1").alias("g1")).agg(F.count("*").alias("n"))
    held = held.withColumn("g", digits(F.col("g0"), F.col("g1")))
    x, y = dealt(asked, "f"), dealt(held, "g").withColumnsRenamed({"t": "u", "key": "key_g"})
    apart = F.bit_count(F.col("f0").bitwiseXOR(F.col("g0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("g1")))
    first = F.coalesce(*[F.when(key("f", chosen) == key("g", chosen), F.lit(t)) for t, chosen in enumerate(tables)])
    met = (F.col("t") == F.col("u")) & (F.col("key") == F.col("key_g")) & (apart <= radius) & (first == F.col("t"))
    return x.join(y, met).select("f0", "f1", "g0", "g1", "n")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars and the text of the next document in falling doc_id, after the last the first.

    Documents are dealt by value into ranges between about evenly spaced doc_ids; a range's first document
    is sent to the range before it as well, so a range holds the successor of each of its documents.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    parts = 4 * default_shuffles(docs.sparkSession)
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 100 * parts).alias("at"), F.max("doc_id").alias("top")).first()
    bounds = sorted(set(found["at"] or []), reverse=True)
    above = F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<long>"), lambda b: b >= F.col("doc_id")))
    part = F.when(F.col("doc_id").isNull(), F.lit(len(bounds))).otherwise(above)
    top = F.col("doc_id").eqNullSafe(F.lit(found["top"]).cast("long"))

    def place(p: Column, extra: int) -> Column:
        return F.struct(p.cast("int").alias("part"), F.lit(extra).alias("extra"))

    places = F.array(
        place(part, 0),
        F.when(F.col("doc_id").isin(bounds), place(part - 1, 1)),
        F.when(top, place(F.lit(len(bounds)), 1)),
    )
    dealt = rows.select("*", F.explode(F.filter(places, lambda p: p.isNotNull())).alias("at")).select("doc_id", "text", "at.*")
    order = Window.partitionBy("part").orderBy("extra", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.withColumn("next", F.lead("text").over(order)).withColumn("place", F.row_number().over(order))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """For every row: doc_id, n_chars, digest of the edited text, both fingerprints, those of the next row.

    The edited text has its last half replaced by as much of the start of the next document.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    changed = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    pairs = with_next(docs).withColumn("edited", changed).select(
        "part",
        "place",
        "extra",
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.explode(
            F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))
        ).alias("of"),
    )
    keys = ["part", "place", "extra", "doc_id", "n_chars", "edited_sha256"]
    texts = pairs.select(*keys, "of.kind", "of.text").where("extra = 0 or kind = 0")
    halves = voted(texts, [*keys, "kind"])
    own = halves.groupBy(*keys).agg(
        *[F.max(F.when(F.col("kind") == kind, F.col(f))).alias(f"{f}_{kind}") for kind in (0, 1) for f in ("f0", "f1")]
    )
    order = Window.partitionBy("part").orderBy("place")
    following = own.withColumns({f"{f}_next": F.lead(f"{f}_0").over(order) for f in ("f0", "f1")})
    return following.where("extra = 0").drop("part", "place", "extra")
