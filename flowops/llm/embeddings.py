"""Near-duplicate embeddings by cosine, with randomly rotated binary codes before exact computation.

1. Equal vectors are one class with a count; classes are dealt to blocks of about ``BLOCK`` vectors, stored
   with their binary codes: the signs of the rotated unit vector, and the correction factor, its inner
   product with the code.
2. For two blocks, code of one times rotated vector of the other over the factor is an unbiased estimate of
   the cosine. With D dimensions and factor f its error is within EPSILON * sqrt((1 - f*f) / f*f / (D - 1))
   but for a known small probability. Pairs whose upper bound is below the limit are done.
3. The others are computed anew in double precision; only that decides a link.
4. A pair of blocks returns sums of links per vector and a star forest of its linked vectors, never the
   pairs. Components of the forests are the components of the links.

Every block meets every other one, so work grows with the square of the different vectors, in blocks; the
codes make the inner loop cheap but do not change that.

Floats are kept as floats, all other numbers as doubles; vectors are brought near length 1 by a power of two,
which changes no cosine, so that neither large nor small components leave the range of doubles.

Defined cases: a null or zero vector and one with a null or non-finite component links with nothing;
vectors of other lengths are not compared; rows of equal vec_id are vectors of their own under one name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowops.llm.common import components, stored

LIMIT = 0.9
BLOCK = 4096
TILE = 512
EPSILON = 4.0
# Pairs computed anew at once.
EXACT = 1 << 15


def rotation(size: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def encoded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rotated unit vectors, their signs as bits, correction factors) of rows of doubles."""
    turned = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ rotation(vectors.shape[1])
    return turned, turned > 0, np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def error_bound(factor: np.ndarray, size: int, epsilon: float) -> np.ndarray:
    return epsilon * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(size - 1, 1))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows of doubles, each times the power of two that brings its largest component to 0.5..1."""
    wide = vectors.astype(np.float64)
    return np.ldexp(wide, -np.frexp(np.abs(wide).max(axis=1, keepdims=True))[1])


def _packed(table: pa.Table) -> pa.Table:
    """One block as a row: its ids, counts, vectors, codes and factors as bytes."""
    table = table.sort_by("id")
    size = table.column("size")[0].as_py()
    vectors = np.asarray(table.column("embedding").combine_chunks().flatten()).reshape(-1, size)
    _, bits, factor = encoded(_scaled(vectors))
    parts = [
        table.column("id").to_numpy().astype(np.int64),
        table.column("copies").to_numpy().astype(np.int64),
        vectors,
        np.packbits(bits, axis=1),
        factor,
    ]
    names = ["ids", "copies", "vectors", "codes", "factors"]
    return pa.table(
        {"size": pa.array([size], pa.int32()), "block": table.column("block").slice(0, 1)}
        | {n: pa.array([p.tobytes()], pa.binary()) for n, p in zip(names, parts)}
    )


class _Block:
    def __init__(self, size: int, ids: bytes, copies: bytes, vectors: bytes, codes: bytes, factors: bytes):
        self.ids, self.copies = np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64)
        kind = np.float32 if len(vectors) == 4 * size * len(self.ids) else np.float64
        self.vectors = _scaled(np.frombuffer(vectors, kind).reshape(-1, size))
        self.bits = np.unpackbits(np.frombuffer(codes, np.uint8).reshape(len(self.ids), -1), axis=1, count=size)
        self.factors = np.frombuffer(factors, np.float64)
        self.norms = np.linalg.norm(self.vectors, axis=1)

    def turned(self) -> np.ndarray:
        return ((self.vectors / self.norms[:, None]) @ rotation(self.vectors.shape[1])).astype(np.float32)


def _doubtful(x: _Block, y: np.ndarray, rows: slice, limit: float, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of x, row of y) of the pairs whose upper confidence bound reaches the limit."""
    size = y.shape[1]
    signs = x.bits[rows].astype(np.float32) * 2 - 1
    # The estimate is the product over sqrt(D) * f; the comparison is made on the product itself.
    least = (limit - error_bound(x.factors[rows], size, epsilon)) * np.sqrt(size) * x.factors[rows] - 1e-4
    a, b = np.nonzero(signs @ y.T >= least.astype(np.float32)[:, None])
    return a + rows.start, b


def _forest(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable label for every vertex, from labels so far and new links."""
    while True:
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        for at in (labels[a], labels[b], a, b):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def _compared(x: _Block, y: _Block, same: bool, limit: float, epsilon: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, links found, id of the smallest vector reached) for the vectors of two blocks."""
    order = np.argsort(np.concatenate([x.ids, y.ids]), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    of_x, of_y = (place[: len(x.ids)],) * 2 if same else (place[: len(x.ids)], place[len(x.ids) :])
    links, labels, turned = np.zeros(len(order), np.int64), np.arange(len(order)), y.turned()
    for start in range(0, len(x.ids), TILE):
        a, b = _doubtful(x, turned, slice(start, min(start + TILE, len(x.ids))), limit, epsilon)
        if same:
            a, b = a[a < b], b[a < b]
        linked = np.zeros(len(a), bool)
        for at in range(0, len(a), EXACT):
            i, j = a[at : at + EXACT], b[at : at + EXACT]
            products = np.einsum("ij,ij->i", x.vectors[i], y.vectors[j])
            linked[at : at + EXACT] = products / (x.norms[i] * y.norms[j]) >= limit
        a, b = a[linked], b[linked]
        np.add.at(links, of_x[a], y.copies[b])
        np.add.at(links, of_y[b], x.copies[a])
        labels = _forest(labels, of_x[a], of_y[b])
    ids = np.concatenate([x.ids, y.ids])[order]
    met = np.flatnonzero(links)
    return ids[met], links[met], ids[labels[met]]


def block_links(blocks: DataFrame, limit: float = LIMIT, epsilon: float = EPSILON) -> DataFrame:
    """(id, links, low) per vector and pair of blocks in which it has links."""
    keys = blocks.select("size", "block", "blocks")
    fields = ["ids", "copies", "vectors", "codes", "factors"]
    pairs = keys.select("size", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))

    def side(name: str) -> DataFrame:
        return blocks.select("size", F.col("block").alias(name), F.struct(*fields).alias(f"of_{name}"))

    joined = pairs.join(side("j"), ["size", "j"]).join(side("i"), ["size", "i"]).select("size", "i", "j", "of_i", "of_j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                size, i, j, left, right = (batch.column(c)[k].as_py() for c in range(5))
                x = _Block(size, **left)
                y = x if i == j else _Block(size, **right)
                columns = _compared(x, y, i == j, limit, epsilon)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "links", "low"])

    return joined.mapInArrow(run, "id long, links long, low long")


def near_embeddings(vectors: DataFrame, limit: float = LIMIT, block: int = BLOCK, epsilon: float = EPSILON) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of (vec_id, embedding)."""
    sound = F.coalesce(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    keyed = rows.withColumns(
        {
            "sound": sound & F.col("vec_id").isNotNull(),
            "size": F.size("embedding"),
            "k1": F.xxhash64("embedding"),
            "k2": F.xxhash64(F.lit(1), F.col("embedding")),
        }
    )
    classes = stored(
        keyed.where("sound")
        .groupBy("size", "k1", "k2")
        .agg(F.min("vec_id").alias("low_id"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding"))
        # Different vectors may have one vec_id, so a class has a number of its own.
        .withColumn("id", F.monotonically_increasing_id()),
        "vector-classes",
    )
    sizes = classes.groupBy("size").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = classes.join(sizes, "size").withColumn("block", F.pmod(F.xxhash64("k1", "k2"), F.col("blocks")).cast("int"))
    schema = "size int, block int, ids binary, copies binary, vectors binary, codes binary, factors binary"
    packs = dealt.select("size", "block", "id", "copies", "embedding").groupBy("size", "block").applyInArrow(_packed, schema)
    blocks = stored(packs, "vector-blocks").join(sizes, "size")

    found = stored(block_links(blocks, limit, epsilon), "vector-links")
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    lowest = groups.join(classes.select("id", "low_id"), "id").groupBy("component").agg(F.min("low_id").alias("component_id"))
    named = groups.join(lowest, "component").select("id", "component_id")
    of_class = (
        classes.select("size", "k1", "k2", "id", "low_id", "copies")
        .join(sums, "id", "left")
        .join(named, "id", "left")
        .select(
            "size",
            "k1",
            "k2",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "low_id").alias("component_id"),
        )
    )
    return (
        keyed.select("vec_id", "sound", "size", "k1", "k2")
        .join(of_class, ["size", "k1", "k2"], "left")
        .select(
            "vec_id",
            F.when(F.col("sound"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
