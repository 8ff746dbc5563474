"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At every level a row draws an exponential number for each child from a hash of its key and the child's
path, divided by the child's weight (the weights below it); the smallest draw wins. Raising one child's
weight moves rows into that child only, so movement stays in subtrees whose weights change. A new shard
arrives as a region of its own: rows then move nowhere but into it.

Defined cases: a null text has no bytes and the checksum of the empty text; a null doc_id has the key of
an empty string; rows of equal doc_id share a shard and get slots of their own. Extra columns are carried
along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowops.llm.common import cell_of, packed, running

SHARDS = 8
REGIONS = 2
RACKS = 2
# Draws are made of 13 hex digits of a digest, exactly held by a double.
_DIGITS = 13

Tree = dict[str, dict[str, dict[int, float]]]


def layout(shards: int, base: int = SHARDS, regions: int = REGIONS, racks: int = RACKS) -> Tree:
    """The tree for a shard count: the first ``base`` shards over regions and racks, each later one alone."""
    tree: Tree = {}
    for shard in range(shards):
        if shard < base:
            per_region = -(-base // regions)
            per_rack = -(-per_region // racks)
            region, rack = shard // per_region, shard % per_region // per_rack
        else:
            region, rack = regions + shard - base, 0
        tree.setdefault(f"g{region}", {}).setdefault(f"k{rack}", {})[shard] = 1.0
    return tree


def _children(tree: Tree) -> dict[str, list[tuple[str, float]]]:
    nodes: dict[str, list[tuple[str, float]]] = {"": []}
    for region, racks in tree.items():
        nodes[""].append((f"/{region}", sum(sum(r.values()) for r in racks.values())))
        nodes[f"/{region}"] = [(f"/{region}/{rack}", sum(s.values())) for rack, s in racks.items()]
        for rack, shards in racks.items():
            nodes[f"/{region}/{rack}"] = [(f"/{region}/{rack}/{n}", w) for n, w in shards.items()]
    return {path: [c for c in found if c[1] > 0] for path, found in nodes.items()}


def drawn(key: Column, tree: Tree) -> Column:
    """Shard number of a string key: three weighted draws down the tree, all in built-in functions."""
    nodes = _children(tree)
    table = F.create_map(
        *[
            x
            for path, found in nodes.items()
            for x in (F.lit(path), F.array(*[F.struct(F.lit(p).alias("path"), F.lit(float(w)).alias("weight")) for p, w in found]))
        ]
    )

    def draw(child: Column) -> Column:
        digits = F.substring(F.md5(F.concat(key, child["path"])), 1, _DIGITS)
        uniform = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16**_DIGITS))
        return F.struct((-F.ln(uniform) / child["weight"]).alias("draw"), child["path"].alias("path"))

    path = F.lit("")
    for _ in range(3):
        path = F.array_min(F.transform(F.element_at(table, path), draw))["path"]
    return F.element_at(F.split(path, "/"), -1).cast("int")


def sharded(docs: DataFrame, shards: int = SHARDS, tree: Tree | None = None) -> DataFrame:
    """``row``, ``key``, ``shard`` and ``slot``, the gapless place of the row within its shard."""
    key = F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))
    rows = packed(docs).withColumn("key", key)
    order = F.md5(F.col("key"))
    placed = rows.withColumn("shard", drawn(F.col("key"), tree or layout(shards))).withColumn("cell", cell_of(order))
    return running(placed, ["shard"], [F.col("key")], F.lit(1), "slot").drop("cell")
