"""Hierarchical weighted hash tree: rows go to shards by hash draws per level, with DataFrame expressions only.

A row descends region, rack and shard.  At each level every child draws
``-ln(u) / weight`` with ``u`` from the hash of (key, node); the lowest draw
wins, so a child gets rows in proportion to its weight.  A changed weight only
moves rows into or out of the subtrees whose weights changed.

``ShardTree.grow`` attaches one more shard as a region of its own.  All other
subtrees keep their weights, so rows move into the new shard alone.  (Attached
inside an existing region, the region's higher weight would also pull rows into
the new shard's siblings.)

The hash is MD5 so that any other engine can reproduce a placement.

Defined results: a null key is the empty key (all such rows share a shard but
not a slot); an empty table gives an empty result; identical rows get distinct
slots; other columns are passed through by ``assign``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ShardTree:
    """Shard weights by region and rack; shards are numbered in this order."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    @staticmethod
    def uniform(regions: int, racks: int, shards: int) -> ShardTree:
        return ShardTree((((1.0,) * shards,) * racks,) * regions)

    def grow(self, weight: float = 1.0) -> ShardTree:
        return ShardTree((*self.regions, ((weight,),)))

    @property
    def n_shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)


def _literal(values) -> Column:
    return F.array(*[_literal(v) for v in values]) if isinstance(values, (list, tuple)) else F.lit(values)


def _draw(weights: Column, node: Column) -> Column:
    """Index of the child of ``node`` with the lowest weighted draw (the first one of a tie)."""

    def drawn(w: Column, i: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(node, F.lit("/"), i.cast("string"))), 1, 13), 16, 10).cast("bigint")
        return F.struct((-F.ln((bits + F.lit(0.5)) / F.lit(float(2 ** 52))) / w).alias("d"), i.alias("i"))

    return F.array_min(F.transform(weights, drawn))["i"]


def _at(array: Column, i: Column) -> Column:
    return F.element_at(array, i + 1)


def shard_of(key: Column, tree: ShardTree) -> Column:
    """The shard number of a key: three draws on the way down the tree."""
    from tasteflow.llm.common import let

    regions = [float(sum(map(sum, region))) for region in tree.regions]
    racks = [[float(sum(rack)) for rack in region] for region in tree.regions]
    shards = [[[float(w) for w in rack] for rack in region] for region in tree.regions]
    first, n = [], 0
    for region in tree.regions:
        first.append([])
        for rack in region:
            first[-1].append(n)
            n += len(rack)
    key = F.coalesce(key.cast("string"), F.lit(""))

    def down(region: Column) -> Column:
        node = F.concat_ws("/", key, region.cast("string"))
        return let(_draw(_at(_literal(racks), region), node), lambda rack: _at(_at(_literal(first), region), rack)
                   + _draw(_at(_at(_literal(shards), region), rack), F.concat_ws("/", node, rack.cast("string"))))

    return let(_draw(_literal(regions), key), down).cast("int")


def assign(df: DataFrame, key: str, tree: ShardTree, name: str = "shard") -> DataFrame:
    """``df`` with the shard of each row's key."""
    return df.withColumn(name, shard_of(df[key], tree))


def slots(df: DataFrame, shard: str = "shard", name: str = "slot", pieces: int = 1024) -> DataFrame:
    """Number the rows of each shard from 0 without a gap, in a fixed order that follows from the rows' values.

    Identical rows are counted first (with map-side sums) and expanded last.
    Each shard is cut into ``pieces`` by a hash of the whole row; rows are
    numbered within their piece and moved by the sizes of the pieces before it.
    No task sees a whole shard; the table of sizes has shards x pieces rows.
    """
    columns = df.columns
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))
    counted = df.groupBy(*columns).agg(F.count("*").alias("__n")).withColumn(
        "__piece", F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % pieces)
    before = Window.partitionBy(shard).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.groupBy(shard, "__piece").agg(F.sum("__n").alias("__size")).select(
        F.col(shard).alias("__s"), F.col("__piece").alias("__p"),
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(shard, "__piece").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("__before", F.coalesce(F.sum("__n").over(within), F.lit(0)))
    return placed.join(starts, (F.col(shard).eqNullSafe(F.col("__s"))) & (F.col("__piece") == F.col("__p"))).select(
        *columns, F.explode(F.sequence(F.col("__start") + F.col("__before"),
                                       F.col("__start") + F.col("__before") + F.col("__n") - 1)).alias(name))
