"""Sharding by a hierarchical weighted hash tree.

A tree has regions, regions have racks, racks have shards, and every node has a weight. A
row descends level by level: each child draws an exponential variate from the hash of the
row's key and the child's path, divided by the child's weight, and the smallest draw wins. A
child is chosen in proportion to its weight, and since the draws of a child depend on nothing
but the key and its own path, a changed weight moves rows only into or out of the subtrees
whose weights changed; the order within every other subtree stays.

Defined results: a NULL key is a key like any other; equal keys meet in one shard, whatever
their texts; an empty table gives an empty one; a child of weight 0 receives nothing. Input
columns called region, rack or shard are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delivery_marts.llm.shared import bucket

# region -> rack -> shard number -> weight
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]

LEVELS = ("region", "rack", "shard")
# Buckets per shard in which slots are numbered; each holds an even part of a shard.
SLOT_BUCKETS = 2048


def even_tree(shards: int, racks: int = 4, regions: int = 2) -> Tree:
    """Shards of weight 1 dealt to racks, racks dealt to regions."""
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(shards):
        rack = shard % racks
        region = tree.setdefault(f"region{rack % regions}", {})
        region.setdefault(f"rack{rack}", {})[shard] = 1.0
    return tree


def grown_tree(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region and a rack of its own.

    The new region is the only subtree whose weight changes, so rows move into the new shard
    and nowhere else. (Put into an old rack, a shard would raise the weights of its rack and
    region, and rows would enter its siblings as well.)
    """
    return {**tree, f"region-of-{shard}": {f"rack-of-{shard}": {shard: weight}}}


def _weight(node: float | Mapping) -> float:
    return node if isinstance(node, (int, float)) else sum(_weight(child) for child in node.values())


def _draw(key: Column, path: str, weight: float, seed: int) -> Column:
    """An exponential variate of rate ``weight``: -ln(u)/weight, u uniform in (0, 1)."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(path), key), 11)
    return -F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def _choose(key: Column, children: Mapping, path: str, seed: int) -> Column:
    """The name of the child with the smallest draw."""
    drawn = [
        F.struct(_draw(key, f"{path}/{name}", _weight(child), seed).alias("draw"), F.lit(name).alias("name"))
        for name, child in children.items()
        if _weight(child) > 0
    ]
    return F.array_min(F.array(*drawn))["name"] if drawn else F.lit(None)


def _by_name(column: str, options: Mapping[str, Column]) -> Column:
    chosen = F.lit(None)
    for name, option in options.items():
        chosen = F.when(F.col(column) == name, option).otherwise(chosen)
    return chosen


def with_shard(df: DataFrame, key: str, tree: Tree, seed: int = 0) -> DataFrame:
    """The rows with the region, rack and shard of their key; no shuffle."""
    k = F.col(key)
    racks = {region: _choose(k, below, f"/{region}", seed) for region, below in tree.items()}
    shards = {
        rack: _choose(k, leaves, f"/{region}/{rack}", seed)
        for region, below in tree.items()
        for rack, leaves in below.items()
    }
    return (
        df.withColumn("region", _choose(k, tree, "", seed))
        .withColumn("rack", _by_name("region", racks))
        .withColumn("shard", _by_name("rack", shards).cast("int"))
    )


def with_slot(df: DataFrame, order: Sequence[str], buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Rows numbered from 0 without a gap within their shard.

    A shard holds a fixed part of all rows, so it is not numbered in one task: rows are spread
    over buckets by the hash of ``order`` (which should tell rows apart), counted per bucket,
    and numbered inside their bucket after the rows of the buckets before. The table of counts
    has shards times buckets rows, whatever the input.
    """
    spread = df.withColumn("_bucket", bucket(buckets, *order))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spread.groupBy("shard", "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("shard", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("shard", "_bucket").orderBy(*order)
    return (
        spread.withColumn("_place", F.row_number().over(within))
        .join(F.broadcast(offsets), ["shard", "_bucket"])
        .withColumn("slot", F.col("_offset") + F.col("_place") - 1)
        .drop("_bucket", "_place", "_offset")
    )


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside their files."""
    df.repartition("shard", bucket(8, "slot")).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
