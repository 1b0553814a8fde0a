"""Sharding by a hierarchical weighted hash tree.

A document descends from the root over regions and racks to a shard. At every node each child draws
``-ln(u) / weight`` with u from a hash of the doc_id and the child's name, and the smallest draw wins. A
child is therefore chosen in proportion to its weight, and when the weight of one child changes, its
siblings' draws stay as they were: documents only enter or leave the subtree whose weight changed.

A new shard is hung up at the root as a region of its own, so it is the only subtree whose weight
changes, and documents move into it and nowhere else.

Documents are numbered in each shard without gaps, in order of doc_id, by a range shuffle and the counts
of its pieces; no task sorts a whole shard.

Defined cases: a null text has size 8 and the checksum of the empty text; null doc_ids are hashed
alike and come first in their shard; repeated rows go to one shard, with a slot each; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import only, partitions
from lakemart.session import stored

# region -> rack -> shard -> weight
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]

SHARDS = 24
RACK_SHARDS = 4
REGION_RACKS = 2
OVERHEAD = 8  # bytes a document takes beside its text


def base_tree(shards: int = SHARDS) -> dict[str, dict[str, dict[int, float]]]:
    """Shards of weight one, ``RACK_SHARDS`` to a rack and ``REGION_RACKS`` racks to a region."""
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(shards):
        rack = shard // RACK_SHARDS
        tree.setdefault(f"region{rack // REGION_RACKS}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    return tree


def with_shard(tree: Tree, shard: int, weight: float = 1.0) -> dict:
    """``tree`` and one more shard in a region of its own."""
    return {**tree, f"region-of-{shard}": {f"rack-of-{shard}": {shard: weight}}}


def with_weight(tree: Tree, shard: int, weight: float) -> dict:
    """``tree`` with another weight for one shard. Its rack and region change in weight with it."""
    return {
        region: {rack: {s: weight if s == shard else w for s, w in held.items()} for rack, held in racks.items()}
        for region, racks in tree.items()
    }


def tree_of(count: int, base: int = SHARDS) -> dict:
    """The tree of so many shards: those beyond ``base`` were added one by one."""
    tree: dict = base_tree(min(count, base))
    for shard in range(base, count):
        tree = with_shard(tree, shard)
    return tree


def _draw(doc_id: Column, child: str, weight: float) -> Column:
    word = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(child)), 11)
    return -F.log((word + 0.5) / float(1 << 53)) / weight


def _choose(doc_id: Column, children: Mapping[str, tuple[float, Column]]) -> Column:
    """What the child with the smallest draw leads to."""
    if len(children) == 1:
        return next(iter(children.values()))[1]
    draws = [_draw(doc_id, name, weight) for name, (weight, _) in children.items() if weight > 0]
    places = [place for weight, place in children.values() if weight > 0]
    least = F.array_min(F.array(*draws))
    chosen = F.array_position(F.array(*draws), least)
    out = places[-1]
    for n in range(len(places) - 1, 0, -1):
        out = F.when(chosen == n, places[n - 1]).otherwise(out)
    return out


def shard_of(doc_id: Column, tree: Tree) -> Column:
    """The shard at the end of a document's way through the tree."""
    regions = {}
    for region, racks in tree.items():
        inner = {}
        for rack, held in racks.items():
            leaves = {f"{rack}/{shard}": (weight, F.lit(shard)) for shard, weight in held.items()}
            inner[rack] = (sum(held.values()), _choose(doc_id, leaves))
        regions[region] = (sum(weight for weight, _ in inner.values()), _choose(doc_id, inner))
    return _choose(doc_id, regions).cast("int")


def assign(docs: DataFrame, count: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and grown_shard (with one shard more) of every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return only(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        shard_of(F.col("doc_id"), tree_of(count)).alias("shard"),
        shard_of(F.col("doc_id"), tree_of(count + 1)).alias("grown_shard"),
    )


def with_slots(assigned: DataFrame) -> DataFrame:
    """``assigned`` with ``slot``, the number of a row in its shard from 0 on, in order of doc_id.

    The pieces of one range shuffle are numbered each for itself and moved on by the rows of their
    shard in earlier pieces: one count per piece and shard.
    """
    order = ["doc_id", "size", "text_crc32"]
    n = partitions(assigned)
    dealt = assigned.repartitionByRange(n, "shard", *order, F.xxhash64(*order, F.monotonically_increasing_id()))
    placed = stored(dealt.withColumn("_piece", F.spark_partition_id()), "shard_pieces")
    counts = placed.groupBy("shard", "_piece").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_piece", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("shard", "_piece").orderBy(*order))
    return placed.withColumn("_inside", inside).join(offsets, ["shard", "_piece"]).select(
        *assigned.columns, (F.col("_inside") - 1 + F.col("_before")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, count: int = SHARDS) -> None:
    """The rows of ``docs`` in one folder per shard; a shard may take several tasks and files."""
    placed = docs.withColumn("shard", shard_of(docs["doc_id"], tree_of(count)))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
