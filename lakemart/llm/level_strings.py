"""A Merkle manifest of a documents table, kept as one hex string per level of each aligned block.

Leaves stand by doc_id within their source. A block is 256 neighbours of one source; it keeps its leaves as one string of
64 digits each, and their parents as another. Substrings of fixed width are the runs that parents hash, and what flanks
a digest in its run is its part of the proof. The roots of the blocks are the nodes of the next round, 256 to one,
until a source has one node left; these subroots make one more tree of the same kind. Proofs come back down: a
block hands its own path to its members, so leaves are never joined with the levels above.

All of it is DataFrame functions: the texts are hashed once, in place; what moves afterwards are digests. A source
with a third of the rows is many blocks, and no task gets more than the leaves of one block at a time.

Defined cases: a null field is hashed as ``-``; a null doc_id stands before all others and a null source before
all sources; rows that share a doc_id stand in the order of their leaves, equal rows each have a place of
their own; a source with a single row has its leaf as subroot and no siblings; an empty table has no rows and no root.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import LOWER, UPPER, only, same
from lakemart.operators.ranking import global_row_number
from lakemart.session import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WIDE = 64  # digits of a digest
FAN = 16  # children of a node
BLOCK = FAN * FAN  # leaves or nodes of a block: two levels a round
MOST_LEVELS = 16  # 16^16 leaves is more than a long counts


def hashed(*fields: Column) -> Column:
    """SHA-256 of the fields in turn, each as its count of UTF-8 bytes, a colon and the value, or ``-`` if null."""
    framed = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*framed), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf of every row, and ``altered``: the leaf with A-Z of the text in lower case.

    ``altered`` is null unless 5 divides the CRC-32 of the decimal doc_id.
    """
    own = only(docs, *FIELDS)
    as_text = {name: F.col(name).cast("string") for name in FIELDS}
    lowered = as_text | {"text": F.translate(F.col("text"), UPPER, LOWER)}
    chosen = F.crc32(as_text["doc_id"].cast("binary")) % 5 == 0
    altered = F.when(chosen, hashed(*lowered.values())).alias("altered")
    return own.select("doc_id", "source", hashed(*as_text.values()).alias("leaf"), altered)


def _levels(nodes: Column) -> Column:
    """How many levels lie above so many nodes until one is left."""
    passed = [(nodes > F.lit(FAN).cast("decimal(38,0)") ** k if k else nodes > 1).cast("int") for k in range(MOST_LEVELS)]
    whole = passed[0]
    for more in passed[1:]:
        whole = whole + more
    return whole


def _piece(level: Column, start: Column, end: Column) -> Column:
    """The digests from place ``start`` up to ``end`` of a level string."""
    return F.substring(level, start * WIDE + 1, (end - start) * WIDE)


def _siblings(level: Column, place: Column) -> Column:
    """What flanks the digest at ``place`` in its run of a level string."""
    first = F.floor(place / FAN).cast("int") * FAN
    left, right = _piece(level, first, place), _piece(level, place + 1, first + FAN)
    return F.struct(left.alias("left"), right.alias("right"))


def _blocks(nodes: DataFrame) -> DataFrame:
    """The blocks of the nodes (part, place, levels, node): their members in order, level strings and root."""
    block = F.floor(F.col("place") / BLOCK).cast("long").alias("block")
    members = F.array_sort(F.collect_list(F.struct("place", "node"))).alias("members")
    grouped = nodes.groupBy("part", block, "levels").agg(members)
    low = F.array_join(F.transform("members", lambda m: m["node"]["digest"]), "")
    runs = F.sequence(F.lit(0), F.floor((F.size("members") - 1) / FAN).cast("int"))
    high = F.array_join(F.transform(runs, lambda run: F.sha2(_piece(F.col("low"), run * FAN, run * FAN + FAN), 256)), "")
    one, two = F.col("levels") >= 1, F.col("levels") >= 2
    root = F.when(two, F.sha2("high", 256)).when(one, F.col("high")).otherwise(F.col("low"))
    return grouped.withColumn("low", low).withColumn("high", high).withColumn("root", root)


def _members(blocks: DataFrame, above: DataFrame | None) -> DataFrame:
    """part, place, node and path of all members; ``above`` has the path of each block, if any lead on."""
    if above is None:
        beyond = blocks.withColumn("beyond", F.expr("array()").cast("array<struct<left:string,right:string>>"))
    else:
        ways = above.select(F.col("part").alias("_part"), F.col("place").alias("_block"), F.col("path").alias("beyond"))
        beyond = blocks.join(ways, (F.col("part") == F.col("_part")) & (F.col("block") == F.col("_block")), "left")
    none = F.expr("array()").cast("array<struct<left:string,right:string>>")

    def member(m: Column, i: Column) -> Column:
        low = F.when(F.col("levels") >= 1, F.array(_siblings(F.col("low"), i))).otherwise(none)
        high = F.when(F.col("levels") >= 2, F.array(_siblings(F.col("high"), F.floor(i / FAN).cast("int")))).otherwise(none)
        path = F.concat(low, high, F.coalesce("beyond", none))
        return F.struct(m["place"].alias("place"), m["node"].alias("node"), path.alias("path"))

    return beyond.select("part", F.explode(F.transform("members", member)).alias("m")).select("part", "m.*")


class Tree(NamedTuple):
    rounds: list[DataFrame]
    roots: DataFrame  # part, root

    def paths(self) -> DataFrame:
        """part, place, node and path (left and right siblings, level by level) of every leaf."""
        found: DataFrame | None = None
        for blocks in reversed(self.rounds):
            found = _members(blocks, found)
        return found


def tree(nodes: DataFrame, most: int, name: str) -> Tree:
    """The tree of each part of ``nodes`` (part, place from 0, levels above, node with a digest).

    ``most`` is the largest number of levels: each round takes two off and one row in ``BLOCK`` goes on.
    """
    rounds: list[DataFrame] = []
    roots: DataFrame | None = None
    while True:
        blocks = stored(_blocks(nodes), f"{name}_blocks")
        rounds.append(blocks)
        ended = blocks.where("levels <= 2").select("part", "root")
        roots = ended if roots is None else roots.unionByName(ended)
        most -= 2
        if most <= 0:
            return Tree(rounds, roots)
        going = blocks.where("levels > 2")
        nodes = going.select("part", F.col("block").alias("place"), (F.col("levels") - 2).alias("levels"), F.struct(F.col("root").alias("digest")).alias("node"))


class Manifest(NamedTuple):
    rows: DataFrame  # the columns of the leaves, subroot, and path up to the root
    sources: DataFrame  # source, rows, subroot
    root: str | None


def manifest(marked: DataFrame) -> Manifest:
    """The tree over leaves (source, doc_id, leaf and any further columns).

    The leaves are ranked by one range shuffle, their places follow from the first rank of each source.
    """
    kept = stored(marked.withColumn("_at", F.monotonically_increasing_id()), "manifest_leaves")
    ranked = stored(global_row_number(kept, [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), "leaf", "_at"], "_rank"), "manifest_ranks")
    counted = ranked.groupBy("source").agg(F.min("_rank").alias("_first"), F.count("*").alias("rows"))
    parts = stored(
        global_row_number(counted, [F.asc_nulls_first("source")], "_number").select(
            F.col("source").alias("_source"), "_first", "rows", (F.col("_number") - 1).alias("part"), _levels(F.col("rows")).alias("levels")
        ),
        "manifest_sources",
    )
    sizes = parts.agg(F.count("*"), F.max("levels")).first()
    if not sizes[0]:
        nothing = marked.withColumn("subroot", F.lit(None).cast("string")).withColumn("path", F.expr("array()").cast("array<struct<left:string,right:string>>"))
        return Manifest(nothing, parts.select(F.col("_source").alias("source"), "rows", F.lit(None).cast("string").alias("subroot")), None)
    further = [F.col(name) for name in marked.columns if name != "leaf"]
    node = F.struct(F.col("leaf").alias("digest"), *further).alias("node")
    placed = ranked.join(parts, same(F.col("source"), F.col("_source"))).select(
        "part", (F.col("_rank") - F.col("_first")).alias("place"), "levels", node
    )
    low = tree(placed, sizes[1], "manifest")
    subroots = stored(low.roots, "manifest_subroots")
    over = subroots.select(F.lit(0).cast("long").alias("part"), F.col("part").alias("place"), _levels(F.lit(sizes[0])).alias("levels"), F.struct(F.col("root").alias("digest")).alias("node"))
    levels_over = sum(sizes[0] > FAN**k for k in range(MOST_LEVELS))
    high = tree(over, levels_over, "manifest_top")
    root = high.roots.first()["root"]
    tops = stored(high.paths().select(F.col("place").alias("_part"), F.col("node.digest").alias("subroot"), F.col("path").alias("_top")), "manifest_tops")
    joined = low.paths().join(tops, F.col("part") == F.col("_part"))
    rows = joined.select("node.*", "subroot", F.concat("path", "_top").alias("path")).withColumnRenamed("digest", "leaf")
    sources = parts.join(tops, F.col("part") == F.col("_part")).select(F.col("_source").alias("source"), "rows", "subroot")
    return Manifest(rows, sources, root)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda digest, at: F.sha2(F.concat(at["left"], digest, at["right"]), 256))


def proof(path: Column) -> Column:
    """All siblings of a path in one string, level by level, left to right."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), "")


def verify(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root, proof and the root found from the altered leaf, of every row of ``docs``."""
    made = manifest(leaves(docs))
    root = F.lit(made.root).cast("string")
    found = made.rows.select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
        folded(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
