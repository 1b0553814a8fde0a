"""SimHash near-dedup: fingerprints meet at the anchors of a covering code.

A fingerprint has 64 bits; two link when they differ in at most four. The bits are cut into blocks, and
every block gets a share of the four so that a link always has one block within its share (block i may
differ in ``share`` bits; the shares plus one each add up to five). The values of a block are covered by
a code whose words, the anchors, are within ``radius`` of any value. A fingerprint is at home at its
nearest anchor and is also copied to every anchor within radius plus share, so a home row meets all
fingerprints within the share of it in that block. Comparing home rows with all rows of their anchor
therefore finds every link.

The code of a block is a Hamming code (radius one, and perfect) over its first 15 bits and the values of
the remaining bits as they are; a block with share zero is its own anchor.

Defined cases: a null or wordless text has fingerprint zero, which links like any other; repeated rows
and equal fingerprints are one class; a null doc_id is never the smallest id, a component of null ids
only is null, and ``dedup`` keeps rows without an id; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_batches, named, only, partitions, per_row, text_bytes
from lakemart.session import stored

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4  # fingerprints link at so many differing bits or fewer

# (lowest bit, bits, share) of each block; the shares plus one each are MAX_BITS + 1 together.
BLOCKS = ((0, 24, 1), (24, 24, 1), (48, 16, 0))
HAMMING = 15  # bits of a block under the Hamming code
PAIRS_AT_ONCE = 1 << 21  # comparisons a task holds at a time
HOME_PIECE = 1024  # home rows of an anchor that are compared in one place


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text whose A-Z are lower case already."""
    words = text.split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    if len(words) <= SHINGLE_WORDS:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts = [0, *(ends[: len(words) - SHINGLE_WORDS] + 1).tolist()]
        hash_of = xxhash.xxh64_intdigest
        hashes = [
            hash_of(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)
        ]
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 1 << 16):
        bits = np.unpackbits(values[at : at + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed 64-bit number) and the digest of every whole text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lowered = pc.ascii_lower(batch.column(1).fill_null("")).cast(pa.binary()).to_pylist()
        made = np.array([fingerprint(text) for text in lowered], dtype=np.uint64).view(np.int64)
        digests = pa.array([hashlib.sha256(text).digest() for text in text_bytes(batch.column(1))], pa.binary())
        return pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(made), digests], names=["doc_id", "fp", "digest"])

    return map_batches(only(docs, "doc_id", "text"), "doc_id long, fp long, digest binary", work)


def _flips(bits: range, most: int) -> np.ndarray:
    """All masks of at most ``most`` of the bits."""
    masks = [sum(1 << b for b in chosen) for n in range(most + 1) for chosen in combinations(bits, n)]
    return np.array(masks, dtype=np.uint64)


def _syndrome(values: np.ndarray) -> np.ndarray:
    """Of the low 15 bits: the number of the bit to flip for a code word; 0 for a code word."""
    out = np.zeros(len(values), dtype=np.uint64)
    for bit in range(HAMMING):
        out ^= np.where((values >> np.uint64(bit)) & np.uint64(1), np.uint64(bit + 1), np.uint64(0))
    return out


def anchors(fps: np.ndarray, block: tuple[int, int, int]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Rows of ``fps`` with an anchor each: first every row's home, then the other anchors in reach."""
    low, bits, share = block
    value = (fps >> np.uint64(low)) & np.uint64((1 << bits) - 1)
    rows = np.arange(len(fps))
    if share == 0:
        yield rows, value, True
        return
    reach = 1 + share
    syndrome = _syndrome(value)
    home = np.where(syndrome > 0, value ^ (np.uint64(1) << (np.maximum(syndrome, 1) - np.uint64(1))), value)
    yield rows, home, True
    free = range(HAMMING, bits)
    for coded in range(reach + 1):  # flips among the coded bits that end at a code word
        for mask in _flips(range(HAMMING), coded):
            if int(mask).bit_count() != coded:
                continue
            hit = _syndrome(np.array([mask], dtype=np.uint64))[0] == syndrome
            for other in _flips(free, reach - coded):
                anchor = value[hit] ^ mask ^ other
                away = anchor != home[hit]
                yield rows[hit][away], anchor[away], False


def at_anchors(classes: DataFrame) -> DataFrame:
    """Fingerprints ``fp`` at every anchor in reach: key (block and anchor), fp, home."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column(0).to_numpy().view(np.uint64)
        keys, rows, homes = [], [], []
        for number, block in enumerate(BLOCKS):
            for row, anchor, home in anchors(fps, block):
                keys.append(anchor | np.uint64(number << 32))
                rows.append(row)
                homes.append(np.full(len(row), home))
        row = np.concatenate(rows)
        columns = [np.concatenate(keys).view(np.int64), fps.view(np.int64)[row], np.concatenate(homes)]
        return pa.record_batch([pa.array(c) for c in columns], names=["key", "fp", "home"])

    return map_batches(classes.select("fp"), "key long, fp long, home boolean", work)


class Forest:
    """Links as a growing forest in one task: of the links of a component only a spanning tree is kept."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent.setdefault(node, node)
        while parent != (above := self.parent[parent]):
            self.parent[node] = above
            node, parent = parent, above
        return parent

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):  # links whose ends have met are dropped, in bulk
            ends, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            roots = np.array([self.root(x) for x in ends.tolist()])
            ra, rb = roots[place[: len(a)]], roots[place[len(a) :]]
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            open_ = low != high
            a, b = low[open_], high[open_]
            if not len(a):
                return
            order = np.lexsort((a, b))
            first = np.r_[True, b[order][1:] != b[order][:-1]]
            for x, y in zip(a[order][first].tolist(), b[order][first].tolist(), strict=True):
                self.parent[self.root(y)] = self.root(x) if self.root(x) <= self.root(y) else self.root(x)

    def edges(self) -> pa.RecordBatch:
        pairs = [(node, root) for node in self.parent if (root := self.root(node)) != node]
        columns = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        return pa.record_batch([pa.array(columns[0]), pa.array(columns[1])], names=["a", "b"])


def _compare(forest: Forest, key: np.ndarray, node: np.ndarray, home: np.ndarray) -> None:
    """Link the home rows of each key with all its rows within ``MAX_BITS``; rows are sorted by key."""
    fp = node.view(np.uint64)
    start = np.searchsorted(key, key[home], "left")
    size = np.searchsorted(key, key[home], "right") - start
    left = np.flatnonzero(home)
    done = 0
    upto = np.cumsum(size)
    while done < len(left):
        base = upto[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(upto, base + PAIRS_AT_ONCE, "right")))
        sizes = size[done:stop]
        a = np.repeat(left[done:stop], sizes)
        first = np.repeat(start[done:stop] - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
        b = first + np.arange(len(a))
        close = (np.bitwise_count(fp[a] ^ fp[b]) <= MAX_BITS) & (a != b)
        forest.link(node[a[close]], node[b[close]])
        done = stop


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links found at the anchors of one task, whose rows come sorted by key.

    Whole keys are compared as their last row arrives, so a task holds little more than one key.
    """
    forest = Forest()
    held: list[np.ndarray] = []

    def compare(columns: list[np.ndarray]) -> None:
        if len(columns[0]):
            _compare(forest, *columns)

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
        if held:
            columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
        last = int(np.searchsorted(columns[0], columns[0][-1], "left"))
        compare([column[:last] for column in columns])
        held = [column[last:] for column in columns]
    if held:
        compare(held)
    if forest.parent:
        yield forest.edges()


def links(classes: DataFrame) -> DataFrame:
    """Links a, b (fingerprints) that connect whatever is within ``MAX_BITS``; of each task a spanning forest.

    Home rows of a crowded anchor are dealt into pieces, each of which meets all rows of the anchor.
    """
    placed = stored(at_anchors(classes), "anchors")
    crowds = placed.where("home").groupBy("key").count().where(F.col("count") > HOME_PIECE).select(
        "key", F.ceil(F.col("count") / HOME_PIECE).cast("int").alias("pieces")
    )
    marked = placed.join(crowds, "key", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    # A row is at home in its own piece only; in the others it is a visitor.
    dealt = marked.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        (F.col("key") + F.col("piece").cast("long") * (1 << 36)).alias("key"),
        "fp",
        (F.col("home") & (own == F.col("piece"))).alias("home"),
    )
    met = dealt.repartition(partitions(classes), "key").sortWithinPartitions("key")
    return met.mapInArrow(_links, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node and its component, the smallest node it is connected with; for all nodes of ``edges``.

    Large-star and small-star steps in turn (each one grouping and one join), written to a table each
    time, until nothing changes. The smallest neighbour is found by an aggregate, so a node with many
    links is no hot group.
    """
    current = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def star(pairs: DataFrame, *, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
        joined = both.join(least, F.col("u") == F.col("at"))
        if large:  # larger neighbours go to the smallest one
            moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # the node and its smaller neighbours go to the smallest one
            moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select(F.col("at").alias("u"), F.col("m").alias("v"))
            )
        return moved.where("u > v").distinct()

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())

    before = mark(current)
    while True:
        current = stored(star(star(current, large=True), large=False), "links")
        after = mark(current)
        if after == before:
            break
        before = after
    return current.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the whole text), fp, component (its smallest fingerprint) and component_id (the smallest
    doc_id reachable) of every row of ``docs``. A component whose rows all lack a doc_id has no component_id."""
    rows = stored(fingerprints(docs), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint_classes")
    found = components(links(classes))
    members = classes.join(found, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("of"), "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = members.groupBy(F.col("component").alias("whole")).agg(F.min("least").alias("component_id"))
    by_fp = members.join(smallest, F.col("component") == F.col("whole")).select("of", "component", "component_id")
    return rows.join(by_fp, F.col("fp") == F.col("of")).select("doc_id", "digest", "fp", "component", "component_id")


def dedup(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs``.

    It is the one with the smallest doc_id; rows without one come last, and of rows that share it the one with the
    smallest digest of its text stays. So rows that share a doc_id are judged each for itself.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "digest")).alias("first")
    stays = near_groups(docs).groupBy("component").agg(first).select("first.doc_id", "first.digest")
    kept = per_row(docs, stays, "left_semi")
    return named(kept.dropDuplicates([f"c{docs.columns.index('doc_id')}", "_digest"]), docs)
