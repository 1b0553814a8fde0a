"""Exact dedup: a cuckoo-filter index of live digests, bucketed by digest.

Texts are equal when identical after lower-casing A-Z. ``CuckooIndex`` answers "surely new" or "perhaps
known" from two bytes a digest; a hit is then checked against the full keys stored in the bucket. Every
task runs its rows through an index of its own first, so each sends one row per digest and a hot text is
no hot spot; the buckets, dealt out by digest, merge what is left. Groups found that way are compared
again by their whole texts, and rows that only share a digest are grouped anew.

``build_index``, ``insert`` and ``delete`` keep such an index as a table for later loads.

Defined cases: a null text counts as empty; a null doc_id is smaller than any other; of repeated rows
(equal doc_id and text) exactly one is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_batches, named, only, partitions, per_row, same
from lakemart.session import stored

SLOTS = 4  # fingerprints a cell of the filter holds
MAX_KICKS = 64  # moves after which the filter counts as full
MAX_LOAD = 0.85  # share of used slots from which it is enlarged ahead of time
PIECE = 256  # rows of a group that are compared with its text in one place

Digest = Callable[[bytes], bytes]


def sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


class CuckooIndex:
    """A cuckoo filter over digests, with the full keys of its bucket to verify hits and to grow from.

    ``values`` holds for every live key what the caller keeps with it. The filter never misses a live
    key: a key without a hit is new, without looking at the stored keys.
    """

    def __init__(self, cells: int = 64) -> None:
        self.values: dict[bytes, list] = {}
        self._make(cells)

    def _make(self, cells: int) -> None:
        self.cells = cells  # a power of two
        self.table = np.zeros((cells, SLOTS), dtype=np.uint16)
        self.used = 0

    def _place(self, key: bytes) -> tuple[int, int]:
        """Fingerprint (not zero) and first cell, from bytes that did not pick the bucket."""
        word = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little")
        return (word & 0xFFFF) or 1, (word >> 16) % self.cells

    def _other(self, cell: int, mark: int) -> int:
        return cell ^ ((mark * 0x5BD1) % self.cells)

    def _seen(self, key: bytes) -> bool:
        mark, first = self._place(key)
        return mark in self.table[first] or mark in self.table[self._other(first, mark)]

    def _put(self, key: bytes) -> bool:
        mark, cell = self._place(key)
        for place in (cell, self._other(cell, mark)):
            free = np.flatnonzero(self.table[place] == 0)
            if len(free):
                self.table[place, free[0]] = mark
                self.used += 1
                return True
        for kick in range(MAX_KICKS):
            slot = (kick + mark) % SLOTS
            mark, self.table[cell, slot] = int(self.table[cell, slot]), mark
            cell = self._other(cell, mark)
            free = np.flatnonzero(self.table[cell] == 0)
            if len(free):
                self.table[cell, free[0]] = mark
                self.used += 1
                return True
        return False  # a fingerprint is without a place now: the filter must grow

    def _grow(self) -> None:
        """A filter twice as large, filled from the stored keys; again if one does not fit."""
        cells = self.cells
        while True:
            cells *= 2
            self._make(cells)
            if all(self._put(key) for key in self.values):
                return

    def find(self, key: bytes) -> list | None:
        """What is kept with a live key. A hit of the filter counts only if the stored key agrees."""
        return self.values.get(key) if self._seen(key) else None

    def insert(self, key: bytes, value: list) -> None:
        """Add a key that is not live."""
        self.values[key] = value
        if self.used >= MAX_LOAD * SLOTS * self.cells or not self._put(key):
            self._grow()

    def delete(self, key: bytes) -> bool:
        """Remove a live key, and one copy of its fingerprint. False if it is not live."""
        if self.find(key) is None:
            return False
        del self.values[key]
        mark, first = self._place(key)
        for place in (first, self._other(first, mark)):
            held = np.flatnonzero(self.table[place] == mark)
            if len(held):
                self.table[place, held[0]] = 0
                self.used -= 1
                break
        return True

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_table(cls, filter_bytes: bytes, keys: Iterable[bytes], values: Iterable[list]) -> CuckooIndex:
        index = cls.__new__(cls)
        index.table = np.frombuffer(filter_bytes, dtype=np.uint16).reshape(-1, SLOTS).copy()
        index.cells = len(index.table)
        index.used = int((index.table > 0).sum())
        index.values = dict(zip(keys, values, strict=True))
        return index


def merge(index: CuckooIndex, key: bytes, row: tuple, count: int) -> None:
    """Count ``count`` more rows of a digest; the greatest ``row`` (doc_id, row number) is the one to stay."""
    known = index.find(key)
    if known is None:
        index.insert(key, [row, count])
    else:
        known[0] = max(known[0], row)
        known[1] += count


def _row(doc_id: int | None, number: int) -> tuple:
    return (doc_id is not None, doc_id or 0, number)


def digests(docs: DataFrame, digest: Digest = sha256) -> DataFrame:
    """doc_id, digest of the lower-cased whole text, and a number that tells repeated rows apart."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lowered = pc.ascii_lower(batch.column(1).fill_null("")).cast(pa.binary())
        made = pa.array([digest(text.as_buffer()) for text in lowered], pa.binary())
        return pa.record_batch([batch.column(0).cast(pa.int64()), made], names=["doc_id", "digest"])

    found = map_batches(only(docs, "doc_id", "text"), "doc_id long, digest binary", work)
    return found.withColumn("row", F.monotonically_increasing_id())


PARTIAL = "digest binary, keep_id long, keep_row long, group_size long"


def _through_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one task or bucket, merged by digest in an index of its own."""
    index = CuckooIndex()
    for batch in batches:
        for key, doc_id, number, count in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            merge(index, key, _row(doc_id, number), count)
    if index.values:
        rows = [(key, row[1] if row[0] else None, row[2], count) for key, (row, count) in index.values.items()]
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
        yield pa.record_batch(
            [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["digest", "keep_id", "keep_row", "group_size"],
        )


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest of ``rows``: the doc_id and row that stay, and the size of the group."""
    single = rows.select("digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("group_size"))
    by_task = single.mapInArrow(_through_index, PARTIAL)
    return by_task.repartition(partitions(rows), "digest").mapInArrow(_through_index, PARTIAL)


def decisions(docs: DataFrame, digest: Digest = sha256) -> DataFrame:
    """doc_id, digest, keep_id, group_size and kept of every row of ``docs``.

    Rows of groups of two or more are read again with their texts and compared with the text that
    stays; rows that differ from it make a further round among themselves.
    """
    rows = stored(digests(docs, digest), "digests")
    found = stored(_decided(rows, groups(rows)), "digest_groups")
    alone = found.where("group_size = 1")
    pending = found.where("group_size > 1").select("doc_id", "digest", "row", "group_size")
    done = alone
    while True:
        checked = stored(_compared(docs, pending, digest), "compared_texts")
        equal = checked.where("same_text").select("doc_id", "digest", "row")
        done = done.unionByName(_decided(equal, groups(equal)))
        pending = checked.where("NOT same_text").select("doc_id", "digest", "row", "group_size")
        if pending.isEmpty():
            return done


def _decided(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with their group; one row per digest meets them, so skewed digests can be split."""
    return rows.join(found, "digest").select(
        "doc_id", "digest", "row", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")
    )


def _compared(docs: DataFrame, rows: DataFrame, digest: Digest) -> DataFrame:
    """``rows`` with ``same_text``: whether their whole text is the one of their group that stays.

    Texts are read once more and only those of ``rows`` go on. A doc_id may have several texts; its
    rows are told apart by the digest.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lowered = pc.ascii_lower(batch.column(1).fill_null(""))
        made = pa.array([digest(text.as_buffer()) for text in lowered.cast(pa.binary())], pa.binary())
        return pa.record_batch([batch.column(0).cast(pa.int64()), made, lowered], names=["id", "hash", "text"])

    read = map_batches(only(docs, "doc_id", "text"), "id long, hash binary, text string", work)
    wanted = rows.groupBy("doc_id", "digest").agg(F.max("row").alias("row"), F.max("group_size").alias("size"))
    texts = read.join(
        wanted.hint("shuffle_hash"), same(F.col("id"), F.col("doc_id")) & (F.col("hash") == F.col("digest"))
    ).select("doc_id", "digest", "row", "text", F.ceil(F.col("size") / PIECE).cast("int").alias("pieces"))
    texts = texts.withColumn("piece", F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int"))
    texts = stored(texts, "texts_of_groups")
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "row", F.xxhash64("text"))
    # The text that stays goes once to every piece of its group, so that no task gets a whole hot group.
    stays = texts.groupBy(F.col("digest").alias("of")).agg(
        F.max_by("text", order).alias("kept_text"), F.max("pieces").alias("all")
    ).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("all") - 1)))
    judged = texts.join(stays, (F.col("digest") == F.col("of")) & (F.col("piece") == F.col("part"))).select(
        F.col("doc_id").alias("id"), F.col("digest").alias("hash"), (F.col("text") == F.col("kept_text")).alias("same_text")
    )
    # A repeated row counts as often as it is there.
    by_id = judged.groupBy("id", "hash").agg(F.min("same_text").alias("same_text"))
    return rows.join(by_id, same(F.col("doc_id"), F.col("id")) & (F.col("digest") == F.col("hash"))).select(
        "doc_id", "digest", "row", "group_size", "same_text"
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    decided = stored(decisions(docs), "dedup_decisions")
    stays = decided.where("kept").select("doc_id", "digest").distinct()
    kept = per_row(docs, stays.hint("shuffle_hash"), "left_semi", lower=True)
    return named(kept.dropDuplicates([f"c{docs.columns.index('doc_id')}", "_digest"]), docs)


# The index as a table: one row per bucket with its filter, live digests and the doc_id kept for each.
INDEX = "bucket int, filter binary, keys array<binary>, ids array<long>"


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def _as_row(bucket: int, index: CuckooIndex) -> pd.DataFrame:
    ids = [value[0] for value in index.values.values()]
    return pd.DataFrame({"bucket": [bucket], "filter": [index.to_bytes()], "keys": [list(index.values)], "ids": [ids]})


def build_index(rows: DataFrame, buckets: int) -> DataFrame:
    """The index of ``rows`` (doc_id, digest), one row per digest, in ``buckets`` buckets.

    Choose the number of buckets so that the keys of one fit a task: a million takes about 100 MB.
    """

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        index = CuckooIndex()
        for key, doc_id in zip(pdf["digest"], pdf["doc_id"], strict=True):
            if index.find(bytes(key)) is None:
                index.insert(bytes(key), [int(doc_id)])
        return _as_row(int(pdf["bucket"].iloc[0]), index)

    return rows.select("doc_id", "digest", bucket_of(buckets).alias("bucket")).groupBy("bucket").applyInPandas(work, INDEX)


def change_index(index: DataFrame, changes: DataFrame, buckets: int) -> DataFrame:
    """The index after ``changes`` (doc_id, digest, deleted): deletions first, then new digests.

    Several changes of one digest in a load: a deletion and an insertion leave it live.
    """

    def work(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        held = old.iloc[0] if len(old) else None
        live = CuckooIndex() if held is None else CuckooIndex.from_table(
            bytes(held["filter"]), [bytes(k) for k in held["keys"]], [[int(i)] for i in held["ids"]]
        )
        for digest in new.loc[new["deleted"], "digest"]:
            live.delete(bytes(digest))
        added = new.loc[~new["deleted"]].sort_values("doc_id", ascending=False)
        for digest, doc_id in zip(added["digest"], added["doc_id"], strict=True):
            if live.find(bytes(digest)) is None:
                live.insert(bytes(digest), [int(doc_id)])
        return _as_row(int(key[0]), live)

    dealt = changes.select("doc_id", "digest", F.coalesce("deleted", F.lit(False)).alias("deleted"), bucket_of(buckets).alias("bucket"))
    return index.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInPandas(work, INDEX)
