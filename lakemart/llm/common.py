"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Generic, TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Value = TypeVar("Value")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of the folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    """How many pieces keyed work is dealt into: the session's shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def map_batches(
    df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch], *, rows: int = 10_000
) -> DataFrame:
    """``work`` applied to the Arrow batches of ``df``, cut to at most ``rows`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield work(batch.slice(at, rows))

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def flat_text(column: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The UTF-8 bytes of all texts in one buffer, without a copy, and the size of each; null counts as empty."""
    whole = column.fill_null("") if column.null_count else column
    _, offsets, content = whole.buffers()
    wide = np.int64 if pa.types.is_large_string(whole.type) else np.int32
    ends = np.zeros(1, dtype=wide) if offsets is None else np.frombuffer(offsets, dtype=wide)[whole.offset : whole.offset + len(whole) + 1]
    first, last = (int(ends[0]), int(ends[-1])) if len(ends) else (0, 0)
    return (content or pa.py_buffer(b"")).slice(first, last - first), np.diff(ends).astype(np.int64)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, also where other columns differ from them in case only."""
    places = [df.columns.index(name) for name in names]
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"c{i}").alias(name) for i, name in zip(places, names, strict=True)])


def same(left: Column, right: Column) -> Column:
    """Equality that also matches null with null."""
    return left.eqNullSafe(right)


def text_digest(text: Column, *, lower: bool = False) -> Column:
    """SHA-256 of the whole text, with A-Z in lower case if asked; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.translate(whole, UPPER, LOWER) if lower else whole, 256))


def per_row(docs: DataFrame, verdicts: DataFrame, how: str, *, lower: bool = False) -> DataFrame:
    """``docs`` joined with ``verdicts`` on doc_id (also null) and the digest of the whole text.

    So rows that share a doc_id are judged each for itself. The columns of ``docs`` are numbered c0, c1, ..., then
    comes ``_digest``, so that names that differ in case only do not clash; ``named`` gives the names back.
    """
    places = [docs.columns.index(name) for name in ("doc_id", "text")]
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own = numbered.withColumn("_digest", text_digest(F.col(f"c{places[1]}"), lower=lower))
    theirs = verdicts.withColumnsRenamed({"doc_id": "_of_id", "digest": "_of_digest"})
    on = same(F.col(f"c{places[0]}"), F.col("_of_id")) & (F.col("_digest") == F.col("_of_digest"))
    return own.join(theirs, on, how)


def named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` out of what ``per_row`` gave."""
    return rows.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])


def by_size(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` cut so that the texts of a part have at most ``size`` bytes, or it is a single row."""
    ends = np.cumsum(flat_text(batch.column(column))[1])
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, end - at)
        at = end


def _kinds() -> np.ndarray:
    """For each byte: 1 if a space, 2 if other printable ASCII, 4 more if a letter, 8 more if it often ends a word."""
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[ord(" ")] = 1
    kinds[ord("!") : 127] = 2
    kinds[[ord(letter) for letter in UPPER + LOWER]] |= 4
    kinds[[ord(mark) for mark in ".,;:!?"]] |= 8
    return kinds


def cut(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The texts as pieces: the distinct pieces, the number of each piece in turn, and the pieces of each text.

    Texts are cut between an ASCII letter and one of ``.,;:!?``, and before a space that follows or precedes a
    printable ASCII character, but not before the last character of a text if it is a space. So no run of
    letters is cut, and no run of white space but at its start or before its last space. Null counts as empty,
    and an empty text has no piece.
    """
    content, sizes = flat_text(column)
    flat = _kinds()[np.frombuffer(content, dtype=np.uint8)]
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    starts = np.zeros(len(flat) + 1, dtype=bool)
    starts[1:-2] = (flat[1:-1] == 1) & ((flat[:-2] | flat[2:]) & 2 > 0)
    starts[first[1:] - 1] = False
    starts[1:-1] |= (flat[1:] & 8 > 0) & (flat[:-1] & 4 > 0)
    starts[first] = True
    starts[len(flat)] = True
    bounds = np.flatnonzero(starts)
    per_text = np.searchsorted(bounds, np.cumsum(sizes)) - np.searchsorted(bounds, np.cumsum(sizes) - sizes)
    offsets = pa.py_buffer(bounds.astype(np.int64))
    pieces = pa.LargeStringArray.from_buffers(len(bounds) - 1, offsets, content).dictionary_encode()
    return pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy(), per_text


def ragged(flat: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` (of ``sizes``, one after the other) that ``chosen`` names, joined."""
    starts, wide = (np.cumsum(sizes) - sizes)[chosen], sizes[chosen]
    ends = np.cumsum(wide)
    return flat[np.repeat(starts - ends + wide, wide) + np.arange(ends[-1] if len(ends) else 0)]


class Remembered(Generic[Value]):
    """What a worker knows of pieces of text: two generations, the older one forgotten for a new one.

    Pieces longer than ``LONGEST`` are worked out each time.
    """

    LONGEST = 200

    def __init__(self, size: int, work: Callable[[list[str]], Iterable[Value]]) -> None:
        self.size, self.work = size, work
        self.known: dict[str, Value] = {}
        self.older: dict[str, Value] = {}

    def __call__(self, pieces: list[str]) -> list[Value]:
        """The value of each of the distinct pieces."""
        if len(self.known) > self.size:
            self.older, self.known = self.known, {}
        made = list(map(self.known.get, pieces))
        new = []
        for i, value in enumerate(made):
            if value is None:
                if (made_before := self.older.get(pieces[i])) is None:
                    new.append(i)
                else:
                    made[i] = self.known[pieces[i]] = made_before
        for i, value in zip(new, self.work([pieces[i] for i in new]), strict=True):
            made[i] = value
            if len(pieces[i]) <= self.LONGEST:
                self.known[pieces[i]] = value
        return made
