"""Token ids in binary files: frequency-ranked ids in a byte-aligned code with separate control bytes.

Ids are replaced by their rank, counted over the whole corpus, so frequent ids are small numbers. A rank
takes one to four bytes; its length minus one stands in two bits of a control byte, four ranks to a
control byte. Control bytes and data bytes are kept apart, so numpy decodes a block by looking all control
bytes up in a table of lengths and gathering the data bytes at their running sums.

A file is a run of blocks, each ended by a line feed. A block holds whole documents in ascending doc_id
order: a header, doc_ids, lengths, control bytes, data bytes. Files cover ascending ranges of doc_id; the
header names the range. Spark's text sink writes the bytes as they are, with its commit protocol.

Defined cases: a null or empty text is the end id alone; a null doc_id comes first; repeated rows are
written as often as they are there; an empty table makes no block and an empty result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from lakemart.llm.common import Remembered, by_size, cut, map_batches, only, partitions, ragged
from lakemart.session import new_table_path, stored

END_ID = 2
MAGIC = b"RVB1"
HEADER = struct.Struct("<4sIIQII")  # magic, range number, documents, ranks, control bytes, data bytes
BLOCK_TOKENS = 1 << 20  # a block is closed when it has so many
CACHE = 450_000  # pieces of a generation; a worker remembers two, and forgets the older one for a new one
PIECES_AT_ONCE = 10_000  # the tokenizer is given
BYTES_AT_ONCE = 8 << 20  # of text encoded together
TEXTS_AT_ONCE = 1024

LETTERS = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")  # all of these are letters


class PieceEncoder:
    """The tokenizer, asked once per distinct piece of text.

    A text may be cut where ``cut`` does: the tokenizer's pattern cuts there too. Pieces it would leave whole,
    a space at most and letters, are given to the same model without the pattern. The tokens of a piece have its bytes, so the ids of many pieces,
    made together, are told apart by the lengths of the tokens.
    """

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        rule = json.loads(self.tokenizer.to_str())
        if rule["normalizer"] or rule["pre_tokenizer"]["type"] != "ByteLevel" or rule["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a tokenizer that keeps all bytes as they are is wanted")
        self.whole = Tokenizer(self.tokenizer.model)
        self.whole.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        added = self.tokenizer.get_added_tokens_decoder()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(1 + max([*vocab.values(), *added]), dtype=np.int64)
        for token, number in vocab.items():
            self.width[number] = len(token)  # one character a byte
        for number, token in added.items():
            self.width[number] = len(token.content.encode())
        self.ids_of = Remembered(CACHE, self.tokenized)

    def tokenized(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, four bytes each."""
        made = [b""] * len(pieces)
        simple = [LETTERS.fullmatch(piece) is not None for piece in pieces]
        for tokenizer, kind in ((self.whole, True), (self.tokenizer, False)):
            places = [i for i, is_simple in enumerate(simple) if is_simple == kind]
            for at in range(0, len(places), PIECES_AT_ONCE):
                some = places[at : at + PIECES_AT_ONCE]
                for i, ids in zip(some, self._together(tokenizer, [pieces[i] for i in some]), strict=True):
                    made[i] = ids
        return made

    def _together(self, tokenizer: Tokenizer, pieces: list[str]) -> Iterator[bytes]:
        found = tokenizer.encode_batch_fast([pieces], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.array(found.ids, dtype="<u4")
        reached = np.cumsum(self.width[ids])
        ends = np.cumsum([len(piece.encode()) for piece in pieces])
        bounds = np.searchsorted(reached, ends) + 1
        if (reached[bounds - 1] != ends).any():
            raise ValueError("the tokens of a piece differ from its bytes")
        raw = ids.tobytes()
        bounds = [0, *(4 * bounds).tolist()]
        return map(raw.__getitem__, map(slice, bounds[:-1], bounds[1:]))

    def encode(self, column: pa.Array, end_id: int) -> pa.Array:
        """The ids of each text and the end id, four bytes each."""
        distinct, pieces, per_text = cut(column)
        made = self.ids_of(distinct)
        sizes = np.array([len(ids) // 4 for ids in made], dtype=np.int64)
        ids = ragged(np.frombuffer(b"".join(made), dtype="<u4"), sizes, pieces)
        before = np.r_[0, np.cumsum(sizes[pieces])]  # ids ahead of each piece
        ends = before[np.cumsum(per_text)]
        whole = np.insert(ids, ends, end_id).astype("<u4", copy=False)
        bounds = 4 * np.r_[0, ends + np.arange(1, len(ends) + 1)]
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ends), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(whole)]
        )


@lru_cache(maxsize=2)
def _encoder(name: str) -> PieceEncoder:
    return PieceEncoder(SparkFiles.get(name))


def tokens(docs: DataFrame, file: str, end_id: int = END_ID) -> DataFrame:
    """doc_id and ids (four bytes each, the end id last) of every whole text."""
    docs.sparkSession.sparkContext.addFile(file)
    name = file.rsplit("/", 1)[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1, BYTES_AT_ONCE):
                ids = _encoder(name).encode(part.column(1), end_id).cast(pa.binary())
                yield pa.record_batch([part.column(0).cast(pa.int64()), ids], names=["doc_id", "ids"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def _flat_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all documents one after the other, without a copy, and how many each has."""
    _, offsets, content = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    if not len(ends) or content is None:
        return np.zeros(0, dtype=np.uint32), np.zeros(len(column), dtype=np.int64)
    ids = np.frombuffer(content, dtype=np.uint8)[int(ends[0]) : int(ends[-1])].view("<u4")
    return ids, np.diff(ends).astype(np.int64) // 4


def frequencies(encoded: DataFrame) -> DataFrame:
    """id and n, counted in each task before the counts are added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            counts = np.bincount(_flat_ids(batch.column(0))[0])
            if len(counts) > len(total):
                total, counts = counts, total
            total[: len(counts)] += counts
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    return encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def ranked_ids(counts: DataFrame) -> np.ndarray:
    """The ids that occur, most frequent first; ties by id. No more than the vocabulary has."""
    rows = sorted((-row["n"], row["id"]) for row in counts.collect())
    return np.array([number for _, number in rows], dtype=np.uint32)


# Lengths of the four ranks of each control byte.
LENGTHS = 1 + ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64)


def slots(counts: np.ndarray) -> np.ndarray:
    """For documents of so many ranks: which of their slots hold one; the slots are filled up to fours."""
    wide = -(-counts // 4) * 4
    ends = np.cumsum(wide)
    within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - wide, wide)
    return within < np.repeat(counts, wide)


def pack(ranks: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray, bytes, np.ndarray]:
    """Control and data bytes of the ranks of several documents, and how many of each belong to each document."""
    size = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    held = slots(counts)
    padded = np.zeros(len(held), dtype=np.uint8)
    padded[held] = size - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1).astype(np.uint8)
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    reached = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    ends = np.cumsum(counts)
    return control.tobytes(), -(-counts // 4), data.tobytes(), reached[ends] - reached[ends - counts]


def unpack(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The ranks of the control and data bytes of documents that have so many each."""
    size = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[slots(counts)]
    start = np.cumsum(size) - size
    padded = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    ranks = padded[start].astype(np.uint32)
    for byte in range(1, 4):
        longer = np.flatnonzero(size > byte)
        ranks[longer] |= padded[start[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


def range_bounds(encoded: DataFrame, ranges: int) -> np.ndarray:
    """The first doc_id of each range but the first, so that ranges hold about as many documents.

    Only the doc_ids are read; Spark's own range shuffle would compute whole rows for its sample.
    """
    shares = [i / ranges for i in range(1, ranges)]
    found = encoded.approxQuantile("doc_id", shares, 0.2 / ranges) if shares else []
    return np.array(found, dtype=np.int64)


def _pieces(content: bytes, sizes: np.ndarray) -> pa.Array:
    """``content`` cut into runs of the sizes."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(content)])


def _coded(encoded: DataFrame, ids: np.ndarray, bounds: np.ndarray) -> DataFrame:
    """doc_id, n, and the control and data bytes of every document, and the number of its range."""
    rank = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, counts = _flat_ids(batch.column(1))
        control, wide, data, long = pack(rank[flat], counts)
        piece = np.searchsorted(bounds, batch.column(0).fill_null(-(1 << 63)).to_numpy(), "right")
        columns = [pa.array(counts), _pieces(control, wide), _pieces(data, long)]
        columns = [batch.column(0), *columns, pa.array(piece, pa.int32())]
        return pa.record_batch(columns, names=["doc_id", "n", "control", "data", "piece"])

    schema = "doc_id long, n long, control binary, data binary, piece int"
    return map_batches(encoded, schema, work, rows=TEXTS_AT_ONCE)


def block(piece: int, doc_ids: list[int | None], sizes: list[int], controls: list[bytes], datas: list[bytes]) -> bytes:
    """One block. The control bytes of each document start anew."""
    known = np.array([doc_id is not None for doc_id in doc_ids], dtype=np.uint8)
    ids = np.array([doc_id or 0 for doc_id in doc_ids], dtype="<i8")
    control, data = b"".join(controls), b"".join(datas)
    counts = np.array(sizes, dtype="<u4")
    head = HEADER.pack(MAGIC, piece, len(ids), int(counts.sum()), len(control), len(data))
    return head + known.tobytes() + ids.tobytes() + counts.tobytes() + control + data


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of one range, in order, as blocks."""
    piece = TaskContext.get().partitionId()
    held: list[list] = [[], [], [], []]

    def closed() -> pa.RecordBatch:
        made = block(piece, *held)
        for column in held:
            column.clear()
        return pa.record_batch([pa.array([made], pa.binary())], names=["block"])

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            for column, value in zip(held, row, strict=True):
                column.append(value)
            if sum(held[1]) >= BLOCK_TOKENS:
                yield closed()
    if held[0]:
        yield closed()


def write_files(encoded: DataFrame, ids: np.ndarray, path: str) -> None:
    """The documents of ``encoded`` (doc_id, ids) as files in the folder ``path``, in ascending doc_id order."""
    ranges = partitions(encoded)
    coded = _coded(encoded, ids, range_bounds(encoded, ranges))
    ranges = coded.repartitionById(ranges, F.col("piece")).drop("piece").sortWithinPartitions("doc_id")
    made = ranges.mapInArrow(_blocks, "block binary").select(F.col("block").cast("string").alias("value"))
    made.write.option("lineSep", "\n").option("compression", "none").text(path)


def read_blocks(content: memoryview) -> Iterator[tuple[int, list[int | None], np.ndarray, bytes, bytes]]:
    """Range number, doc_ids, lengths, control and data bytes of every block of a file."""
    at = 0
    while at < len(content):
        magic, piece, docs, ranks, control, data = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        parts = []
        at += HEADER.size
        for size in (docs, 8 * docs, 4 * docs, control, data):
            parts.append(bytes(content[at : at + size]))
            at += size
        counts = np.frombuffer(parts[2], dtype="<u4").astype(np.int64)
        if counts.sum() != ranks or bytes(content[at : at + 1]) != b"\n":
            raise ValueError("a block of token ids is damaged")
        at += 1
        ids = [doc_id if known else None for known, doc_id in zip(parts[0], np.frombuffer(parts[1], "<i8").tolist(), strict=True)]
        yield piece, ids, counts, parts[3], parts[4]


def documents_of(content: memoryview, ids: np.ndarray) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """Range number, doc_id, number of ids before it in the file, and ids of every document of a file."""
    before = 0
    for piece, doc_ids, counts, control, data in read_blocks(content):
        made = ids[unpack(control, data, counts)]
        ends = np.cumsum(counts).tolist()
        at = 0
        for doc_id, end in zip(doc_ids, ends, strict=True):
            yield piece, doc_id, before + at, made[at:end]
            at = end
        before += at


def read_files(spark: SparkSession, path: str, ids: np.ndarray) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files of ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = [
                    (piece, doc_id, before, len(made), zlib.crc32(np.ascontiguousarray(made, dtype="<u4")))
                    for piece, doc_id, before, made in documents_of(memoryview(content.as_buffer()), ids)
                ]
                columns = [pa.array(column, pa.int64()) for column in zip(*found, strict=True)]
                if columns:
                    yield pa.record_batch(columns, names=["piece", "doc_id", "before", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    schema = "piece long, doc_id long, before long, n_tokens long, ids_crc32 long"
    read = stored(files.where("length > 0").select("content").mapInArrow(run, schema), "token_positions")
    totals = read.groupBy("piece").agg(F.sum("n_tokens").alias("all"))
    earlier = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = totals.select("piece", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("offset"))
    return read.join(offsets, "piece").select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, file: str) -> DataFrame:
    """Encode every text, write the files, and read them back."""
    spark = docs.sparkSession
    kept = new_table_path(spark, "token_ids")
    encoded = tokens(docs, file)
    encoded.write.option("compression", "zstd").parquet(kept)
    encoded = spark.read.schema("doc_id long, ids binary").parquet(kept)
    ids = ranked_ids(frequencies(encoded))
    path = new_table_path(spark, "token_files")
    write_files(encoded, ids, path)
    return read_files(spark, path, ids)
