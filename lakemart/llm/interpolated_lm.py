"""LM scoring by deleted interpolation of n-gram estimates.

The probability of a word after another mixes three maximum-likelihood estimates: of the pair, of the word
alone, and an even share over the vocabulary. How they are mixed depends on how often the first word was
seen: contexts fall into buckets by the power of two of their count, and every bucket has its own weights.
The weights are learned by expectation-maximisation on a fold of the training documents, with the counts
of the other folds (the fold's own counts are deleted from the whole); scoring uses the whole counts.

Documents are packed into blocks of a few million words. A block knows its distinct words and pairs by a
64-bit hash; it sends their counts to the range of the hash space they belong to, which adds them up over
all blocks and sends the sums back in the order they came. Keys travel as differences of sorted numbers
and sums without keys, one compressed array per block and range, so what is shuffled stays near the size
of the text. A word or pair is sent once per block however frequent it is, so no range gets hot.

Defined cases: a null or empty text is the end token alone; a null doc_id counts as the text "" for the
folds; repeated rows are counted and scored each; without training documents the counts are zero and all
words are equally likely; without a held-out fold the weights stay as they start; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import only, partitions
from lakemart.session import stored

FOLDS = 7
HELD_OUT = 2  # the fold that nothing is learned from
TUNING = 3  # the training fold on which the mixture weights are learned
BLOCK_WORDS = 1_000_000
BUCKETS = 24  # contexts seen 0, 1, 2-3, 4-7, ... times
SETTLED = 1e-5  # gain in the log probability of a tuning token at which expectation-maximisation ends
MOST_ROUNDS = 500  # after which it ends with an error
LEAST_WEIGHT = 1e-6
START = np.array([0.3, 0.5, 0.2])  # weights of pair, word and even share before learning
END = np.uint64(xxhash.xxh64_intdigest(b"\0 end of text", 1))  # stands before the first word as well

BLOCK = "block long, doc_ids binary, known binary, folds binary, sizes binary, words binary, vocabulary binary"


def shrink(values: np.ndarray) -> bytes:
    """An array compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def grown(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def fold_of(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def _pack(rows: list[tuple[int | None, np.ndarray]], vocabulary: dict[bytes, int], number: int) -> pa.RecordBatch:
    hashes = np.array([xxhash.xxh64_intdigest(word) for word in vocabulary], dtype=np.uint64)
    words = np.concatenate([codes for _, codes in rows]).astype(np.uint32)
    values = [
        np.array([doc_id or 0 for doc_id, _ in rows], dtype=np.int64),
        np.array([doc_id is not None for doc_id, _ in rows], dtype=np.uint8),
        np.array([fold_of(doc_id) for doc_id, _ in rows], dtype=np.uint8),
        np.array([len(codes) for _, codes in rows], dtype=np.uint32),
        words,
        hashes,
    ]
    columns = [pa.array([number], pa.int64()), *[pa.array([shrink(value)], pa.binary()) for value in values]]
    return pa.record_batch(columns, names=[part.split()[0] for part in BLOCK.split(", ")])


def blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents packed into blocks, one row each: ids, folds, and words as numbers of a vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int | None, np.ndarray]] = []
        vocabulary: dict[bytes, int] = {}
        held = 0
        for batch in batches:
            lowered = pc.ascii_lower(batch.column(1).fill_null("")).cast(pa.binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), lowered, strict=True):
                found = text.as_py().split()
                codes = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in found), np.uint32, len(found))
                rows.append((doc_id, codes))
                held += len(codes) + 1
                if held >= block_words:
                    yield _pack(rows, vocabulary, 0)
                    rows, vocabulary, held = [], {}, 0
        if rows:
            yield _pack(rows, vocabulary, 0)

    return only(docs, "doc_id", "text").mapInArrow(run, BLOCK).withColumn("block", F.monotonically_increasing_id())


class Block:
    """A block unpacked: tokens of all its documents, each with the one before it, as keys."""

    def __init__(self, row: dict) -> None:
        self.number = row["block"]
        self.doc_ids, self.known = grown(row["doc_ids"], "i8"), grown(row["known"], "u1").astype(bool)
        self.folds, sizes = grown(row["folds"], "u1"), grown(row["sizes"], "u4").astype(np.int64)
        hashes = np.append(grown(row["vocabulary"], "u8"), END)
        ends = np.cumsum(sizes + 1) - 1  # where each document's end token stands
        self.sizes = sizes + 1
        codes = np.full(int(self.sizes.sum()), len(hashes) - 1, dtype=np.int64)
        inner = np.ones(len(codes), bool)
        inner[ends] = False
        codes[inner] = grown(row["words"], "u4")
        word = hashes[codes]
        before = np.r_[END, word[:-1]]  # an end token stands before each first word
        # Keys of words have an even lowest bit, those of pairs an odd one.
        self.word_key = word & ~np.uint64(1)
        self.pair_key = (before * np.uint64(0x9E3779B97F4A7C15) + (word ^ (word >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
        self.starts = ends + 1 - self.sizes
        fold = np.repeat(self.folds, self.sizes)
        self.training, self.tuning = fold != HELD_OUT, fold == TUNING

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys in order, and for every word and every pair its place among them."""
        n = len(self.word_key)
        keys, place = np.unique(np.concatenate([self.word_key, self.pair_key]), return_inverse=True)
        return keys, place[:n], place[n:]


def _bounds(ranges: int) -> np.ndarray:
    """The first key of each range but the first."""
    return np.array([(i << 64) // ranges for i in range(1, ranges)], dtype=np.uint64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def sent_counts(packed: DataFrame, ranges: int) -> DataFrame:
    """Per block and range: keys as differences, and their counts in training and in the tuning fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row)
            keys, word, pair = block.keys()
            training, tuning = (
                np.bincount(np.concatenate([word[chosen], pair[chosen]]), minlength=len(keys)).astype(np.uint32)
                for chosen in (block.training, block.tuning)
            )
            cuts = np.r_[0, np.searchsorted(keys, _bounds(ranges)), len(keys)]
            out = []
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if a < b:
                    steps = np.diff(keys[a:b], prepend=np.uint64(0))
                    out.append((i, block.number, shrink(steps), shrink(training[a:b]), shrink(tuning[a:b])))
            columns = [pa.array(c) for c in zip(*out, strict=True)]
            yield pa.record_batch(columns, names=["range", "block", "steps", "training", "tuning"])

    return packed.mapInArrow(run, "range long, block long, steps binary, training binary, tuning binary")


def summed_counts(sent: DataFrame) -> DataFrame:
    """Per block and range the sums over all blocks, in the order of the block's keys.

    ``vocabulary`` and ``tokens`` of a range: its distinct words and their occurrences in training, on the
    row of one of its blocks; ``rest`` are the occurrences without the tuning fold.
    """

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(grown(steps, "u8"), dtype=np.uint64) for steps in pdf["steps"]]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = {}
        for name in ("training", "tuning"):
            counts = np.concatenate([grown(data, "u4") for data in pdf[name]])
            sums[name] = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.uint64)
        words = (distinct & np.uint64(1)) == 0
        parts = np.split(place, np.cumsum([len(k) for k in keys])[:-1])
        first = np.arange(len(pdf)) == 0
        seen = sums["training"][words]
        return pd.DataFrame(
            {
                "block": pdf["block"],
                "range": pdf["range"],
                "training": [shrink(sums["training"][part]) for part in parts],
                "tuning": [shrink(sums["tuning"][part]) for part in parts],
                "vocabulary": np.where(first, int((seen > 0).sum()), 0),
                "tokens": np.where(first, int(seen.sum()), 0),
                "rest": np.where(first, int(seen.sum()) - int(sums["tuning"][words].sum()), 0),
            }
        )

    schema = "block long, range long, training binary, tuning binary, vocabulary long, tokens long, rest long"
    return sent.groupBy("range").applyInPandas(work, schema)


def returned_counts(packed: DataFrame, sums: DataFrame) -> DataFrame:
    """The blocks, each with the sums of its keys."""
    back = sums.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("range", "training", "tuning"))).alias("sums"))
    return packed.join(back, "block")


def _sums(row: dict, name: str) -> np.ndarray:
    return np.concatenate([grown(part[name], "u8") for part in row["sums"]])


def bucket_of(context: np.ndarray) -> np.ndarray:
    """The bucket of a context by its count: 0, then by powers of two."""
    return np.minimum(np.floor(np.log2(np.maximum(context, 0.5))) + 1, BUCKETS - 1).astype(np.int64)


def estimates(context: np.ndarray, pair: np.ndarray, word: np.ndarray, tokens: int, vocabulary: int) -> np.ndarray:
    """The three estimates of every token, one column each."""
    return np.stack(
        [pair / np.maximum(context, 1), word / max(tokens, 1), np.full(len(word), 1.0 / (vocabulary + 1))], axis=1
    )


def _tuning_events(returned: DataFrame, tokens: int, vocabulary: int) -> DataFrame:
    """Of every block: buckets and estimates of the tuning fold's tokens, equal ones counted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row)
            _, word, pair = block.keys()
            rest = _sums(row, "training") - _sums(row, "tuning")
            # The context of a token is the token before it; an end token was seen once a document.
            before = np.r_[word[block.sizes[0] - 1], word[:-1]]
            chosen = block.tuning
            if not chosen.any():
                continue
            seen = np.stack([rest[before[chosen]], rest[pair[chosen]], rest[word[chosen]]], axis=1)
            event, times = np.unique(seen, axis=0, return_counts=True)
            context, *_ = event.T
            made = estimates(context.astype(float), event[:, 1].astype(float), event[:, 2].astype(float), tokens, vocabulary)
            columns = [shrink(bucket_of(context.astype(float)).astype(np.uint8)), shrink(times.astype(np.uint32))]
            columns += [shrink(np.ascontiguousarray(made[:, i])) for i in range(2)]
            yield pa.record_batch([pa.array([c], pa.binary()) for c in columns], names=["bucket", "times", "pair", "word"])

    return returned.mapInArrow(run, "bucket binary, times binary, pair binary, word binary")


def learn_weights(events: DataFrame, vocabulary: int) -> np.ndarray:
    """Mixture weights per bucket; each round is one pass over the stored events, until they hardly gain.

    A bucket without events takes the weights of all events together.
    """
    weights = np.tile(START, (BUCKETS, 1))
    even = 1.0 / (vocabulary + 1)

    def shares(weights: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((BUCKETS, 4))
            for row in _rows(batches):
                bucket, times = grown(row["bucket"], "u1"), grown(row["times"], "u4")
                parts = np.stack([grown(row["pair"], "f8"), grown(row["word"], "f8"), np.full(len(times), even)], axis=1)
                parts = parts * weights[bucket]
                whole = parts.sum(axis=1)
                total[:, 3] += np.bincount(bucket, weights=times * np.log(whole), minlength=BUCKETS)
                parts *= (times / whole)[:, None]
                for i in range(3):
                    total[:, i] += np.bincount(bucket, weights=parts[:, i], minlength=BUCKETS)
            columns = [pa.array(np.arange(BUCKETS)), *[pa.array(total[:, i]) for i in range(4)]]
            yield pa.record_batch(columns, names=["bucket", "pair", "word", "even", "log"])

        return run

    before = -np.inf
    for _ in range(MOST_ROUNDS):
        summed = events.mapInArrow(shares(weights), "bucket long, pair double, word double, even double, log double")
        found = summed.groupBy("bucket").agg(F.sum("pair"), F.sum("word"), F.sum("even"), F.sum("log")).collect()  # BUCKETS rows
        total, reached = np.zeros((BUCKETS, 3)), 0.0
        for row in found:
            total[row[0]], reached = row[1:4], reached + row[4]
        if not total.sum():
            return weights
        if (reached - before) / total.sum() < SETTLED:
            return weights
        before = reached
        total = np.where(total.sum(axis=1, keepdims=True) > 0, total, total.sum(axis=0))
        weights = np.maximum(total / total.sum(axis=1, keepdims=True), LEAST_WEIGHT)
        weights /= weights.sum(axis=1, keepdims=True)
    raise RuntimeError(f"the weights did not settle in {MOST_ROUNDS} rounds")


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(returned: DataFrame, weights: np.ndarray, tokens: int, vocabulary: int) -> DataFrame:
    """The scores of every document of the blocks, with the counts of all training documents."""
    floor = tokens + (vocabulary + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row)
            _, word, pair = block.keys()
            counts = _sums(row, "training").astype(np.float64)
            before = np.r_[word[block.sizes[0] - 1], word[:-1]]
            seen, context = counts[word], counts[before]
            mixed = (estimates(context, counts[pair], seen, tokens, vocabulary) * weights[bucket_of(context)]).sum(axis=1)
            per_doc = [
                np.add.reduceat(values, block.starts)
                for values in ((seen > 0).astype(np.int64), np.log10((seen + 1) / floor), np.log10(mixed))
            ]
            columns = [
                pa.array(block.doc_ids, mask=~block.known),
                pa.array(block.folds == HELD_OUT),
                pa.array(block.sizes),
                pa.array(per_doc[0]),
                pa.array(np.full(len(block.sizes), tokens)),
                pa.array(per_doc[1]),
                pa.array(per_doc[2]),
            ]
            yield pa.record_batch(columns, names=[part.split()[0] for part in SCORES.split(", ")])

    return returned.mapInArrow(run, SCORES)


def score(docs: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Fold, counts, unigram base score and model score of every whole text of ``docs``."""
    packed = stored(blocks(docs, block_words), "lm_blocks")
    sums = stored(summed_counts(sent_counts(packed, partitions(docs))), "lm_sums")
    whole = sums.agg(F.sum("vocabulary"), F.sum("tokens"), F.sum("rest")).first()
    vocabulary, tokens, rest = (int(value or 0) for value in whole)
    returned = returned_counts(packed, sums)
    weights = learn_weights(stored(_tuning_events(returned, rest, vocabulary), "lm_events"), vocabulary)
    return scores(returned, weights, tokens, vocabulary)
