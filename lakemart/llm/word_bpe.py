"""BPE encoding and decoding with a word-end vocabulary, by batched numpy merge rounds.

Texts are cut into pieces at spaces and marks; those of a batch that have not been met before are normalised, cut
into words and merged together. The symbols of all these words lie in one flat array. Every round looks
all neighbouring pairs up by binary search over the sorted pair keys, finds the lowest rank of each word
and merges its pairs of that rank, from left to right. Words without a mergeable pair leave the array.

The vocabulary file is that of a public tokenizer: NFC, lower case, words by a fixed pattern, bytes as
printable characters, ``</w>`` at word ends. Its path is a parameter; nothing is trained.

Defined cases: a null or empty text has no ids and decodes to the empty text; strings of the special
tokens in a text become their ids; repeated rows are encoded alike; a null doc_id passes through; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from lakemart.llm.common import Remembered, by_size, cut, only, ragged

# Fixed values of the tokenizer: white space, and its word pattern.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
WORD_END = "</w>"
CACHE = 150_000  # pieces of a generation; a worker remembers two


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else one from 256 on."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


class WordBpe:
    """The vocabulary, and what this worker has already encoded."""

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as opened:
            model = json.load(opened)
        vocab = model["model"]["vocab"]
        self.special = {token["content"]: token["id"] for token in model["added_tokens"]}
        self.token = np.array([""] * (1 + max([*vocab.values(), *self.special.values()])), dtype=object)
        self.decimal = np.array([str(number) for number in range(len(self.token))], dtype=object)
        for text, number in [*vocab.items(), *self.special.items()]:
            self.token[number] = text
        characters = byte_characters()
        self.inner = np.array([vocab.get(c, -1) for c in characters], dtype=np.int64)
        self.final = np.array([vocab.get(c + WORD_END, -1) for c in characters], dtype=np.int64)
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["model"]["merges"]]
        self.size = np.int64(len(self.token))
        keys = np.array([vocab[a] * int(self.size) + vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.pattern = regex.compile(WORDS)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known = Remembered(CACHE, self.learned)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, four bytes each, all merged together."""
        if not words:
            return []
        sizes = np.array([len(word) for word in words])
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        word = np.repeat(np.arange(len(words)), sizes)
        symbol = self.inner[flat]
        last = np.cumsum(sizes) - 1
        symbol[last] = self.final[flat[last]]
        done_word, done_symbol = [], []
        none = len(self.keys)
        while len(symbol):
            pair = symbol[:-1] * self.size + symbol[1:]
            inside = (word[:-1] == word[1:]) & (symbol[:-1] >= 0) & (symbol[1:] >= 0)
            at = np.minimum(np.searchsorted(self.keys, pair), none - 1)
            rank = np.append(np.where(inside & (self.keys[at] == pair), self.ranks[at], none), none)
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            length = np.diff(np.r_[start, len(word)])
            lowest = np.repeat(np.minimum.reduceat(rank, start), length)
            over = lowest == none
            if over.any():  # these words are finished
                done_word.append(word[over])
                done_symbol.append(symbol[over])
                word, symbol, rank, lowest = word[~over], symbol[~over], rank[~over], lowest[~over]
                if not len(symbol):
                    break
            here = rank == lowest
            # Of a run of overlapping pairs every second one merges, from the left.
            position = np.arange(len(here))
            run = np.maximum.accumulate(np.where(here & ~np.r_[False, here[:-1]], position, 0))
            here &= (position - run) % 2 == 0
            symbol[here] = self.made[rank[here]]
            stays = ~np.r_[False, here[:-1]]
            word, symbol = word[stays], symbol[stays]
        word, symbol = np.concatenate(done_word), np.concatenate(done_symbol)
        known = symbol >= 0
        word, symbol = word[known], symbol[known]
        order = np.argsort(word, kind="stable")
        ids = symbol[order].astype("<i4").tobytes()
        bounds = (4 * np.searchsorted(word[order], np.arange(len(words) + 1))).tolist()
        return [ids[at:end] for at, end in zip(bounds[:-1], bounds[1:], strict=True)]

    def _parts(self, piece: str) -> list[bytes | str]:
        """The words of a piece in UTF-8, and the special tokens in it."""
        bare = piece.lstrip(" ")
        if bare.isascii() and bare.isalpha():
            return [bare.lower().encode()]
        out: list[bytes | str] = []
        for part in self.specials.split(piece) if self.specials else [piece]:
            if part in self.special:
                out.append(part)
            elif part:
                # Lower case by character: no rule looks at the neighbours.
                lowered = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out.extend([word.encode() for word in self.pattern.findall(lowered)])
        return out

    def learned(self, pieces: list[str]) -> Iterator[bytes]:
        """The ids of the pieces, four bytes each, all merged together."""
        parts = [self._parts(piece) for piece in pieces]
        words = list(dict.fromkeys(part for each in parts for part in each if isinstance(part, bytes)))
        ids_of: dict[bytes | str, bytes] = dict(zip(words, self.merge(words), strict=True))
        ids_of.update((text, struct.pack("<i", number)) for text, number in self.special.items())
        for each in parts:
            yield ids_of[each[0]] if len(each) == 1 else b"".join([ids_of[part] for part in each])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many there are before each text and in all."""
        distinct, pieces, per_text = cut(column)
        made = self.known(distinct)
        sizes = np.array([len(ids) // 4 for ids in made], dtype=np.int64)
        ids = ragged(np.frombuffer(b"".join(made), dtype="<i4"), sizes, pieces)
        before = np.r_[0, np.cumsum(sizes[pieces])]
        return ids, before[np.r_[0, np.cumsum(per_text)]]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[str]:
        """Of each text the tokens of its ids, joined by a space."""
        return joined(self.token, ids, ends)


def joined(names: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> Iterator[str]:
    """The names of the ids of each text, joined by a space."""
    found = names[ids].tolist()
    for at, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield " ".join(found[at:end])


@lru_cache(maxsize=2)
def _loaded(name: str) -> WordBpe:
    return WordBpe(SparkFiles.get(name))


def _vocabulary(docs: DataFrame, file: str) -> str:
    """The vocabulary file sent to every executor; its name there."""
    docs.sparkSession.sparkContext.addFile(file)
    return file.rsplit("/", 1)[-1]


BYTES_AT_ONCE = 4 << 20  # of text encoded together


def encode(docs: DataFrame, file: str) -> DataFrame:
    """doc_id, n_tokens, ids (array) and decoded of every whole text."""
    name = _vocabulary(docs, file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1, BYTES_AT_ONCE):
                ids, ends = _loaded(name).encode(part.column(1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                decoded = pa.array(_loaded(name).decode(ids, ends), pa.string())
                columns = [part.column(0).cast(pa.int64()), pa.array(np.diff(ends)), lists, decoded]
                yield pa.record_batch(columns, names=["doc_id", "n_tokens", "ids", "decoded"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded string")


def digests(docs: DataFrame, file: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (decimal, joined by a space) and of the decoded text.

    The ids and decoded texts stay in the task.
    """
    name = _vocabulary(docs, file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1, BYTES_AT_ONCE):
                ids, ends = _loaded(name).encode(part.column(1))
                columns = [part.column(0).cast(pa.int64()), pa.array(np.diff(ends))]
                for texts in (joined(_loaded(name).decimal, ids, ends), _loaded(name).decode(ids, ends)):
                    columns.append(pa.array([sha256(text.encode()).hexdigest() for text in texts], pa.string()))
                yield pa.record_batch(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return only(docs, "doc_id", "text").mapInArrow(run, schema)
