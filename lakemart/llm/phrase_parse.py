"""Passages that repeat across a corpus, found by prefix-free parsing of its texts.

Rolling hashes choose triggers: of every ``LONG`` bytes the ``WIDE`` bytes with the least hash (the first of equal ones), so
that equal strings of ``LONG`` bytes have their trigger at the same place. The phrase of a trigger is the text
of all the strings that have it. The parse of a text is the sequence of its phrases; the dictionary holds each distinct
phrase once, with its first place in the corpus (by doc_id, then by byte). In highly repetitive text nearly all
phrases are in the dictionary already, and every string of a phrase that is not at its first place starts earlier too.

What is left are different phrases with one trigger. Their suffixes come in corpus order from two suffix arrays: what
stands left of the trigger, read backwards, which orders the suffixes within the dictionary, and what stands from
the trigger on, which orders how the parse goes on. Both are sorted with the common prefixes of neighbours, and the
strings that start d bytes before the trigger are equal where d bytes agree in the first and LONG - d in
the second. Of each class the first place in the corpus stays.

Equal phrases of a batch of texts go on as one row, so a passage in a third of all documents is one row per
batch. A trigger with many phrases in a batch is dealt out by phrase, and one row tells its home of it. A trigger with
more than ``CROWD`` phrases left is compared by the hashes of its strings, combined in the tasks first. No string is dropped.

Defined cases: a null text is empty; matches never cross documents; a null doc_id counts as the least one; rows that
share a doc_id are ordered by the hash of their text; of equal rows the first keeps what the others lose; a text shorter
than ``LONG`` bytes loses nothing; an empty table has no rows. Strings are compared by 128 bits of hashes (a trigger
and its phrase), those of different phrases byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import by_size, only, partitions, text_bytes
from lakemart.session import stored

LONG = 100  # bytes of a repeated string
WIDE = 24  # bytes a trigger is chosen by
REACH = LONG - WIDE  # a trigger stands at most so far behind the start of a string
BATCH = 2 << 20  # bytes of text worked on at once
LOCAL = 4  # phrases of one trigger that a batch sends to one task
COPIES = 100_000  # equal rows written out by one task
CROWD = 20_000  # phrases of one trigger that are sorted in one task
LEAST = -(1 << 63)  # stands for a null doc_id

PHRASE, DEALT, NOTICE, MARK, ASKED = range(5)  # kinds of rows
ROWS = "tau long, ctx long, doc long, mark long, place long"
FOUND = "tau long, doc long, mark long, place long"


def _mixed(x: np.ndarray) -> np.ndarray:
    """The bits of 64-bit numbers spread over all places."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@cache
def _base(seed: int) -> tuple[np.ndarray, int]:
    """Odd numbers for the bytes, and the odd base of a rolling hash."""
    with np.errstate(over="ignore"):
        made = _mixed(np.arange(1, 258, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)
    return made[:256], int(made[256])


class Rolling:
    """Hashes of any pieces of a run of bytes, equal for equal pieces wherever they stand."""

    _powers: dict[int, np.ndarray] = {}

    def __init__(self, content: np.ndarray, seed: int) -> None:
        numbers, base = _base(seed)
        self.up = self._power(base, len(content) + 1)
        down = self._power(pow(base, -1, 1 << 64), len(content) + 1)
        self.sums = np.zeros(len(content) + 1, dtype=np.uint64)
        np.cumsum(numbers[content] * down[: len(content)], out=self.sums[1:])

    @classmethod
    def _power(cls, base: int, n: int) -> np.ndarray:
        known = cls._powers.get(base)
        if known is None or len(known) < n:
            powers = np.full(n, base, dtype=np.uint64)
            powers[:1] = 1
            known = np.cumprod(powers)
            if n <= 2 * BATCH:  # those of a very long text are not kept
                cls._powers[base] = known
        return known

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.up[start])


def _every(content: np.ndarray, roll: Rolling) -> np.ndarray:
    """Hashes of all pieces of WIDE bytes."""
    n = len(content) - WIDE + 1
    return _mixed((roll.sums[WIDE:] - roll.sums[:n]) * roll.up[:n])


def parse(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """The phrases of the texts: tau and ctx (hashes of trigger and phrase), text, trigger, first and last string.

    Trigger and strings are places in the texts joined; the last string ends the phrase.
    """
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    content = np.frombuffer(b"".join(texts), dtype=np.uint8)
    fits = np.flatnonzero(sizes >= LONG)
    none = np.zeros(0, dtype=np.int64)
    if not len(fits):
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    roll, second = Rolling(content, 1), Rolling(content, 2)
    every = _every(content, roll)
    bits = np.uint64(len(content).bit_length())
    least = (every >> bits << bits) | np.arange(len(every), dtype=np.uint64)
    span = 1
    while span <= REACH:  # the least of REACH + 1 neighbours, by doubling
        step = min(span, REACH + 1 - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    trigger = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    new = np.zeros(len(trigger) + 1, dtype=bool)
    new[1:-1] = trigger[1:] != trigger[:-1]
    new[starts[fits]] = True
    beyond = starts[fits] + sizes[fits] - LONG + 1
    new[beyond[beyond < len(new)]] = True
    first = np.flatnonzero(new[:-1])
    last = np.append(first[1:], len(trigger)) - 1
    of = np.searchsorted(starts, first, "right") - 1
    inside = first + LONG <= starts[of] + sizes[of]  # runs between the last string of a text and the next text go
    first, last, of = first[inside], last[inside], of[inside]
    at = trigger[first]
    shape = ((at - first) * 256 + (at - last)).astype(np.uint64)
    ctx = _mixed(second(first, last + LONG) + shape * np.uint64(0x9E3779B97F4A7C15))
    return every[at], ctx, of, at, first, last


def _place(kind: int, trigger: np.ndarray, before: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Kind, byte of the trigger in its text, and the first and last string as bytes before it, in one number."""
    return (np.int64(kind) << 60) | (trigger << 16) | (before << 8) | least


def _kind(place: np.ndarray) -> np.ndarray:
    return place >> 60


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (place >> 16) & ((1 << 44) - 1), (place >> 8) & 255, place & 255


def _record(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.record_batch([pa.array(column.astype(np.int64, copy=False)) for column in columns], names=names)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a row of sorted keys differs from the one before."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return new


def _numbers(docs: DataFrame) -> DataFrame:
    """doc, mark and text of every row: what stands for the doc_id, and the hash that tells texts of one doc_id apart."""
    own = only(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    return own.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("doc"), F.xxhash64("text").alias("mark"), "text")


def _distinct(numbered: DataFrame) -> DataFrame:
    """Each text of a doc_id once, and how many rows it has."""
    return numbered.groupBy("doc", "mark").agg(F.first("text").alias("text"), F.count("*").alias("copies"))


def _phrases(numbered: DataFrame) -> DataFrame:
    """The phrases of each batch, equal ones once; what repeats within the batch is a mark already."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, marks = (batch.column(i).to_numpy() for i in (0, 1))
        texts = text_bytes(batch.column(2))
        order = np.lexsort((marks, ids))
        ids, marks, texts = ids[order], marks[order], [texts[i] for i in order]
        starts = np.cumsum([0, *map(len, texts)])[:-1]
        tau, ctx, of, at, first, last = parse(texts)
        tau, ctx = tau.view(np.int64), ctx.view(np.int64)
        where, before, least = at - starts[of], at - first, at - last
        row = np.lexsort((where, of, ctx, tau))
        tau, ctx, of, where, before, least = (x[row] for x in (tau, ctx, of, where, before, least))
        doc, mark = ids[of], marks[of]
        new = _starts(tau, ctx)
        lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, dtype=np.int64)
        equal_row = ~new & (doc == doc[lead]) & (mark == mark[lead]) & (where == where[lead])
        again = ~new & ~equal_row
        trigger = _starts(tau)
        group = np.cumsum(trigger) - 1
        crowded = np.bincount(group, weights=new, minlength=1)[group] > LOCAL if len(group) else new
        kind = np.where(again, MARK, np.where(crowded, DEALT, PHRASE)).astype(np.int64)
        place = (kind << 60) | _place(0, where, before, least)
        goes = ~equal_row
        notice = np.flatnonzero(trigger & crowded)
        blank = np.zeros(len(notice), dtype=np.int64)
        columns = [np.concatenate([x[goes], y]) for x, y in ((tau, tau[notice]), (ctx, blank), (doc, blank), (mark, blank), (place, blank + (NOTICE << 60)))]
        return _record(ROWS, *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in by_size(batch, 2, BATCH):
                    yield work(part)

    return numbered.mapInArrow(run, ROWS)


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Sorted rows as tables that end with a group of equal ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        last = int(np.searchsorted(values, values[-1], "left"))
        if last or (held and held[0].column(key)[0].as_py() != values[0]):
            # The rows held are one group; it goes on with the rows before the last group of this batch.
            held.append(batch.slice(0, last))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _dictionary(phrases: DataFrame) -> DataFrame:
    """Marks of the phrases that are not at their first place, and the phrases asked for: those that share a trigger."""
    kind = F.shiftright("place", 60)
    home = F.when(kind == DEALT, F.xxhash64("tau", "ctx")).when(kind == MARK, F.xxhash64("mark", "place")).otherwise(F.col("tau"))
    trigger = F.when(kind == MARK, F.lit(LEAST)).otherwise(F.col("tau")).alias("tau")
    dealt = phrases.repartition(partitions(phrases), home).select(trigger, "ctx", "doc", "mark", "place")
    order = ["tau", "ctx", "doc", "mark", F.col("place").bitwiseAND((1 << 60) - 1)]
    met = dealt.sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 0):
            tau, ctx, doc, mark, place = (column.to_numpy() for column in table.columns)
            known = _kind(place) == MARK
            if known.all():
                yield _record(FOUND, tau, doc, mark, place)
                continue
            kinds, bare = _kind(place), place & ((1 << 60) - 1)
            notice = kinds == NOTICE
            trigger = _starts(tau)
            group = np.cumsum(trigger) - 1
            new = _starts(tau, ctx, notice) & ~notice & ~known
            lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            equal_row = (doc == doc[lead]) & (mark == mark[lead]) & (bare == bare[lead])
            n_of = np.bincount(group, weights=new)
            told = np.bincount(group, weights=(notice | (kinds == DEALT)))
            shared = (n_of[group] > 1) | (told[group] > 0)
            again = ~new & ~notice & ~known & ~equal_row
            out = again | known | (new & shared)
            kind = np.where(new & shared, ASKED, MARK).astype(np.int64)
            yield _record(FOUND, tau[out], doc[out], mark[out], ((kind << 60) | bare)[out])

    return met.mapInArrow(run, FOUND)


TEXTS = "tau long, doc long, mark long, place long, left binary, right binary, one long, two long"


def _asked_texts(numbered: DataFrame, found: DataFrame) -> DataFrame:
    """The text of each phrase asked for, left (read backwards) and right of its trigger.

    Of crowded triggers the strings themselves, as hashes, each once a batch; ``place`` is then that of the string.
    """
    asked = found.where(F.shiftright("place", 60) == ASKED)
    crowds = asked.groupBy("tau").count().where(F.col("count") > CROWD).select("tau", F.lit(True).alias("crowd"))
    marked = asked.join(crowds, "tau", "left")
    wanted = marked.groupBy("doc", "mark").agg(F.collect_list(F.struct("tau", "place", F.coalesce("crowd", F.lit(False)).alias("crowd"))).alias("asked"))
    joined = _distinct(numbered).join(wanted, ["doc", "mark"]).select("doc", "mark", "text", "asked")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_bytes(batch.column(2))
        lists = batch.column(3)
        of = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        flat = lists.flatten()
        tau, place = flat.field(0).to_numpy(), flat.field(1).to_numpy()
        crowd = flat.field(2).to_numpy(zero_copy_only=False).astype(bool)
        ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        where, before, least = _unpacked(place)
        few = np.flatnonzero(~crowd)
        left, right = [], []
        for i in few:
            text, t = texts[of[i]], where[i]
            left.append(text[t - before[i] : t][::-1])
            right.append(text[t : t - least[i] + LONG])
        zero = np.zeros(len(few), dtype=np.int64)
        made = [tau[few], ids[of[few]], marks[of[few]], place[few]]
        many = np.flatnonzero(crowd)
        if len(many):
            doc, mark, at, one, two = _strings(texts, ids, marks, of[many], where[many], before[many], least[many])
            fresh = [np.full(len(doc), LEAST), doc, mark, at]
            made = [np.concatenate(pair) for pair in zip(made, fresh, strict=True)]
            left, right = [*left, *[None] * len(doc)], [*right, *[None] * len(doc)]
            zero, second = np.concatenate([zero, one]), np.concatenate([zero, two])
        else:
            second = zero
        columns = [*[pa.array(x) for x in made], pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(zero), pa.array(second)]
        return pa.record_batch(columns, names=[field.split()[0] for field in TEXTS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in by_size(batch, 2, BATCH):
                    yield work(part)

    return joined.mapInArrow(run, TEXTS)


def _strings(
    texts: list[bytes], ids: np.ndarray, marks: np.ndarray, of: np.ndarray, where: np.ndarray, before: np.ndarray, least: np.ndarray
) -> tuple[np.ndarray, ...]:
    """All strings of the phrases as hashes, equal ones of the batch once: what repeats in it is a mark."""
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    content = np.frombuffer(b"".join(texts), dtype=np.uint8)
    wide = before - least + 1
    ends = np.cumsum(wide)
    start = np.repeat(where - before - ends + wide, wide) + np.arange(ends[-1])
    text = np.repeat(of, wide)
    at = starts[text] + start
    one, two = (Rolling(content, seed)(at, at + LONG).view(np.int64) for seed in (3, 4))
    doc, mark = ids[text], marks[text]
    row = np.lexsort((start, mark, doc, two, one))
    one, two, doc, mark, start = (x[row] for x in (one, two, doc, mark, start))
    new = _starts(one, two)
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    same_row = ~new & (doc == doc[lead]) & (mark == mark[lead]) & (start == start[lead])
    kind = np.where(new, ASKED, MARK).astype(np.int64)
    goes = ~same_row
    return doc[goes], mark[goes], ((kind << 60) | (start << 16))[goes], one[goes], two[goes]


def _words(texts: list[bytes], wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as rows of ``wide`` bytes filled up with zeros, the same as numbers in their order, and their lengths."""
    whole = -(-wide // 8) * 8
    lengths = np.array([len(text) for text in texts], dtype=np.int64)
    rows = np.frombuffer(b"".join(text.ljust(whole, b"\0") for text in texts), dtype=np.uint8).reshape(-1, whole)
    return rows, rows.view(">u8").astype(np.uint64), lengths


def suffix_array(group: np.ndarray, texts: list[bytes], wide: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the texts within their groups, and how many bytes each shares with the one before it (-1: new group)."""
    rows, words, lengths = _words(texts, wide)
    order = np.lexsort((lengths, *words.T[::-1], group))
    same = rows[order[1:]] == rows[order[:-1]]
    shared = np.where(same.all(axis=1), wide, np.argmin(same, axis=1))
    shared = np.minimum(shared, np.minimum(lengths[order[1:]], lengths[order[:-1]]))
    shared[group[order[1:]] != group[order[:-1]]] = -1
    return order, np.concatenate([[-1], shared])


def repeated(group: np.ndarray, rank: np.ndarray, before: np.ndarray, least: np.ndarray, left: list[bytes], right: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """For d bytes before the trigger: the rows whose string there also starts at a row of lower ``rank``.

    Rows come in the order of ``rank``; equal ranks are one place.
    """
    order_left, shared_left = suffix_array(group, left, REACH)
    order_right, shared_right = suffix_array(group, right, LONG)
    n = len(group)
    classes = np.empty((2, n), dtype=np.int64)
    for d in range(int(least.min()), int(before.max()) + 1):
        rows = np.flatnonzero((least <= d) & (d <= before))
        if len(rows) < 2:
            continue
        classes[0, order_left] = np.cumsum(shared_left < d)
        classes[1, order_right] = np.cumsum(shared_right < LONG - d)
        key = classes[0, rows] * (n + 1) + classes[1, rows]
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        later = rows[rank[rows] > rank[rows[first[inverse]]]]
        if len(later):
            yield d, later


MARKS = "doc long, mark long, start long, end long"


def _compared(texts: DataFrame) -> DataFrame:
    """Marks of the strings of phrases that share their trigger, from the order of the suffixes."""
    spread = texts.where("left IS NOT NULL").select("tau", "doc", "mark", "place", "left", "right")
    met = spread.repartition(partitions(texts), "tau").sortWithinPartitions("tau", "doc", "mark", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 0):
            tau, doc, mark, place = (table.column(i).to_numpy() for i in range(4))
            where, before, least = _unpacked(place)
            group = np.cumsum(_starts(tau)) - 1
            order = np.lexsort((where, mark, doc))
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.cumsum(_starts(doc[order], mark[order], where[order]))
            left, right = (table.column(i).to_pylist() for i in (4, 5))
            left, right = [left[i] for i in order], [right[i] for i in order]
            columns = [x[order] for x in (group, rank, before, least)]
            ids, marks, at = doc[order], mark[order], where[order]
            found = [(rows, at[rows] - d) for d, rows in repeated(*columns, left, right)]
            if found:
                rows = np.concatenate([r for r, _ in found])
                start = np.concatenate([s for _, s in found])
                yield _record(MARKS, *_joined(ids[rows], marks[rows], start, start + LONG))

    return met.mapInArrow(run, MARKS)


def _joined(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of one length that overlap, as one."""
    order = np.lexsort((start, mark, doc))
    doc, mark, start, end = (x[order] for x in (doc, mark, start, end))
    new = _starts(doc, mark)
    new[1:] |= start[1:] > end[:-1]
    at = np.flatnonzero(new)
    return doc[at], mark[at], start[at], end[np.append(at[1:], len(new)) - 1]


def _crowded(texts: DataFrame) -> DataFrame:
    """Marks of the strings of crowded triggers: all but the first place of equal hashes."""
    asked = texts.where("left IS NULL").select("one", "two", "doc", "mark", "place")
    is_mark = F.shiftright("place", 60) == MARK
    start = F.shiftright("place", 16).bitwiseAND((1 << 44) - 1)
    known = asked.where(is_mark).select("doc", "mark", start.alias("start"), (start + LONG).alias("end"))
    met = asked.where(~is_mark).repartition(partitions(texts), "one").sortWithinPartitions("one", "two", "doc", "mark", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 0):
            one, two, doc, mark, place = (column.to_numpy() for column in table.columns)
            new = _starts(one, two)
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = ~new & ((doc != doc[lead]) | (mark != mark[lead]) | (place != place[lead]))
            begin = _unpacked(place)[0][later]
            yield _record(MARKS, doc[later], mark[later], begin, begin + LONG)

    return known.unionByName(met.mapInArrow(run, MARKS))


def _marked(found: DataFrame) -> DataFrame:
    """The spans of the phrases that are marked as a whole."""
    byte = F.shiftright("place", 16).bitwiseAND((1 << 44) - 1)
    before, least = (F.shiftright("place", by).bitwiseAND(255) for by in (8, 0))
    own = found.where(F.shiftright("place", 60) == MARK)
    return own.select("doc", "mark", (byte - before).alias("start"), (byte - least + LONG).alias("end"))


def spans(docs: DataFrame) -> DataFrame:
    """doc, mark, text, the spans (start, end in bytes; they may overlap) and the number of rows of every text."""
    numbered = _numbers(docs)
    found = stored(_dictionary(_phrases(numbered)), "phrases_found")
    texts = stored(_asked_texts(numbered, found), "phrases_asked")
    marks = _marked(found).unionByName(_compared(texts)).unionByName(_crowded(texts))
    listed = marks.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return _distinct(numbered).join(listed, ["doc", "mark"], "left").select("doc", "copies", "text", "spans")


def _cut(spans_of: DataFrame, name: str, kind: str, value: Callable[[bytes], object]) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans of every row, and as ``name`` the ``value`` of the bytes that stay.

    Of equal rows the first stays as it is; the others lose all their bytes if they have ``LONG`` of them.
    """
    schema = f"doc long, copies long, n_bytes long, n_removed long, n_spans long, {name} {kind}, nothing {kind}"
    types = {"string": pa.string(), "binary": pa.binary()}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        lists = batch.column(3)
        for row, text in enumerate(text_bytes(batch.column(2))):
            found = lists[row]
            if not found.is_valid:
                made.append((len(text), 0, 0, value(text)))
                continue
            start, end = (found.values.field(i).to_numpy() for i in (0, 1))
            depth = np.bincount(start, minlength=len(text) + 1) - np.bincount(end, minlength=len(text) + 1)
            gone = np.cumsum(depth)[:-1] > 0
            begun = gone.copy()
            begun[1:] &= ~gone[:-1]
            stays = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            made.append((len(text), int(gone.sum()), int(begun.sum()), value(stays)))
        numbers = [pa.array([m[i] for m in made], pa.int64()) for i in range(3)]
        ends = [pa.array([m[3] for m in made], types[kind]), pa.array([value(b"")] * len(made), types[kind])]
        return pa.record_batch([batch.column(0), batch.column(1), *numbers, *ends], names=[f.split()[0] for f in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 2, 4 * BATCH):
                yield work(part)

    cut = spans_of.mapInArrow(run, schema)
    lost = F.col("n_bytes") >= LONG
    gone = [F.when(lost, F.col("n_bytes")).otherwise(0).alias("n_removed"), F.when(lost, 1).otherwise(0).alias("n_spans")]
    further = cut.where("copies > 1").select(
        "doc", "n_bytes", *gone, F.when(lost, F.col("nothing")).otherwise(F.col(name)).alias(name), (F.col("copies") - 1).alias("more")
    )
    # Many copies of one row are written out by many tasks.
    step = F.lit(COPIES).cast("long")
    pieces = further.withColumn("start", F.explode(F.sequence(F.lit(1).cast("long"), F.col("more"), step)))
    spread = pieces.repartition(partitions(cut), "doc", "start")
    again = spread.select("*", F.explode(F.sequence(F.col("start"), F.least(F.col("start") + step - 1, "more"))))
    columns = [F.when(F.col("doc") != LEAST, F.col("doc")).alias("doc_id"), "n_bytes", *[F.col(n).cast("long").alias(n) for n in ("n_removed", "n_spans")], name]
    return cut.select(*columns).unionByName(again.select(*columns))


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 (of the bytes that stay) of every row of ``docs``."""
    return _cut(spans(docs), "kept_sha256", "string", lambda text: hashlib.sha256(text).hexdigest())


def kept_bytes(docs: DataFrame) -> DataFrame:
    """The same with the bytes that stay themselves, as ``kept``; they need not be whole characters."""
    return _cut(spans(docs), "kept", "binary", lambda text: text)
