"""How far the sources of a language diverge in their words, by hash-consed segment trees.

Words are counted per language and source in the tasks that read the texts; a language keeps the terms of at least
``LEAST_DOCS`` of its documents. Terms are numbered within their language in the order of their counts, so that
neighbours are alike, and cut into aligned blocks. In a block every source has a segment tree over the term ids:
leaves are counts, and subtrees with equal counts are one node, whichever source or place they stand at. The trees
of two sources are walked together from their roots; a pair of nodes met again is priced once and counted as often as
it was met. What arrives at the leaves are the distinct pairs of counts with their numbers.

The price of a term for a source against another, f = floor((p - q)^2 / q) of smoothed shares in billionths, is computed in
whole numbers. A word with a third of all occurrences is one row per task before the shuffle; a block is
bounded by terms times sources; blocks add up by pair of sources.

Defined cases: a null text, lang or source is read as empty; a source without kept terms has the smoothed shares of
no counts; a language without kept terms has pairs of value 0 and no terms; ties are ranked by the item; repeated
rows count as often as they are there; an empty table has no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import LOWER, UPPER, only, text_bytes
from lakemart.operators.ranking import global_row_number, top_n_per_group
from lakemart.session import stored

LEAST_DOCS = 3  # documents of its language a kept term is in
SCALE = 1_000_000_000  # shares are in billionths
TOP = 200  # terms told of each source; the feature of the part "term"
HELD = 400_000  # counts a task holds before it sends them on
CELLS = 1 << 19  # terms times sources of a block, at most (a block has 16 terms at least)
LARGEST = 1 << 12  # terms of a block


def _letters() -> bytes:
    """What each byte of a text is read as: A-Z in lower case, a-z and bytes past ASCII as they are, others as a space."""
    read = bytearray(b" " * 128 + bytes(range(128, 256)))
    for upper, lower in zip(UPPER.encode(), LOWER.encode(), strict=True):
        read[upper] = read[lower] = lower
    return bytes(read)


COUNTS = "lang string, source string, term string, count long, docs long"


def term_counts(docs: DataFrame) -> DataFrame:
    """count and docs of every term of each (lang, source); a row with a null term for each group."""
    letters = _letters()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[bytes, bytes], Counter] = {}
        found: dict[tuple[bytes, bytes], Counter] = {}

        def rows() -> pa.RecordBatch:
            keys = [(lang, source, term, n) for (lang, source), own in counts.items() for term, n in own.items()]
            of_docs = [found[lang, source][term] for lang, source, term, _ in keys]
            keys += [(lang, source, None, 0) for lang, source in counts]
            columns = [pa.array([key[i] for key in keys], pa.binary()).cast(pa.string()) for i in range(3)]
            numbers = [pa.array([key[3] for key in keys], pa.int64()), pa.array([*of_docs, *[0] * len(counts)], pa.int64())]
            return pa.record_batch([*columns, *numbers], names=["lang", "source", "term", "count", "docs"])

        held = 0
        for batch in batches:
            langs, sources, texts = (text_bytes(batch.column(i)) for i in range(3))
            for lang, source, text in zip(langs, sources, texts, strict=True):
                words = text.translate(letters).split()
                own = counts.setdefault((lang, source), Counter())
                before = len(own)
                own.update(words)
                found.setdefault((lang, source), Counter()).update(set(words))
                held += len(own) - before
                if held > HELD:
                    yield rows()
                    counts, found, held = {}, {}, 0
        if counts:
            yield rows()

    read = only(docs, "lang", "source", "text").mapInArrow(work, COUNTS)
    return read.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def cons(counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Segment trees of the rows of ``counts`` (sources by terms, a power of two of them), built from the leaves up.

    The values of the leaves, the (left, right) nodes of each node of every level from the roots down, and the
    root of each row. Equal subtrees of a level are one node.
    """
    values, nodes = np.unique(counts, return_inverse=True)
    nodes = nodes.reshape(counts.shape)
    levels = []
    while nodes.shape[1] > 1:
        wide = int(nodes.max()) + 1
        pairs, inverse = np.unique(nodes[:, ::2] * wide + nodes[:, 1::2], return_inverse=True)
        levels.append(np.stack([pairs // wide, pairs % wide], axis=1))
        nodes = inverse.reshape(len(counts), -1)
    return values, levels[::-1], nodes[:, 0]


def met(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The leaves that the trees of pairs of roots meet in: number of the pair of roots, both leaves, and how often.

    All pairs of roots go down together. Equal pairs of nodes of one pair of roots are one entry with a number.
    """
    which, times = np.arange(len(left)), np.ones(len(left), dtype=np.int64)
    for children in levels:
        which = np.concatenate([which, which])
        left, right = (np.concatenate([children[side, 0], children[side, 1]]) for side in (left, right))
        times = np.concatenate([times, times])
        order = np.lexsort((right, left, which))
        which, left, right, times = which[order], left[order], right[order], times[order]
        new = np.ones(len(which), dtype=bool)
        new[1:] = (which[1:] != which[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        times = np.add.reduceat(times, np.flatnonzero(new))
        which, left, right = which[new], left[new], right[new]
    return which, left, right, times


def share(counts: np.ndarray, whole: np.ndarray, terms: int) -> np.ndarray:
    """Smoothed shares in billionths; in whole numbers of any size where 64 bits may not do."""
    if len(counts) and int(counts.max()) >= (1 << 62) // SCALE:
        counts = counts.astype(object)
    return 1 + SCALE * (counts + 1) // (whole + terms)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _sides(sources: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of two sources, each once."""
    return np.triu_indices(sources, 1)


def block_pairs(counts: np.ndarray, whole: np.ndarray, terms: int, real: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Source, other source and the summed price over the ``real`` first columns of ``counts``.

    The columns after these only fill up the power of two; they hold no counts and their price is taken off.
    """
    values, levels, roots = cons(counts)
    one, two = _sides(len(counts))
    which, left, right, times = met(levels, roots[one], roots[two])
    own = share(values[left], whole[one[which]], terms)
    other = share(values[right], whole[two[which]], terms)
    zero = np.zeros(len(one), dtype=np.int64)
    bare, bare_other = share(zero, whole[one], terms), share(zero, whole[two], terms)
    extra = counts.shape[1] - real
    made = []
    for p, q, p0, q0 in ((own, other, bare, bare_other), (other, own, bare_other, bare)):
        summed = np.zeros(len(one), dtype=np.int64)
        np.add.at(summed, which, (price(p, q) * times).astype(np.int64))
        made.append(summed - extra * price(p0, q0))
    return np.concatenate([one, two]), np.concatenate([two, one]), np.concatenate(made)


def _vocabulary(counted: DataFrame) -> DataFrame:
    """lang, term, total, vector (source and count of each source that has it, in order) of the kept terms."""
    own = F.struct("source", "count")
    whole = counted.where("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("total"), F.array_sort(F.collect_list(own)).alias("vector")
    )
    return whole.where(F.col("docs") >= LEAST_DOCS).select("lang", "term", "total", "vector")


def _pairs(numbered: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """lang, source, item and the value of the terms, block by block and then summed."""
    size = max(16, min(LARGEST, 1 << (max(1, CELLS // max(most, 1)).bit_length() - 1)))
    cells = F.struct((F.col("id") % size).alias("at"), "vector")
    blocks = numbered.groupBy("lang", F.floor(F.col("id") / size).alias("block")).agg(F.collect_list(cells).alias("cells"))
    sources = groups.groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("source", "whole"))).alias("sources"), F.first("terms").alias("terms")
    )
    joined = blocks.join(sources, "lang").select("lang", "terms", "sources", "cells")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lang, terms = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                named = batch.column(2)[row].values
                names, whole = named.field(0).to_pylist(), named.field(1).to_numpy()
                place = {name: i for i, name in enumerate(names)}
                cells = batch.column(3)[row].values
                at, vectors = cells.field(0).to_numpy(), cells.field(1)
                lengths = vectors.value_lengths().to_numpy()
                flat = vectors.flatten()
                wide = 1 << max(0, (len(at) - 1).bit_length())
                counts = np.zeros((len(names), wide), dtype=np.int64)
                # Ids of a block run from 0 to its number of terms less one.
                rows_ = np.array([place[name] for name in flat.field(0).to_pylist()], dtype=np.int64)
                counts[rows_, np.repeat(at, lengths)] = flat.field(1).to_numpy()
                source, other, value = block_pairs(counts, whole, terms, len(at))
                labels = pa.array(names, pa.string())
                yield pa.record_batch(
                    [pa.array([lang] * len(source), pa.string()), labels.take(pa.array(source)), labels.take(pa.array(other)), pa.array(value)],
                    names=["lang", "source", "item", "value"],
                )

    priced = joined.mapInArrow(work, "lang string, source string, item string, value long")
    return priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _exact_share(count: Column, whole: Column, terms: Column) -> Column:
    """The smoothed share in billionths, in decimals of no digits after the point."""
    over = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + F.call_function("div", over, (whole + terms).cast("decimal(20,0)"))


def _terms(numbered: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value and rank of the terms a source has more often than its language."""
    each = numbered.select("lang", "term", "total", F.explode("vector").alias("own"))
    met_ = each.select("lang", "term", "total", "own.source", "own.count").join(groups, ["lang", "source"])
    p = _exact_share(F.col("count"), F.col("whole"), F.col("terms"))
    q = _exact_share(F.col("total"), F.col("lang_whole"), F.col("terms"))
    shares = met_.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    valued = shares.select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    return top_n_per_group(valued, ["lang", "source"], [F.desc("value"), F.asc("item")], TOP)


def divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank: other sources by divergence, and telling terms."""
    counted = stored(term_counts(docs), "term_counts")
    kept = stored(_vocabulary(counted), "vocabulary")
    ranked = stored(global_row_number(kept, [F.col("lang"), F.col("vector"), F.col("term")], "_rank"), "ranked_terms")
    by_lang = ranked.groupBy("lang").agg(F.min("_rank").alias("first"), F.count("*").alias("terms"), F.sum("total").alias("lang_whole"))
    numbered = stored(
        ranked.join(by_lang, "lang").select("lang", "term", "total", "vector", (F.col("_rank") - F.col("first")).alias("id")), "numbered_terms"
    )
    own = numbered.select("lang", F.explode("vector").alias("v")).groupBy("lang", "v.source").agg(F.sum("v.count").alias("whole"))
    every = counted.where("term IS NULL").select("lang", "source")
    groups = stored(
        every.join(own, ["lang", "source"], "left")
        .join(by_lang.drop("first"), "lang", "left")
        .na.fill(0, ["whole", "terms", "lang_whole"]),
        "sources_of_languages",
    )
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    priced = _pairs(numbered, groups, most)
    # One row per source and other source of its language: the result itself has that many.
    others = groups.select("lang", F.col("source").alias("item"))
    wanted = groups.select("lang", "source").join(others, "lang").where("source <> item")
    valued = wanted.join(priced, ["lang", "source", "item"], "left").na.fill(0, ["value"])
    pairs = top_n_per_group(valued, ["lang", "source"], [F.desc("value"), F.asc("item")], max(most, 1))
    both = [part.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")) for name, part in (("pair", pairs), ("term", _terms(numbered, groups)))]
    return both[0].unionByName(both[1])
