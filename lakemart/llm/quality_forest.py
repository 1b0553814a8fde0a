"""Quality rules: rule statistics of every document, and an isolation forest that finds odd ones.

``statistics`` counts, per whole text, what the rules look at. ``fit_forest`` grows random split trees on
a bounded sample of rows labelled good; odd documents are cut off after few splits, or for lying outside of
what a node holds. ``calibrate`` picks the
score beyond which a document counts as odd from all labelled rows. ``judge`` joins the two verdicts.

Defined cases: a null text counts as empty, and an empty or wordless text fails the base rule; a null
doc_id is judged like any other; repeated rows give repeated results; without labels of both kinds
nothing but the base rule rejects; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_batches, named, only, per_row, text_bytes
from lakemart.session import stored

# White space between words, and the symbols that count.
SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUATION = bytes(range(0x80, 0xC0))  # a code point has one byte that is not one of these

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_capitals")
SCHEMA = "doc_id long, digest binary, " + ", ".join(f"{name} long" for name in COUNTS)

TREES = 100  # trees of the forest
TREE_ROWS = 256  # rows each tree is grown on; together they bound the sample of labelled rows
GOOD_COST = 20.0  # rejecting a good document costs as much as keeping so many bad ones
BINS = 10_000  # steps of the score between 0 and 1 in which thresholds are tried


def _repeated_words(words: list[bytes]) -> int:
    """Words in a window of three words that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    code = np.array([known.setdefault(word, len(known)) for word in words], dtype=np.int64)
    pair = code[:-1] * len(known) + code[1:]
    if len(known) > 2_000_000:  # three codes would not fit one number
        pair = np.unique(pair, return_inverse=True)[1]
    _, place, times = np.unique(pair[:-1] * len(known) + code[2:], return_inverse=True, return_counts=True)
    twice = times[place] > 1
    if not twice.any():
        return 0
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= twice
    return int(covered.sum())


def _repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def text_counts(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = text.split()  # on the six white space bytes
    size = len(text)
    return (
        len(words),
        len(text.translate(None, SPACES + CONTINUATION)),
        size - len(text.translate(None, SYMBOLS)),
        _repeated_lines(text),
        _repeated_words(words),
        text.count(b"!"),
        size - len(text.translate(None, CAPITALS)),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, SHA-256 and the counts of every whole text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_bytes(batch.column(1))
        made = pa.array([hashlib.sha256(text).digest() for text in texts], pa.binary())
        counts = np.array([text_counts(text) for text in texts], dtype=np.int64).reshape(-1, len(COUNTS))
        return pa.record_batch(
            [batch.column(0).cast(pa.int64()), made, *[pa.array(column) for column in counts.T]],
            names=["doc_id", "digest", *COUNTS],
        )

    return map_batches(only(docs, "doc_id", "text"), SCHEMA, work)


def features(counts: np.ndarray) -> np.ndarray:
    """What the forest splits on, one row per document; counts in the order of ``COUNTS``.

    Shares of symbols, exclamation marks and capitals are stretched near zero, where clean text lies.
    """
    counts = counts.astype(np.float64)
    words, chars = np.maximum(counts[:, 0], 1), np.maximum(counts[:, 1], 1)
    shares = np.stack([counts[:, 2] / words, counts[:, 5] / words, counts[:, 6] / chars], axis=1)
    return np.column_stack([np.log1p(20 * shares), counts[:, 1] / words])


def _expected_depth(rows: np.ndarray | int) -> np.ndarray:
    """Splits an unsuccessful search takes in a random tree over ``rows`` rows."""
    n = np.maximum(np.asarray(rows, float), 1)
    deep = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, deep))


class Forest(NamedTuple):
    """Trees as flat arrays: split feature (or -1 in a leaf), threshold, children, depth, expected depth of what
    ends in a leaf, and the lowest and highest value of each feature among the rows of a node."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    roots: np.ndarray
    rows: int

    def _cut_off(self, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The chance that a random cut at the node, drawn with the document among its rows, cuts it off."""
        low, high = self.low[node], self.high[node]
        outside = np.maximum(np.maximum(low - x, x - high), 0)
        wide = high - low + outside
        able = wide > 0
        return (outside / np.where(able, wide, 1)).sum(axis=1) / np.maximum(able.sum(axis=1), 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the shorter the expected paths, the higher.

        At each node a document may leave the tree for being outside the values of the node's rows, also in a
        feature in which these rows are all equal and which no split looks at.
        """
        total = np.zeros(len(x))
        for root in self.roots:
            goes, node, stays = np.arange(len(x)), np.full(len(x), root), np.ones(len(x))
            while len(goes):
                off = self._cut_off(x[goes], node)
                total[goes] += stays * off * (self.depth[node] + 1)
                stays = stays * (1 - off)
                leaf = self.feature[node] < 0
                total[goes[leaf]] += stays[leaf] * self.end[node[leaf]]
                goes, node, stays = goes[~leaf], node[~leaf], stays[~leaf]
                below = x[goes, self.feature[node]] < self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
        return np.exp2(-total / len(self.roots) / max(float(_expected_depth(self.rows)), 1.0))


def grow_forest(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """Random trees: each on its own rows of ``x``, cut at random values of random features."""
    random = np.random.default_rng(seed)
    rows = min(tree_rows, len(x))
    limit = int(np.ceil(np.log2(max(rows, 2))))
    nodes: list[list[float]] = []
    boxes: list[tuple[np.ndarray, np.ndarray]] = []

    def grow(part: np.ndarray, depth: int) -> int:
        here = len(nodes)
        low, high = part.min(axis=0), part.max(axis=0)
        nodes.append([-1, 0.0, -1, -1, depth, depth + float(_expected_depth(len(part) + 1))])
        boxes.append((low, high))
        open_features = np.flatnonzero(high > low)
        if depth < limit and len(part) > 1 and len(open_features):
            chosen = int(random.choice(open_features))
            cut = float(random.uniform(low[chosen], high[chosen]))
            below = part[:, chosen] < cut
            if below.any() and not below.all():
                left = grow(part[below], depth + 1)
                nodes[here][:4] = [chosen, cut, left, grow(part[~below], depth + 1)]
        return here

    roots = [grow(x[random.choice(len(x), rows, replace=False)], 0) for _ in range(trees)]
    made = np.array(nodes)
    whole = made[:, [0, 2, 3]].astype(np.int64).T
    low, high = (np.array(side) for side in zip(*boxes, strict=True))
    return Forest(whole[0], made[:, 1], whole[1], whole[2], made[:, 4], made[:, 5], low, high, np.array(roots), rows)


def label_rows(labels: DataFrame) -> DataFrame:
    """One row per labelled doc_id: 1 for good; of differing labels the lower one holds."""
    named = only(labels, "doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    return named.groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))


def fit_forest(labelled: DataFrame, *, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> Forest | None:
    """A forest grown on at most ``trees * tree_rows`` rows labelled good, picked by a hash of their id.

    Only good rows: were junk among them, it would be inside the trees and count as usual.
    """
    order = [F.xxhash64("doc_id", F.lit(seed)), "doc_id", *COUNTS]
    sample = labelled.where("good = 1").orderBy(*order).limit(trees * tree_rows).select(*COUNTS).toPandas()
    return grow_forest(features(sample.to_numpy()), trees, tree_rows, seed) if len(sample) else None


def scored(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """``stats`` with the ``score`` of the forest; 0 without one."""
    schema = ", ".join(f"{name} {kind}" for name, kind in stats.dtypes) + ", score double"
    at = [stats.columns.index(name) for name in COUNTS]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in at])
        score = forest.score(features(counts)) if forest else np.zeros(len(counts))
        return pa.record_batch([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    return map_batches(stats, schema, work)


def calibrate(labelled_scores: DataFrame, *, good_cost: float = GOOD_COST) -> float:
    """The score from which on a document is odd: the one with the least cost on the labelled rows.

    All labelled rows count, gathered in ``BINS`` steps of the score. Of equal costs the highest
    threshold is taken, so that fewer documents go.
    """
    step = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("step")
    found = labelled_scores.groupBy(step, "good").count().collect()
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for row in found:
        (good if row["good"] else bad)[row["step"]] += row["count"]
    if not good.any() or not bad.any():
        return float("inf")
    rejected = good[::-1].cumsum()[::-1]  # from this step on
    missed = bad.sum() - bad[::-1].cumsum()[::-1]
    cost = good_cost * rejected + missed
    return float(np.flatnonzero(cost == cost.min()).max()) / BINS


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _judged(docs: DataFrame, labels: DataFrame, good_cost: float = GOOD_COST) -> DataFrame:
    """What ``judge`` gives, and the digest of the text.

    The counts are stored once; only they, not the texts, meet the labels.
    """
    stats = stored(statistics(docs), "rule_statistics")
    marked = label_rows(labels)
    labelled = stats.join(marked, "doc_id").where(~base_failed())
    labelled = stored(labelled.select(*stats.columns, "good"), "labelled_statistics")
    forest = fit_forest(labelled)
    threshold = calibrate(scored(labelled, forest), good_cost=good_cost)
    return scored(stats, forest).select(
        "*",
        F.lit(threshold).alias("threshold"),
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("score") < threshold)).alias("kept"),
    )


def judge(docs: DataFrame, labels: DataFrame, *, good_cost: float = GOOD_COST) -> DataFrame:
    """doc_id, the counts, base_failed, score, threshold and kept of every row of ``docs``."""
    return _judged(docs, labels, good_cost).drop("digest")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    rejected = _judged(docs, labels).where("NOT kept").select("doc_id", "digest").distinct()
    return named(per_row(docs, rejected, "left_anti"), docs)
