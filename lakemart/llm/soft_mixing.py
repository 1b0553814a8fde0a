"""Mixing to target weights with soft membership, in DataFrame functions only.

A logistic classifier over the hashed words that tell domains apart, fitted on a bounded sample of
labelled rows, gives every document posteriors over the domains of the labels. A rate (expected copies) per document is then fitted
by projected gradient: the rates start at one and go against the gradient of the squared residual between the expected
tokens of each domain, sum of rate * tokens * posterior, and the targets; what has been gone so far is one number per
domain, and the rate is one less its product with the posteriors, projected back to zero where below. A step needs one
aggregate over the stored posteriors that returns a few numbers; the rate of a document follows from its posteriors, so
nothing is joined.

The gradient is measured in the metric of the domains' Gram matrix, sum of tokens * p * p' over the rows whose rate is above
zero: a step of length one then ends at the targets unless further rates meet zero. A step is halved until it brings down
the objective whose gradient the residual is, which also makes the rates those nearest to one.

Defined cases: a null text counts as empty and has no tokens; documents without tokens have the posteriors of
a document without telling words; repeated rows are rows of their own with the same rate; a null doc_id is drawn like any
other; without labels of two domains every rate is one; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import warnings
from collections.abc import Mapping
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import named, only, per_row, text_digest
from lakemart.session import stored

DOMAINS = ("good", "poor", "toxic")
TARGETS = {"good": 0.96, "poor": 0.01, "toxic": 0.03}  # shares of the tokens
KEPT_DOMAIN = "good"  # its tokens stay as they are, and documents more likely in it than not are never dropped
SAMPLE = 10_000  # labelled rows the classifier is fitted on, at most; of a repeated doc_id the first ones
BUCKETS = 1 << 16  # hashed words
ENDS = 1 << 8  # hashed last characters of words
DEALT = 1 << 8  # parts of the classifier's look-up table
CERTAIN = 5.0  # standard errors the log odds of a bucket must be off zero; every such bucket is kept
PENALTY = 1e-3  # on squared weights
SMOOTHING = 0.5
TOLERANCE = 1e-9  # of a domain's wanted tokens: the residual at which the fit ends
RANK = 1e-10  # of the largest eigenvalue of a metric: below it a direction counts as absent
LESS = 0.1  # share of the expected fall of the objective that a step has to reach, or it is halved
SHORTEST = 1e-4  # length of a step below which the fit ends
PATIENCE = 10  # steps that do not halve the least residual, after which the targets count as out of reach


class Classifier(NamedTuple):
    """Log odds of each further domain against the first: of every telling bucket a document has, and a base."""

    telling: list[int]
    odds: list[list[float]]
    base: list[float]


def words(text: Column) -> Column:
    """The words of a lower-cased text; null counts as empty."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t-\\r]+"), lambda word: word != "")


def buckets(found: Column) -> Column:
    """The bucket of each word, and after these the bucket of each word's last character."""
    own = F.transform(found, lambda word: F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int"))
    end = F.transform(found, lambda word: (BUCKETS + F.pmod(F.xxhash64(F.right(word, F.lit(1))), F.lit(ENDS))).cast("int"))
    return F.concat(own, end)


def domain_of(labels: DataFrame) -> DataFrame:
    """doc_id and the number of its domain; a document labelled twice takes the last domain that applies."""
    named = only(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL")
    number = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)
    return named.select("doc_id", number.alias("domain")).where("domain IS NOT NULL").groupBy("doc_id").agg(F.max("domain").alias("domain"))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Buckets of the rows of the sample, with their domain: SAMPLE rows at most.

    Every labelled doc_id gives its first row before any gives a second, so a repeated one does not fill the sample.
    """
    chosen = domain_of(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = only(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = texts.select("doc_id", "domain", F.array_distinct(buckets(words(F.col("text")))).alias("at"), F.xxhash64("text").alias("mark"))
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("mark"))
    taken = found.withColumn("turn", turn).where(F.col("turn") <= SAMPLE)  # a limit of each group before the shuffle
    return taken.orderBy("turn", F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select("domain", "at")


def _certain(sample: DataFrame, size: list[int]) -> DataFrame:
    """Bucket b, and for each further domain how surely its documents have b more or less often than those of the first.

    The counts are exact in all domains; buckets that are sure in no domain are left out.
    """
    found = sample.select("domain", F.explode("at").alias("b")).groupBy("b")
    counted = found.agg(*[F.sum((F.col("domain") == k).cast("long")).alias(f"n{k}") for k in range(len(DOMAINS))])

    def logit(k: int) -> Column:
        return F.log((F.col(f"n{k}") + SMOOTHING) / (size[k] - F.col(f"n{k}") + SMOOTHING))

    def error(k: int) -> Column:
        return 1 / (F.col(f"n{k}") + SMOOTHING) + 1 / (size[k] - F.col(f"n{k}") + SMOOTHING)

    further = range(1, len(DOMAINS))
    sure = [(F.abs(logit(k) - logit(0)) / F.sqrt(error(k) + error(0))).alias(f"sure{k}") for k in further]
    return counted.select("b", *sure).where(F.greatest(*[F.col(f"sure{k}") for k in further]) >= CERTAIN)


def _telling(sample: DataFrame, size: list[int]) -> list[int]:
    """Buckets that documents of a further domain have surely more or less often than those of the first."""
    return [row["b"] for row in _certain(sample, size).select("b").orderBy("b").collect()]  # the sure ones only


def _logistic(row_of: np.ndarray, at: np.ndarray, y: np.ndarray, features: int, rounds: int = 400) -> np.ndarray:
    """Weights (domains by features) of a softmax regression, by accelerated gradient descent.

    Feature ``at[i]`` is one in row ``row_of[i]`` and zero elsewhere, so memory grows with the ones only.
    """
    n = len(y)
    target = np.eye(len(DOMAINS))[y]

    def times(weights: np.ndarray) -> np.ndarray:
        return np.bincount(row_of, weights=weights[at], minlength=n)

    def back(values: np.ndarray) -> np.ndarray:
        return np.bincount(at, weights=values[row_of], minlength=features)

    largest, vector = 0.0, np.ones(features)
    for _ in range(100):  # the largest eigenvalue of the Gram matrix, by the power method
        vector = back(times(vector / np.linalg.norm(vector)))
        largest = float(np.linalg.norm(vector))
    step = 4.0 / (1.001 * largest / n + PENALTY)
    weights = ahead = np.zeros((len(DOMAINS), features))
    for turn in range(rounds):
        logits = np.stack([times(row) for row in ahead], axis=1)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        gradient = np.stack([back(column) for column in (p - target).T])
        after = ahead - step / 2 * (gradient / n + PENALTY * ahead)
        ahead = after + turn / (turn + 3) * (after - weights)
        weights = after
    return weights


def fit_classifier(docs: DataFrame, labels: DataFrame) -> Classifier | None:
    """Telling buckets, and their weights from the labelled sample. None where it has one domain only."""
    sample = stored(_sample(docs, labels), "labelled_words")
    size = [0] * len(DOMAINS)
    for row in sample.groupBy("domain").count().collect():
        size[row["domain"]] = row["count"]
    if sum(n > 0 for n in size) < 2:
        return None
    telling = _telling(sample, size)
    place = {bucket: n for n, bucket in enumerate(telling)}
    rows = sample.select("domain", F.filter("at", lambda x: x.isin([-1, *telling])).alias("at")).collect()
    last = len(telling)  # the feature that every row has
    found = [np.array([*[place[bucket] for bucket in row["at"]], last]) for row in rows]
    row_of = np.repeat(np.arange(len(rows)), [len(ones) for ones in found])
    weights = _logistic(row_of, np.concatenate(found), np.array([row["domain"] for row in rows]), last + 1)
    odds = weights[1:] - weights[0]
    return Classifier(telling, odds[:, :-1].tolist(), odds[:, -1].tolist())


def _sums(at: Column, model: Classifier) -> Column:
    """Log odds of each further domain, from the telling buckets among those of the words.

    The odds are one constant, dealt out by the remainder of the bucket so that a look-up meets a few entries only.
    """
    if not model.telling:
        return F.array(*[F.lit(value) for value in model.base])
    dealt: list[list[list[float]]] = [[] for _ in range(DEALT)]
    for bucket, *odds in zip(model.telling, *model.odds, strict=True):
        dealt[bucket % DEALT].append([bucket, *odds])
    table = F.from_json(F.lit(json.dumps(dealt)), "array<array<array<double>>>")
    hits = F.array_distinct(F.filter(at, lambda x: x.isin(model.telling)))

    def entry(bucket: Column) -> Column:
        near = F.get(table, F.pmod(bucket, F.lit(DEALT)))
        return F.get(F.filter(near, lambda odds: F.get(odds, F.lit(0)) == bucket), F.lit(0))

    entries = F.transform(hits, entry)

    def total(k: int, base: float) -> Column:
        return F.aggregate(entries, F.lit(base), lambda sum_, odds: sum_ + F.get(odds, F.lit(k)))

    return F.array(*[total(k + 1, base) for k, base in enumerate(model.base)])


def _softmax(sums: Column) -> Column:
    """Posteriors of all domains."""
    logits = [F.lit(0.0), *[F.get(sums, F.lit(k)) for k in range(len(DOMAINS) - 1)]]
    highest = F.greatest(*logits)
    powers = [F.exp(logit - highest) for logit in logits]
    whole = powers[0]
    for power in powers[1:]:
        whole = whole + power
    return F.array(*[power / whole for power in powers])


def with_posteriors(docs: DataFrame, text: Column, model: Classifier | None) -> DataFrame:
    """``docs`` with ``_mix_tokens`` (words) and ``_mix_p`` (posteriors of ``DOMAINS``)."""
    read = docs.withColumn("_mix_words", words(text)).withColumn("_mix_tokens", F.size("_mix_words").cast("long"))
    if model is None:
        even = F.array(*[F.lit(1.0 / len(DOMAINS))] * len(DOMAINS))
        return read.withColumn("_mix_p", even).drop("_mix_words")
    summed = read.withColumn("_mix_sums", _sums(buckets(F.col("_mix_words")), model))
    return summed.withColumn("_mix_p", _softmax(F.col("_mix_sums"))).drop("_mix_words", "_mix_sums")


def rate(posteriors: Column, gone: list[float]) -> Column:
    """The rate after the steps, whose sum over each domain is ``gone``: one less what they took, or zero if below."""
    value = F.lit(1.0)
    for k, taken in enumerate(gone):
        value = value - F.get(posteriors, F.lit(k)) * F.lit(taken)
    return F.greatest(F.lit(0.0), value)


class Fit(NamedTuple):
    gone: list[float]
    steps: int
    wanted: list[float]
    reached: list[float]


def fit_rates(posteriors: DataFrame, targets: Mapping[str, float] = TARGETS) -> Fit:
    """Projected-gradient steps for the rows (tokens, p); each length tried costs one aggregate.

    Ends when the targets are met, or when they prove out of reach: ``missed`` tells how far it is then.
    """
    k = len(DOMAINS)
    p = [F.get("p", F.lit(i)) for i in range(k)]
    tokens = F.col("tokens").cast("double")

    def sums(gone: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """At the rates: tokens of each domain, sum of tokens * rate^2, and the Gram matrix of the rows above zero."""
        rated = posteriors.withColumn("r", rate(F.col("p"), [float(x) for x in gone]))
        own = F.when(F.col("r") > 0, tokens)
        square = [F.sum(own * p[i] * p[j]).alias(f"g{i}{j}") for i in range(k) for j in range(k)]
        first = [F.sum(tokens * F.col("r") * p[i]).alias(f"s{i}") for i in range(k)]
        row = rated.agg(*first, F.sum(tokens * F.col("r") * F.col("r")).alias("rr"), *square).first()
        found = np.array([value or 0.0 for value in row])
        return found[:k], float(found[k]), found[k + 1 :].reshape(k, k)

    gone = np.zeros(k)
    reached, size, gram = sums(gone)
    weights = np.array([targets[name] for name in DOMAINS])
    kept = DOMAINS.index(KEPT_DOMAIN)
    wanted = reached[kept] / weights[kept] * weights  # the kept domain stays as it is
    if not reached.sum():
        return Fit([0.0] * k, 0, [0.0] * k, [0.0] * k)
    bound = TOLERANCE * np.maximum(wanted, 1.0)
    best, nearest, waited, steps = np.inf, (gone, reached), 0, 0
    while True:
        residual = reached - wanted
        far = float(np.max(np.abs(residual) / np.maximum(wanted, 1.0)))
        waited = 0 if far < best / 2 else waited + 1
        if far < best:
            best, nearest = far, (gone, reached)
        if (np.abs(residual) <= bound).all() or waited > PATIENCE:
            break
        way = np.linalg.pinv(gram, RANK, hermitian=True) @ residual
        length, now = 1.0, size / 2 + gone @ wanted
        while length > SHORTEST:
            ahead = gone + length * way
            found = sums(ahead)
            if found[1] / 2 + ahead @ wanted <= now - LESS * length * (residual @ way):
                break
            length /= 2
        else:
            break  # what is left points where no document does
        gone, steps = ahead, steps + 1
        reached, size, gram = found
    gone, reached = nearest
    return Fit([float(x) for x in gone], steps, [float(x) for x in wanted], [float(x) for x in reached])


def missed(wanted: list[float], reached: list[float]) -> float:
    """The largest distance of a domain from its wanted tokens, as a share of all wanted tokens."""
    whole = sum(wanted)
    return max(abs(a - b) for a, b in zip(wanted, reached, strict=True)) / whole if whole else 0.0


def copies(rate_: Column, posteriors: Column, doc_id: Column, digest: Column) -> Column:
    """Copies of a document: the whole part of its rate, and one more with the chance of the rest.

    The draw follows from the doc_id and the digest of the text, so that rows without a doc_id have draws of
    their own. Documents that are more likely in the kept domain than not stay, once: the tokens of that domain are to
    stay as they are, and copies of some of them beside all the others would add to these.
    """
    draw = F.pmod(F.xxhash64(doc_id, digest, F.lit("copy")), F.lit(1 << 30)) / float(1 << 30)
    drawn = F.floor(rate_) + (draw < rate_ - F.floor(rate_)).cast("long")
    sure = F.get(posteriors, F.lit(DOMAINS.index(KEPT_DOMAIN))) > 0.5
    return F.when(sure, 1).otherwise(drawn).cast("int")


def _fitted(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float]) -> tuple[DataFrame, Classifier | None, Fit]:
    model = fit_classifier(docs, labels)
    own = only(docs, "doc_id", "text").withColumn("digest", text_digest(F.col("text")))
    read = with_posteriors(own, F.col("text"), model)
    table = stored(read.select("doc_id", "digest", F.col("_mix_tokens").alias("tokens"), F.col("_mix_p").alias("p")), "posteriors")
    fit = fit_rates(table, targets) if model else Fit([0.0] * len(DOMAINS), 0, [math.nan] * len(DOMAINS), [math.nan] * len(DOMAINS))
    return table, model, fit


def _drawn(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float]) -> tuple[DataFrame, float, float]:
    """Every row with rate and copies, and what is missed by the rates, and by the copies with those that must stay.

    A fit that stalls before its targets is reported.
    """
    table, model, fit = _fitted(docs, labels, targets)
    rated = table.withColumn("rate", rate(F.col("p"), fit.gone))
    drawn = stored(rated.withColumn("copies", copies(F.col("rate"), F.col("p"), F.col("doc_id"), F.col("digest"))), "mix_copies")
    if model is None:
        return drawn, math.nan, math.nan
    each = [F.sum(F.col("tokens") * F.col("copies") * F.get("p", F.lit(i))).alias(f"s{i}") for i in range(len(DOMAINS))]
    by_rates, by_copies = missed(fit.wanted, fit.reached), missed(fit.wanted, [x or 0.0 for x in drawn.agg(*each).first()])
    if any(abs(a - b) > TOLERANCE * max(a, 1.0) for a, b in zip(fit.wanted, fit.reached, strict=True)):
        warnings.warn(f"targets not reached: {by_rates:.2e} of the wanted tokens missed by the rates, {by_copies:.2e} by the copies", stacklevel=3)
    return drawn, by_rates, by_copies


def mixture(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """doc_id, tokens, the posterior of each domain, rate and copies of every row of ``docs``.

    ``rates_missed`` and ``copies_missed`` are the same in all rows: the largest distance of a domain from its target.
    """
    drawn, by_rates, by_copies = _drawn(docs, labels, targets)
    each = [F.get("p", F.lit(i)).alias(f"p_{name}") for i, name in enumerate(DOMAINS)]
    ends = [F.lit(by_rates).alias("rates_missed"), F.lit(by_copies).alias("copies_missed")]
    return drawn.select("doc_id", "tokens", *each, "rate", "copies", *ends)


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with the columns of ``docs``.

    Rows that share a doc_id have the copies of their own text.
    """
    drawn, _, _ = _drawn(docs, labels, targets)
    counted = drawn.select("doc_id", "digest", F.col("copies").alias("_mix_copies"))
    # Rows of one id and text have the same copies.
    wanted = counted.groupBy("doc_id", "digest").agg(F.max("_mix_copies").alias("_mix_copies"))
    joined = per_row(docs, wanted.where("_mix_copies > 0"), "inner")
    again = joined.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
    return named(again, docs)
