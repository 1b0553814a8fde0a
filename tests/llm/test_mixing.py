"""The fit of the rates against the same least squares solved densely, and odd tables."""

import numpy as np
import pytest

from lakemart.llm import soft_mixing

ROWS = "tokens long, p array<double>"
DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def brute_rates(p, gone):
    return np.maximum(0.0, 1.0 - p @ np.array(gone))


def skewed(n=3000):
    """Rows of which the targets send nearly all to zero."""
    draw = np.random.default_rng(5)
    tokens = draw.integers(50, 900, n)
    p = np.concatenate([draw.dirichlet([20.0, 0.1, 0.1], n // 10), draw.dirichlet([0.2, 2.0, 3.0], n - n // 10)])
    return tokens, p


def test_rates_settle_although_most_of_them_are_zero(spark):
    tokens, p = skewed()
    table = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, p, strict=True)], ROWS)
    fit = soft_mixing.fit_rates(table)
    rates = brute_rates(p, fit.gone)
    assert (rates == 0).mean() > 0.5 and fit.steps < 30
    assert np.allclose((tokens * rates) @ p, fit.wanted, rtol=1e-8)
    found = table.select(soft_mixing.rate(table["p"], fit.gone).alias("r")).collect()
    assert np.allclose([r["r"] for r in found], rates)


def test_a_target_out_of_reach_is_told_not_raised(spark):
    rows = [(100, [1.0, 0.0, 0.0])] * 5 + [(100, [0.0, 1.0, 0.0])] * 5  # no tokens of the third domain at all
    fit = soft_mixing.fit_rates(spark.createDataFrame(rows, ROWS))
    assert np.allclose(fit.reached[:2], fit.wanted[:2]) and fit.reached[2] == 0 < fit.wanted[2]
    assert soft_mixing.missed(fit.wanted, fit.reached) == pytest.approx(0.03)


def test_empty_tables_and_null_texts_mix(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(6)], LABELS)
    nothing = spark.createDataFrame([], DOCS)
    assert soft_mixing.mixture(nothing, labels).count() == 0 and soft_mixing.mix(nothing, labels).count() == 0
    rows = [(i, None if i % 3 == 0 else f"word{i % 2} again", "en") for i in range(6)] + [(None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    rated = soft_mixing.mixture(docs, labels).collect()
    assert len(rated) == 7 and all((r["tokens"] == 0) == (r["doc_id"] is None or r["doc_id"] % 3 == 0) for r in rated)
    assert soft_mixing.mix(docs, labels).columns == docs.columns
    without = soft_mixing.mixture(docs, labels.where("doc_id < 0")).collect()
    assert [r["rate"] for r in without] == [1.0] * 7


def test_log_odds_are_those_of_the_distinct_telling_buckets(spark):
    model = soft_mixing.Classifier([3, 259, 70], [[0.5, -1.0, 2.0], [1.5, 0.25, -0.5]], [0.125, -0.125])
    rows = [([3, 3, 259, 5],), ([],), ([70, 515],), ([3, 259, 70],)]
    found = spark.createDataFrame(rows, "at array<int>").select(soft_mixing._sums(soft_mixing.F.col("at"), model).alias("s"))
    expected = [[-0.375, 1.625], [0.125, -0.125], [2.125, -0.625], [1.625, 1.125]]
    assert [r["s"] for r in found.collect()] == expected
