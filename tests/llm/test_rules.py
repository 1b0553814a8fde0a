"""Verdicts, rates and stages on small tables with nulls and repeated ids, compared with brute force."""

import numpy as np
import pytest

from lakemart.llm import exact_dedup, quality_forest, soft_mixing

DOCS = "doc_id long, text string, lang string"


def toxic_rows(rare=0):
    """Documents of the three domains; the word ``slur`` is in every fifth toxic one and in ``rare`` good ones."""
    good = [(f"plain text number n{i} " + ("slur" if i < rare else "word"), (1, 0)) for i in range(400)]
    toxic = [(f"plain text number n{i} " + ("slur" if i % 5 == 0 else "word"), (1, 1)) for i in range(200)]
    poor = [(f"plain ### number n{i} word", (0, 0)) for i in range(100)]
    rows = [(i, text, mark) for i, (text, mark) in enumerate(good + toxic + poor)]
    return [(i, text, "en") for i, text, _ in rows], [(i, *mark) for i, _, mark in rows]


def brute_certain(rows, labels, size):
    """The certainty of each bucket for each further domain, from exact counts."""
    domain = {i: 2 if toxic else 1 - quality for i, quality, toxic in labels}
    has = {}
    for row in rows:
        for bucket in set(row["at"]):
            has.setdefault(bucket, np.zeros(3))[domain[row["doc_id"]]] += 1
    made = {}
    for bucket, n in has.items():
        logit = np.log((n + 0.5) / (size - n + 0.5))
        error = 1 / (n + 0.5) + 1 / (size - n + 0.5)
        made[bucket] = np.abs(logit[1:] - logit[0]) / np.sqrt(error[1:] + error[0])
    return {bucket: sure for bucket, sure in made.items() if sure.max() >= soft_mixing.CERTAIN}


@pytest.mark.parametrize("rare", [0, 5])
def test_telling_words_come_from_exact_counts(spark, rare):
    made, marks = toxic_rows(rare)
    docs, labels = spark.createDataFrame(made, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    words = soft_mixing.buckets(soft_mixing.words(docs["text"])).alias("at")
    expected = brute_certain(docs.select("doc_id", words).collect(), marks, np.array([400, 100, 200]))
    found = {r["b"]: [r["sure1"], r["sure2"]] for r in soft_mixing._certain(soft_mixing._sample(docs, labels), [400, 100, 200]).collect()}
    assert set(found) == set(expected) and all(np.allclose(found[b], expected[b]) for b in found)
    slur = spark.sql(f"SELECT pmod(xxhash64('slur'), {soft_mixing.BUCKETS})").first()[0]
    assert (slur in soft_mixing.fit_classifier(docs, labels).telling) == (rare == 5)


def test_a_toxic_word_seen_in_seven_documents_tells(spark):
    made = [(i, f"plain n{i}" + (" slur" if i >= 2993 else ""), "en") for i in range(3000)]
    marks = [(i, 1, int(i >= 2993)) for i in range(3000)]
    docs, labels = spark.createDataFrame(made, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    slur = spark.sql(f"SELECT pmod(xxhash64('slur'), {soft_mixing.BUCKETS})").first()[0]
    assert slur in soft_mixing.fit_classifier(docs, labels).telling


LABELS = "doc_id long, quality int, toxic int"


def plain(i):
    """A text of more than 50 words of differing lengths."""
    return " ".join(f"w{'a' * ((i * 7 + n * (1 + i % 3)) % (3 + i % 5))}{n}" for n in range(60 + i % 40))


def junk(i):
    """The like with symbols, which good texts never have; no fewer than nine words of them."""
    words = (("#" * (i % 7) + "w" + "a" * (n % 4)) if n % (1 + i % 3) == 0 else f"w{n}" for n in range(60 + i % 30))
    return "#$ " * 9 + " ".join(words)


def test_junk_that_good_rows_never_look_like_is_rejected(spark):
    texts = [plain(i) for i in range(300)] + [junk(i) for i in range(200)]
    docs = spark.createDataFrame([(i, text, "en") for i, text in enumerate(texts)], DOCS)
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(500)], LABELS)
    assert {r["doc_id"] for r in quality_forest.judge(docs, labels).where("NOT kept").collect()} == set(range(300, 500))


def brute_depth(forest, x, node):
    """The expected depth at which ``x`` leaves a tree, one node after the other."""
    away = np.maximum(np.maximum(forest.low[node] - x, x - forest.high[node]), 0)
    wide = forest.high[node] - forest.low[node] + away
    off = np.mean([a / w for a, w in zip(away, wide, strict=True) if w > 0] or [0])
    if forest.feature[node] < 0:
        return off * (forest.depth[node] + 1) + (1 - off) * forest.end[node]
    below = x[forest.feature[node]] < forest.threshold[node]
    return off * (forest.depth[node] + 1) + (1 - off) * brute_depth(forest, x, (forest.left if below else forest.right)[node])


def test_scores_are_those_of_single_paths():
    draw = np.random.default_rng(5)
    rows = np.column_stack([np.zeros(200), draw.normal(size=(200, 2)), draw.integers(0, 3, 200)])
    forest = quality_forest.grow_forest(rows, trees=5, tree_rows=64)
    asked = np.vstack([rows[:20], draw.normal(size=(20, 4)) * 3])
    depths = np.array([np.mean([brute_depth(forest, x, root) for root in forest.roots]) for x in asked])
    expected = np.exp2(-depths / quality_forest._expected_depth(64))
    assert np.allclose(forest.score(asked), expected)


CLASH = "doc_id long, text string, lang string, DOC_ID string"


def repeated(texts, ids):
    return [(i, text, "en", "y") for i, text in zip(ids, texts, strict=True)]


def found(rows):
    return sorted((str(row[0]), str(row[1])) for row in rows.collect())


def test_rows_that_share_an_id_are_judged_each_for_itself(spark):
    texts = [plain(i) for i in range(300)] + [junk(i) for i in range(200)] + [plain(3), junk(4), "short", None, plain(9), junk(9)]
    docs = spark.createDataFrame(repeated(texts, [*range(500), None, None, None, None, 7, 7]), CLASH)
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(500)], LABELS)
    expected = sorted([(str(i), plain(i)) for i in range(300)] + [("None", plain(3)), ("7", plain(9))])
    assert found(quality_forest.keep_good(docs, labels)) == expected


def test_copies_go_where_ids_are_shared(spark):
    rows = [(1, "Same Text"), (1, "other"), (2, "same text"), (None, "other"), (None, "lost"), (None, "LOST"), (None, None), (3, ""), (2, "Same text")]
    docs = spark.createDataFrame([(i, text, "en", "y") for i, text in rows], CLASH)
    kept = found(exact_dedup.dedup(docs))
    assert [(i, t.lower()) for i, t in kept] == [("1", "other"), ("2", "same text"), ("3", ""), ("None", "lost")]


def test_mixing_counts_rows_that_share_an_id_each_for_itself(spark):
    made, marks = toxic_rows()
    docs = spark.createDataFrame([(i, text, "en", "y") for i, text, _ in made] + [(None, text, "en", "y") for i, text, _ in made[:700:7]], CLASH)
    labels = spark.createDataFrame(marks, LABELS)
    rated = soft_mixing.mixture(docs, labels).collect()
    mixed = found(soft_mixing.mix(docs, labels))
    assert len(mixed) == sum(row["copies"] for row in rated)


def test_every_certain_word_tells_and_a_repeated_id_does_not_fill_the_sample(spark, monkeypatch):
    slurs = [f"slur{i}" for i in range(60)]
    rows = [(i, "plain " + (" ".join(slurs) if i % 2 else "text"), "en") for i in range(200)]
    docs = spark.createDataFrame(rows + [(0, f"again{i}", "en") for i in range(300)], DOCS)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], LABELS)
    assert len(soft_mixing.fit_classifier(docs, labels).telling) >= 60
    monkeypatch.setattr(soft_mixing, "SAMPLE", 210)
    sample = soft_mixing._sample(docs, labels).collect()
    assert sorted(row["domain"] for row in sample) == [0] * 110 + [2] * 100


def test_rates_reach_the_targets_or_say_that_they_do_not(spark):
    draw = np.random.default_rng(2)
    rows = [(int(n), [float(x) for x in p]) for n, p in zip(draw.integers(1, 90, 300), draw.dirichlet([0.2, 0.02, 0.02], 300), strict=True)]
    table = spark.createDataFrame(rows, "tokens long, p array<double>")
    fit = soft_mixing.fit_rates(table, {"good": 0.9, "poor": 0.05, "toxic": 0.05})
    p, tokens = np.array([p for _, p in rows]), np.array([n for n, _ in rows])
    rates = np.maximum(0, 1 - p @ np.array(fit.gone))
    assert np.allclose((tokens * rates) @ p, fit.reached)
    assert np.allclose(fit.reached, fit.wanted, rtol=2e-9, atol=0)
    same_p = spark.createDataFrame([(5, [0.6, 0.2, 0.2])] * 9, "tokens long, p array<double>")
    stalled = soft_mixing.fit_rates(same_p)
    assert soft_mixing.missed(stalled.wanted, stalled.reached) > 0.05


def test_mixture_says_what_the_copies_miss(spark):
    made, marks = toxic_rows(5)
    docs, labels = spark.createDataFrame(made, DOCS), spark.createDataFrame(marks, LABELS)
    rows = soft_mixing.mixture(docs, labels).collect()
    p = np.array([[r["p_good"], r["p_poor"], r["p_toxic"]] for r in rows])
    tokens, times = np.array([r["tokens"] for r in rows]), np.array([r["copies"] for r in rows])
    good = (tokens @ p)[0]
    wanted = good / 0.96 * np.array([0.96, 0.01, 0.03])
    assert np.isclose(rows[0]["copies_missed"], np.abs((tokens * times) @ p - wanted).max() / wanted.sum())
