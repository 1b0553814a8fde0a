"""Divergence of sources against plain loops over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakemart.llm import segment_trees

DOCS = "doc_id long, text string, lang string, source string, LANG string"


def brute(rows):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    found = []
    for lang in {lang for lang, _ in groups}:
        kept = [term for term, n in docs[lang].items() if n >= 3]
        sources = [s for other, s in groups if other == lang]

        def shares(counted, kept=kept):
            whole = sum(counted[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counted[t] + 1) // whole for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, made in (("pair", pairs), ("term", terms)):
                made.sort(key=lambda entry: (-entry[0], entry[1].encode()))
                last = len(made) if part == "pair" else 200
                found += [(lang, s, part, item, value, at + 1) for at, (value, item) in enumerate(made[:last])]
    return found


def rows_of(seed, n, words, sources):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(draw.choice(["w%s", "W%s", "é%s-x", "ß%s7"]) % "abcdefghij"[draw.randrange(10)] * draw.randrange(1, 3) + chr(97 + draw.randrange(words)) for _ in range(draw.randrange(0, 60)))
        rows.append((i, text, draw.choice(["en", "de", None]), draw.choice(sources), "x"))
    return rows + [(0, None, "fr", "only", "x"), (1, "", "fr", None, "x"), (2, "one two", "fr", "b", "x"), (3, "\x00A\x85b", "en", "a", "x")]


@pytest.mark.parametrize("cells", [1 << 19, 40])
def test_values_and_ranks_are_those_of_loops_over_all_terms(spark, monkeypatch, cells):
    monkeypatch.setattr(segment_trees, "CELLS", cells)
    monkeypatch.setattr(segment_trees, "HELD", 50)
    rows = rows_of(4, 150, 26, ["a", "b", "c", None, "long source"])
    found = segment_trees.divergence(spark.createDataFrame(rows, DOCS))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == sorted(brute(rows))


def test_equal_subtrees_are_one_node_and_equal_pairs_one_entry():
    counts = np.zeros((3, 64), dtype=np.int64)
    counts[1, 5] = 2
    values, levels, roots = segment_trees.cons(counts)
    assert roots[0] == roots[2] != roots[1]
    assert sum(map(len, levels)) == 2 * 6  # of each level the empty node, and the one on the way to the count
    which, left, right, times = segment_trees.met(levels, roots[[0, 0]], roots[[1, 2]])
    met = sorted(zip(which.tolist(), values[left].tolist(), values[right].tolist(), times.tolist(), strict=True))
    assert met == [(0, 0, 0, 63), (0, 0, 2, 1), (1, 0, 0, 64)]


def test_counts_past_64_bits_stay_exact():
    huge = np.array([10**13, 5], dtype=np.int64)
    found = segment_trees.share(huge, np.array([10**13 + 5] * 2), 2)
    assert found.tolist() == [1 + 10**9 * (10**13 + 1) // (10**13 + 7), 1]


def test_an_empty_table_has_no_rows(spark):
    assert segment_trees.divergence(spark.createDataFrame([], DOCS)).collect() == []
