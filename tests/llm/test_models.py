"""Host trust against dense vectors, and the language model against dictionaries."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakemart.llm import host_trust, interpolated_lm

PAGES = "page_id long, url string, html string, URL string"
DOCS = "doc_id long, text string, lang string, TEXT string"


def brute_trust(rows):
    """Trust and distrust of each host by plain iteration to the end."""
    pages, links, allowed, blocked = Counter(), Counter(), Counter(), Counter()
    for host, targets, verdict in rows:
        pages[host] += 1
        allowed[host] += verdict == "allow"
        blocked[host] += verdict == "block"
        for target in targets:
            links[host, target] += 1
    hosts = sorted({*pages, *[h for pair in links for h in pair]})
    at = {h: i for i, h in enumerate(hosts)}
    matrix = np.zeros((len(hosts), len(hosts)))
    for (a, b), n in links.items():
        matrix[at[a], at[b]] = n

    def rank(moves, seeds):
        start = np.array([seeds[h] for h in hosts], dtype=float)
        if not start.sum():
            return start
        start /= start.sum()
        moves = moves / np.maximum(moves.sum(axis=1, keepdims=True), 1e-300)
        score = start
        for _ in range(3000):
            sent = host_trust.DAMPING * (score @ moves)
            score = sent + (1 - sent.sum()) * start
        return score

    trust, distrust = rank(matrix, allowed), rank(matrix.T, blocked)
    share = np.array([pages[h] for h in hosts]) / sum(pages.values())
    return {h: (trust[i], distrust[i], share[i]) for h, i in at.items()}


def test_trust_and_distrust_travel_between_hosts(spark):
    draw = random.Random(8)
    hosts = [f"h{i}.org" for i in range(12)] + ["good.com", "www.shop.com", "bad.net", "worse.net"]
    chain = {f"h{i}.org": [f"h{i + 1}.org"] for i in range(11)}  # a long way from the seeds
    rows, brute = [], []
    for number in range(60):
        host = hosts[number % len(hosts)]
        path = "/es/a" if host.endswith(".net") else "/x"
        targets = chain.get(host) or draw.sample(hosts, 2)
        html = " ".join(f'<a href="http://{t}/p">' for t in targets) + ' <a href="mailto:a@b">'
        rows.append((number, f"http://{host.upper() if number % 2 else host}{path}", html, "x"))
        verdict = "allow" if host.endswith(".com") else "block" if host.endswith(".net") else None
        brute.append((host, targets, verdict))
    rows += [(100, None, None, "x"), (101, "no host", "<a href='http://h1.org'>", "x"), (None, "http://h0.org", None, "x")]
    brute.append(("h0.org", [], None))
    scores = brute_trust(brute)
    found = host_trust.judge(spark.createDataFrame(rows, PAGES)).collect()
    assert len(found) == len(rows)
    verdicts = set()
    for row in found:
        trust, distrust, share = scores.get(row["host"], (0.0, 0.0, 0.0))
        assert row["trust"] == pytest.approx(trust, abs=2e-4) and row["distrust"] == pytest.approx(distrust, abs=2e-4)
        if row["rule"] is None and row["host"]:
            blocked = distrust >= host_trust.DISTRUST * share and distrust > trust and distrust > 0
            assert row["verdict"] == ("block" if blocked else "allow")
            verdicts.add(row["verdict"])
    assert verdicts == {"allow", "block"}  # hosts without a rule are decided by their links, both ways
    assert host_trust.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_scores_that_do_not_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(host_trust, "MOST_ROUNDS", 1)
    rows = [(1, "http://a.com/", "<a href='http://b.org'>", "x"), (2, "http://b.org/", "<a href='http://c.org'>", "x")]
    with pytest.raises(RuntimeError):
        host_trust.judge(spark.createDataFrame(rows, PAGES)).collect()


def brute_model(rows):
    """base_score and score of each row, by counts in dictionaries and EM to the same end."""

    def tokens(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]

    def fold(doc_id):
        return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7

    def counts(folds):
        words, pairs = Counter(), Counter()
        for doc_id, text, *_ in rows:
            if fold(doc_id) in folds:
                before = None
                for token in tokens(text):
                    words[token] += 1
                    pairs[before, token] += 1
                    before = token
        return words, pairs

    training = set(range(7)) - {2}
    words, pairs = counts(training)
    n, v = sum(words.values()), len(words)

    def parts(known, before, token):
        own, two = known
        whole = sum(own.values())
        return np.array([two[before, token] / max(own[before], 1), own[token] / max(whole, 1), 1 / (v + 1)])

    def bucket(count):
        return int(interpolated_lm.bucket_of(np.array([float(count)]))[0])

    rest = counts(training - {interpolated_lm.TUNING})
    events = []
    for doc_id, text, *_ in rows:
        if fold(doc_id) == interpolated_lm.TUNING:
            before = None
            for token in tokens(text):
                events.append((bucket(rest[0][before]), parts(rest, before, token)))
                before = token
    weights, last = np.tile(interpolated_lm.START, (interpolated_lm.BUCKETS, 1)), -math.inf
    while events:
        total, log = np.zeros_like(weights), 0.0
        for b, p in events:
            shared = p * weights[b]
            log += math.log(shared.sum())
            total[b] += shared / shared.sum()
        if (log - last) / len(events) < interpolated_lm.SETTLED:
            break
        last = log
        total = np.where(total.sum(axis=1, keepdims=True) > 0, total, total.sum(axis=0))
        weights = np.maximum(total / total.sum(axis=1, keepdims=True), interpolated_lm.LEAST_WEIGHT)
        weights /= weights.sum(axis=1, keepdims=True)
    found = []
    for doc_id, text, *_ in rows:
        base = score = 0.0
        before, known = None, 0
        for token in tokens(text):
            base += math.log10((words[token] + 1) / (n + v + 1))
            score += math.log10((parts((words, pairs), before, token) * weights[bucket(words[before])]).sum())
            known += words[token] > 0
            before = token
        found.append((doc_id, fold(doc_id) == 2, len(tokens(text)), known, n, base, score))
    return found


def key(row):
    return [str(value) for value in row[:5]] + [round(row[5], 5), round(row[6], 5)]


def test_scores_are_those_of_a_model_in_dictionaries(spark):
    draw = random.Random(3)
    rows = []
    for i in range(150):
        words = [f"w{min(draw.randrange(30), draw.randrange(30))}" for _ in range(draw.randrange(40))]
        rows.append((i, " ".join(words).title() if i % 3 else " ".join(words), "en", "x"))
    rows += [(None, "w1 w2", "en", "x"), (7, None, "en", "x"), (8, "", "en", "x"), (9, "unseen Éa", "en", "x"), rows[5]]
    found = interpolated_lm.score(spark.createDataFrame(rows, DOCS), block_words=300).collect()
    expected = brute_model(rows)
    assert len(found) == len(expected)
    for row, other in zip(sorted(map(tuple, found), key=key), sorted(expected, key=key), strict=True):
        assert tuple(row[:5]) == other[:5]
        assert row[5] == pytest.approx(other[5], rel=1e-9) and row[6] == pytest.approx(other[6], rel=1e-6)
    assert interpolated_lm.score(spark.createDataFrame([], DOCS)).count() == 0
