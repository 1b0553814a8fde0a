"""Repeated passages against a dictionary of all strings of 100 bytes."""

import hashlib
import random

import numpy as np
import pytest

from lakemart.llm import phrase_parse

DOCS = "doc_id long, text string, lang string, TEXT string"


def brute(rows):
    """n_bytes, n_removed, n_spans and digest of each row, by the first place of every string."""
    made = []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen = set()
    for i in order:
        text = (rows[i][1] or "").encode()
        gone = np.zeros(len(text), dtype=bool)
        for at in range(len(text) - 99):
            string = text[at : at + 100]
            if string in seen:
                gone[at : at + 100] = True
            seen.add(string)
        stays = bytes(np.frombuffer(text, dtype=np.uint8)[~gone])
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
        made.append((rows[i][0], len(text), int(gone.sum()), spans, hashlib.sha256(stays).hexdigest()))
    return made


def words(draw, n):
    return " ".join(draw.choice(["alpha", "beta", "gamma", "é", "delta", "x", "omega one"]) + str(draw.randrange(40)) for _ in range(n))


def corpus(seed):
    draw = random.Random(seed)
    passages = [words(draw, draw.randrange(12, 60)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [words(draw, draw.randrange(1, 60))]
        for _ in range(draw.randrange(4)):
            passage = draw.choice(passages)
            cut = draw.randrange(len(passage) // 2)
            parts += [passage[cut:], words(draw, draw.randrange(1, 30))]
        rows.append((i * 3 % 61, " ".join(parts), "en", "x"))
    return rows


def odd_rows():
    run, period = "a" * 700, "abcdefghij" * 60
    rows = corpus(1)[:8]
    rows += [(100, run, "en", "x"), (101, "b" + run[:150] + "c", "en", "x"), (102, period, "en", "x"), (99, period[3:300] + "!", "en", "x")]
    rows += [(103, None, "en", "x"), (104, "", "en", "x"), (105, "z" * 99, "en", "x"), (106, "z" * 100, "en", "x"), (107, "z" * 100, "en", "x")]
    rows += [(108, "\0" * 130 + "q", "en", "x"), (109, "p" + "\0" * 130, "en", "x")]
    rows += [rows[0], rows[0], (None, rows[3][1], "en", "x"), (rows[2][0], rows[2][1], "en", "x")]
    return rows


def compare(spark, rows):
    found = phrase_parse.removed(spark.createDataFrame(rows, DOCS).repartition(3))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("seed", [2, 3])
def test_passages_go_where_they_start_earlier(spark, seed):
    compare(spark, corpus(seed))


def test_runs_periods_nulls_and_equal_rows(spark):
    compare(spark, odd_rows())


@pytest.mark.parametrize(("local", "crowd", "batch"), [(0, 3, 3000), (1, 0, 500), (4, 2, 1 << 20)])
def test_crowded_triggers_and_small_batches_change_nothing(spark, monkeypatch, local, crowd, batch):
    monkeypatch.setattr(phrase_parse, "LOCAL", local)
    monkeypatch.setattr(phrase_parse, "CROWD", crowd)
    monkeypatch.setattr(phrase_parse, "BATCH", batch)
    compare(spark, corpus(5) + odd_rows())


def test_every_string_is_in_one_phrase_and_equal_strings_have_equal_triggers():
    texts = [text.encode() for _, text, *_ in corpus(7)[:20]] + [b"", b"s" * 50, b"ab" * 90]
    starts = np.cumsum([0, *map(len, texts)])
    with np.errstate(over="ignore"):
        tau, _, of, at, first, last = phrase_parse.parse(texts)
    whole, offsets, count = b"".join(texts), {}, 0
    for t, text, trigger, begin, end in zip(tau, of, at, first, last, strict=True):
        assert starts[text] <= begin <= end <= trigger <= begin + 76 and end + 100 <= starts[text + 1]
        for string in range(begin, end + 1):
            count += 1
            known = offsets.setdefault(whole[string : string + 100], (int(t), trigger - string))
            assert known == (int(t), trigger - string)
    assert count == sum(max(0, len(text) - 99) for text in texts)


def test_kept_bytes_are_the_text_without_its_spans(spark):
    rows = [(1, "k" * 30 + "same passage " * 20, "en", "x"), (2, "other start " + "same passage " * 20, "en", "x"), (3, None, "en", "x")]
    found = {r["doc_id"]: bytes(r["kept"]) for r in phrase_parse.kept_bytes(spark.createDataFrame(rows, DOCS)).collect()}
    digests = {row[0]: row[4] for row in brute(rows)}
    assert {i: hashlib.sha256(kept).hexdigest() for i, kept in found.items()} == digests


def test_an_empty_table_has_no_rows(spark):
    assert phrase_parse.removed(spark.createDataFrame([], DOCS)).collect() == []
