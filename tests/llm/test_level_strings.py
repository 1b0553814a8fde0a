"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest

from lakemart.llm import level_strings

DOCS = "text string, doc_id long, source string, lang string, n_chars long, SOURCE string"


def digest(joined):
    return hashlib.sha256(joined.encode()).hexdigest()


def leaf(row, lower=False):
    text, doc_id, source, lang, n_chars = row[:5]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    fields = [None if f is None else str(f) for f in (doc_id, source, lang, n_chars, text)]
    return digest("".join("-" if f is None else f"{len(f.encode())}:{f}" for f in fields))


def climb(level):
    """The root of a list of digests, and the siblings (left, right) of each on its way up."""
    ways = [[] for _ in level]
    under = [[i] for i in range(len(level))]
    while len(level) > 1:
        runs = [range(at, min(at + 16, len(level))) for at in range(0, len(level), 16)]
        for run in runs:
            for i in run:
                left = "".join(level[j] for j in run if j < i)
                right = "".join(level[j] for j in run if j > i)
                for at in under[i]:
                    ways[at].append((left, right))
        under = [[at for i in run for at in under[i]] for run in runs]
        level = [digest("".join(level[i] for i in run)) for run in runs]
    return level[0], ways


def brute(rows):
    sources = sorted({row[2] for row in rows}, key=lambda s: (s is not None, (s or "").encode()))
    made, subroots = [], []
    for number, source in enumerate(sources):
        own = sorted((r for r in rows if r[2] == source), key=lambda r: (r[1] is not None, r[1] or 0, leaf(r)))
        subroot, ways = climb([leaf(r) for r in own])
        subroots.append(subroot)
        made += [(row, subroot, way, number) for row, way in zip(own, ways, strict=True)]
    root, over = climb(subroots)
    found = []
    for row, subroot, way, number in made:
        way = way + over[number]
        bad = row[1] is not None and zlib.crc32(str(row[1]).encode()) % 5 == 0
        at = leaf(row, lower=bad)
        for left, right in way:
            at = digest(left + at + right)
        proof = digest("".join(left + right for left, right in way))
        found.append((row[1], leaf(row), subroot, root, proof, at, at == root))
    return found


def key(row):
    return [str(value) for value in row]


@pytest.mark.parametrize("sizes", [[1], [2, 1], [16, 17, 300, 1, 5], [1] * 20 + [257]])
def test_proofs_are_those_of_a_tree_built_by_hand(spark, sizes):
    rows = []
    for number, size in enumerate(sizes):
        source = None if number == 1 else f"s{number}é" if number % 2 else f"S{number}"
        for i in range(size):
            text = [None, "", f"Some Text {i}", f"plain {i} ünï"][i % 4]
            rows.append((text, None if i % 50 == 49 else i * 3 + number, source, None if i % 9 == 0 else "en", i if i % 5 else None, "x"))
    rows.append(rows[0])
    found = level_strings.verify(spark.createDataFrame(rows, DOCS))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(key, found.collect())) == sorted(map(key, brute(rows)))


def test_a_manifest_knows_its_sources_and_an_empty_table_has_none(spark):
    rows = [("a", i, f"s{i % 3}", "en", 1, "x") for i in range(40)]
    made = level_strings.manifest(level_strings.leaves(spark.createDataFrame(rows, DOCS)))
    assert {(r["source"], r["rows"]) for r in made.sources.collect()} == {("s0", 14), ("s1", 13), ("s2", 13)}
    assert len(made.root) == 64
    nothing = level_strings.verify(spark.createDataFrame([], DOCS))
    assert nothing.collect() == [] and len(nothing.columns) == 7
