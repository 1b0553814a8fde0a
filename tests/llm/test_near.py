"""Fingerprints, components and the documents that stay, against all pairs in plain Python."""

import random
import re

import xxhash

from lakemart.llm import anchor_simhash

CLASH = "doc_id long, text string, lang string, DOC_ID string"


def brute_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    """The fingerprint of each row and the number of its component."""
    prints = [brute_print(row[1]) for row in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    return prints, [root(i) for i in range(len(rows))]


def varied(seed=3):
    """Texts with copies that differ in a few words, exact copies, short, empty and null ones."""
    draw = random.Random(seed)
    texts = []
    for _ in range(40):
        words = [f"w{draw.randrange(500)}" for _ in range(draw.randrange(30, 400))]
        texts.append(" ".join(words))
        for _ in range(draw.randrange(4)):
            again = list(words)
            again[draw.randrange(len(again))] = "Changed"
            texts.append(" ".join(again))
    return [*texts, texts[0], texts[5].upper(), "one", "One", "", None, "two words"]


def test_components_are_those_of_all_pairs(spark):
    rows = [(i, text, "en", "y") for i, text in enumerate(varied())]
    prints, roots = brute_groups(rows)
    least = {}
    for i, root in enumerate(roots):
        least.setdefault(root, i)
    found = anchor_simhash.near_groups(spark.createDataFrame(rows, CLASH)).collect()
    assert {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in found} == {
        i: (prints[i], least[roots[i]]) for i in range(len(rows))
    }


def test_one_row_of_each_group_stays_where_ids_are_shared_or_missing(spark):
    texts = varied()
    ids = [None if i % 7 == 0 else i // 2 for i in range(len(texts))]
    rows = [(i, text, "en", "y") for i, text in zip(ids, texts, strict=True)]
    rows += rows[:3]
    _, roots = brute_groups(rows)
    docs = spark.createDataFrame(rows, CLASH)
    kept = anchor_simhash.dedup(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    assert len(left) == len(set(roots))
    of_row = {}
    for row, root in zip(rows, roots, strict=True):
        of_row.setdefault(row[:2], root)
    group = [of_row[tuple(r)[:2]] for r in left]
    assert len(set(group)) == len(group)
    for r, root in zip(left, group, strict=True):
        with_ids = [row[0] for row, other in zip(rows, roots, strict=True) if other == root and row[0] is not None]
        assert r[0] == (min(with_ids) if with_ids else None)


def test_an_empty_table_has_no_groups(spark):
    nothing = spark.createDataFrame([], CLASH)
    assert anchor_simhash.near_groups(nothing).count() == 0 and anchor_simhash.dedup(nothing).count() == 0
