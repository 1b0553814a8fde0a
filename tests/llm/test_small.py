"""The operators on a small table with nulls, empty texts, copies, repeated rows and clashing columns."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakemart.llm import anchor_simhash, common, exact_dedup, quality_forest, shard_tree, token_files, warc, word_bpe

SCHEMA = "doc_id long, text string, lang string, kept string, DOC_ID string"
LONG = " ".join(f"word{i % 977}" for i in range(20_000))
TEXTS = [None, "", "Same Text here", "same text HERE", "a  b\n c ", "<|endoftext|> x", "Ünï cödé!!!", LONG, "one two three four"]
ROWS = [(i, text, "en", "x", "y") for i, text in enumerate(TEXTS)] + [(8, TEXTS[8], None, None, None), (None, "lost id", "en", "x", "y")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda text: hashlib.md5(text).digest()[:1]])
def test_exact_dedup(docs, digest):
    found = exact_dedup.decisions(docs, digest).collect()
    groups = {}
    for doc_id, text, *_ in ROWS:
        groups.setdefault(lowered(text), []).append(doc_id)
    expected = sorted((str(i), str(max(ids, key=lambda x: (x is not None, x))), len(ids)) for ids in groups.values() for i in ids)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == len(groups)


def test_cuckoo_index_inserts_deletes_and_grows():
    index = exact_dedup.CuckooIndex(cells=2)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(500)]
    for key in keys:
        index.insert(key, [key])
    assert all(index.delete(key) for key in keys[:250])
    assert not index.delete(keys[0])
    assert [index.find(key) is not None for key in keys] == [False] * 250 + [True] * 250


def test_near_groups(docs):
    found = {(r["doc_id"], r["fp"]): r["component_id"] for r in anchor_simhash.near_groups(docs).collect()}
    prints = {(i, int(np.uint64(anchor_simhash.fingerprint(lowered(t).encode())).view(np.int64))) for i, t, *_ in ROWS}
    assert set(found) == prints
    assert found[next(k for k in found if k[0] == 3)] == 2


def test_word_bpe_matches_the_library(docs):
    file = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(file)
    for row in word_bpe.encode(docs, file).collect():
        text = next(t for i, t, *_ in ROWS if i == row["doc_id"]) or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (row["ids"], row["decoded"]) == (ids, library.decode(ids, skip_special_tokens=False))


def test_token_files(docs):
    file = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(file)
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    expected, start = [], 0
    for doc_id, text, *_ in ordered:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), doc_id))
        start += len(ids)
    found = token_files.round_trip(docs, file).collect()
    assert sorted((r["start"], r["n_tokens"], r["ids_crc32"], r["doc_id"]) for r in found) == expected


def test_codes_round_trip():
    ranks = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], dtype=np.uint32)
    for counts in ([len(ranks)], [0, 3, len(ranks) - 3, 0], [1, 4, len(ranks) - 5]):
        counts = np.array(counts)
        control, wide, data, long = token_files.pack(ranks, counts)
        assert wide.sum() == len(control) and long.sum() == len(data)
        assert (token_files.unpack(control, data, counts) == ranks).all()


def test_shards_move_into_the_new_one_only(docs):
    rows = shard_tree.with_slots(shard_tree.assign(docs)).collect()
    assert len(rows) == len(ROWS)
    assert all(r["grown_shard"] in (r["shard"], shard_tree.SHARDS) for r in rows)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_quality_counts():
    assert quality_forest.text_counts(b"a b c\na b c\n# x!") == (8, 9, 1, 1, 6, 1, 0)


def test_archives(spark):
    big = "<p>" + "x" * 2000
    pages = spark.createDataFrame([(1, "http://a/", big), (2, None, big), (3, "http://b/", None), (3, "http://b/", "s"), (None, "c", big)], "page_id long, url string, html string")
    rows = {(r["page_id"], r["payload_bytes"]): (r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()}
    assert rows == {(1, 2003): ("revisit", 2), (2, 2003): ("response", None), (3, 0): ("response", None), (3, 1): ("response", None), (None, 2003): ("revisit", 2)}


def test_empty_tables(empty):
    assert exact_dedup.decisions(empty).count() == 0
    assert shard_tree.with_slots(shard_tree.assign(empty)).count() == 0
    assert quality_forest.statistics(empty).count() == 0


PARTS = ["a", " ", "  ", "\n", "word", " W", "é", " ", " ", "<|endoftext|>", "'s", "12", "!?", "\0", "日本", "\r\n", "a,", "é.", "don't", "x: ", "Σ", "İ"]


def mixed_texts():
    draw = np.random.default_rng(3)
    made = ["".join(draw.choice(PARTS, draw.integers(0, 14))) for _ in range(5000)]
    return [None, "", *made, " ", ".", "", None]


@pytest.mark.parametrize("first", [0, 1, 7])
def test_pieces_give_the_ids_of_whole_texts(first):
    column = pa.array(mixed_texts()).slice(first)
    whole = [text or "" for text in column.to_pylist()]
    file = public_tokenizers.path("byte_bpe_50k.json")
    expected = [made.ids + [2] for made in Tokenizer.from_file(file).encode_batch(whole, add_special_tokens=False)]
    found = token_files.PieceEncoder(file).encode(column, 2).to_pylist()
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == expected
    file = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(file)
    expected = [made.ids for made in library.encode_batch(whole, add_special_tokens=False)]
    ids, ends = (mine := word_bpe.WordBpe(file)).encode(column)
    assert [ids[at:end].tolist() for at, end in zip(ends[:-1], ends[1:], strict=True)] == expected
    assert list(mine.decode(ids, ends)) == [library.decode(x, skip_special_tokens=False) for x in expected]


@pytest.mark.parametrize("column", [[], [None], ["", None, ""]])
def test_nothing_to_cut(column):
    distinct, pieces, per_text = common.cut(pa.array(column, pa.string()))
    assert (distinct, len(pieces), per_text.tolist()) == ([], 0, [0] * len(column))


def test_cut_keeps_the_texts():
    texts = mixed_texts()
    distinct, pieces, per_text = common.cut(pa.array(texts))
    ends = np.cumsum(per_text)
    joined = ["".join(distinct[i] for i in pieces[end - n : end]) for n, end in zip(per_text, ends, strict=True)]
    assert joined == [text or "" for text in texts]


def test_remembered_forgets_old_pieces_and_keeps_no_long_ones():
    asked = []
    lengths = common.Remembered(2, lambda pieces: [asked.append(piece) or len(piece) for piece in pieces])
    long = "x" * 500
    for pieces in (["a", "bb", "ccc"], ["a", long], [long, "dddd"], ["e", "f"], ["g"], ["bb"]):
        assert lengths(pieces) == [len(piece) for piece in pieces]
    assert asked == ["a", "bb", "ccc", long, long, "dddd", "e", "f", "g", "bb"]


def test_parts_hold_so_many_bytes_or_one_row():
    batch = pa.record_batch([pa.array([1, 2, 3, 4]), pa.array(["aa", None, "b" * 50, "cc"])], names=["doc_id", "text"])
    assert [part.column(0).to_pylist() for part in common.by_size(batch, 1, 10)] == [[1, 2], [3], [4]]
    assert list(common.by_size(batch.slice(0, 0), 1, 10)) == []
