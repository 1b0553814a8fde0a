"""The operators of this subpackage as named queries over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (
    anchor_simhash,
    exact_dedup,
    host_trust,
    interpolated_lm,
    level_strings,
    oracle_divergence,
    oracle_manifest,
    phrase_parse,
    quality_forest,
    segment_trees,
    shard_tree,
    soft_mixing,
    token_files,
    warc,
    word_bpe,
)
from lakemart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op7_quality_forest(spark: SparkSession, folder: str) -> DataFrame:
    return quality_forest.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op1_cuckoo_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.decisions(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op1_cuckoo_dedup"] = """
    SELECT doc_id, max(doc_id) OVER same_text AS keep_id, count(*) OVER same_text AS group_size,
           doc_id = max(doc_id) OVER same_text AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS t FROM documents) AS lowered
    WINDOW same_text AS (PARTITION BY t)
"""


@query
def op9_anchor_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = anchor_simhash.near_groups(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return soft_mixing.mixture(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return word_bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_shard_tree(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_tree.with_slots(shard_tree.assign(table(spark, folder, "documents")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op5_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op5_warc_revisits"] = """
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN revisit THEN original END AS refers_to
    FROM (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
                 max(page_id) OVER (PARTITION BY h) AS original,
                 strlen(h) >= 1000 AND page_id < max(page_id) OVER (PARTITION BY h) AS revisit
          FROM (SELECT page_id, coalesce(html, '') AS h FROM pages) AS payloads) AS records
"""


@query
def op6_host_trust(spark: SparkSession, folder: str) -> DataFrame:
    return host_trust.judge(table(spark, folder, "pages"))


@query
def op10_interpolated_lm(spark: SparkSession, folder: str) -> DataFrame:
    return interpolated_lm.score(table(spark, folder, "documents"))


@query
def op11_level_strings(spark: SparkSession, folder: str) -> DataFrame:
    return level_strings.verify(table(spark, folder, "documents"))


ORACLE["op11_level_strings"] = oracle_manifest.LEVEL_STRINGS


@query
def op13_segment_trees(spark: SparkSession, folder: str) -> DataFrame:
    return segment_trees.divergence(table(spark, folder, "documents"))


ORACLE["op13_segment_trees"] = oracle_divergence.SEGMENT_TREES


@query
def op12_phrase_parse(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_parse.removed(table(spark, folder, "documents"))
