"""The registered queries of the text operators, by name, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from propgraph.llm import (
    byte_bpe,
    conversation_trie,
    decontaminate,
    exact_dedup,
    jaccard_join,
    license_scan,
    merkle,
    oracle,
    paragraph_dedup,
    quality,
    quality_rules,
    token_counts,
    toxicity,
    warc,
)
from propgraph.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    LLM_QUERIES[fn.__name__] = fn
    return fn


@query
def op2_heap_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op6_fuse_filter_dedup(spark, sf_dir):
    """One half of the rows is the snapshot taken in before, the other the batch that comes in."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    half = F.xxhash64("doc_id").bitwiseAND(1)
    found = exact_dedup.dedup([docs.where(half == 0)], docs.where(half == 1))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


LLM_ORACLE["op6_fuse_filter_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@query
def op7_tree_byte_bpe(spark, sf_dir):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.digests(table(spark, sf_dir, "documents"), ranks, pattern)


@query
def op3_wacz_round_trip(spark, sf_dir):
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


LLM_ORACLE["op3_wacz_round_trip"] = """
WITH rows AS (
    SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
    FROM pages),
told AS (
    SELECT *, strlen(payload) AS bytes, strlen(payload) >= 100 AND page_id > first_id AS again FROM rows)
SELECT page_id, bytes AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to
FROM told"""


@query
def op10_signature_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op4_parity_sketch_join(spark, sf_dir):
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"), 4, jaccard_join.Threshold(85, 100))


LLM_ORACLE["op4_parity_sketch_join"] = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS words
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(
        [words[i:i + 3] for i in range(1, greatest(len(words) - 2, 2))]) END AS shingles
    FROM split),
tokens AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
meets AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
    FROM tokens AS a JOIN tokens AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY ALL),
links AS (SELECT a, b FROM meets WHERE 100 * common >= 85 * (n + m - common)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT sets.doc_id, len(sets.shingles) AS n_shingles, min(reach.b) AS component_id
FROM sets JOIN reach ON reach.a = sets.doc_id GROUP BY sets.doc_id, len(sets.shingles)"""


@query
def op1_string_tiling_leaks(spark, sf_dir):
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "matched_words", F.size("tiles").alias("n_tiles"))


@query
def op9_paragraph_minhash_dedup(spark, sf_dir):
    return paragraph_dedup.repeated_paragraphs(table(spark, sf_dir, "documents"))


@query
def op5_block_max_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_pu_quality(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_euler_tour_trie(spark, sf_dir):
    return conversation_trie.rebuilt_trie(table(spark, sf_dir, "conversations")).drop("entered")


LLM_ORACLE["op11_euler_tour_trie"] = oracle.TRIE


@query
def op12_interval_merkle_manifest(spark, sf_dir):
    found = merkle.proofs(table(spark, sf_dir, "documents"), merkle.lower_cased())
    return found.withColumn("proof_sha256", merkle.proof_digest()).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


LLM_ORACLE["op12_interval_merkle_manifest"] = oracle.MANIFEST


@query
def op13_rule_cascade(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


LLM_ORACLE["op13_rule_cascade"] = oracle.RULES


LLM_QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
