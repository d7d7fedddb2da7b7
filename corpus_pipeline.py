"""A corpus pipeline: documents through toxicity, dedup, near dedup, decontamination, tokens.

Each stage takes what the one before it kept, all columns of ``documents``, and its
decision takes effect. Between stages the rows are written as Parquet and read again, so
a lost executor never costs more than a part of one stage.

Defined results: null texts count as empty, and empty texts are copies of each other.
Rows with a null id pass the near-duplicate stage as they are. Of repeated rows one is
left after the exact stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.llm import byte_bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from propgraph.llm.common import table
from propgraph.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5 stay."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the greatest id stays. Half of the rows are the snapshot, half the batch."""
    half = F.xxhash64("doc_id").bitwiseAND(1)
    return exact_dedup.keep_one(docs, half == 0)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at 0.8 over five-word shingles the smallest id stays."""
    return jaccard_join.keep_one(docs, 5, jaccard_join.Threshold(80, 100))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item covers to half or more stay."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", tokenize),
]

# The first stage learns from labels, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
