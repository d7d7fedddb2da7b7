"""Exact dedup of a batch against immutable snapshots, screened by binary-fuse filters.

A snapshot holds what has been taken in before: one row per digest, in hash buckets,
and one static filter per bucket. It is written once and never changed. A batch is
first grouped on its own; then its digests are screened bucket by bucket. A digest
that no filter knows is new. The positives join the exact buckets, and the rows of
every digest met more than once are compared byte by byte.

Only digests are shuffled for the screening. Copies are combined before each shuffle,
so a text that holds a third of all rows is one row per task from then on.

Defined results: a null text counts as empty. Rows with a null id take part; the
greatest id stays, and null is below every id. Repeated rows (the same id and text)
each count, and each is marked kept if its id is the one that stays. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm import fuse_filter
from propgraph.llm.common import whole_text
from propgraph.operators.joins import fresh, hub_join
from propgraph.staging import new_path, stage, write_once

KEYS_PER_FILTER = 1 << 18
Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@dataclass(frozen=True)
class Snapshot:
    """``groups``: bucket, digest, keep_id, group_size; ``filters``: bucket, filter."""

    groups: DataFrame
    filters: DataFrame
    buckets: int


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Digest = sha256) -> DataFrame:
    """doc_id and digest of each row. ``digest`` may be weak: the bytes decide in the end."""
    return docs.select(F.col(id_col).alias("doc_id"), digest(whole_text(text_col)).alias("digest"))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def _key(digest: Column) -> Column:
    return F.xxhash64(digest)


def _bucket(digest: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit("bucket")), F.lit(buckets)).cast("int")


def build_snapshot(rows: DataFrame, folder: str | None = None) -> Snapshot:
    """Write the snapshot of ``rows`` (see ``digests``) to ``folder``: its buckets and their filters.

    There are as many buckets as keep a filter at KEYS_PER_FILTER keys, and no fewer
    than shuffle partitions.
    """
    spark = rows.sparkSession
    folder = folder or new_path(spark, "snapshot")
    groups = write_once(_groups(rows), f"{folder}/digests")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-groups.count() // KEYS_PER_FILTER))

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [key[0]], "filter": [fuse_filter.build(part["key"].to_numpy().view(np.uint64))]})

    bucketed = groups.withColumn("bucket", _bucket(F.col("digest"), buckets))
    filters = bucketed.select("bucket", _key(F.col("digest")).alias("key")).groupBy("bucket")
    built = write_once(filters.applyInPandas(build, "bucket int, filter binary"), f"{folder}/filters")
    return Snapshot(bucketed, built, buckets)


def screen(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The digests of ``batch`` (one row per digest) that the snapshot may hold; a superset of those it holds.

    A bucket without filter holds nothing, so none of its digests passes. A batch that is
    large for the snapshot's buckets goes through each filter in several parts.
    """

    def probe(key: tuple, part: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(filters):
            return part[["digest"]].iloc[:0]
        keys = part["key"].to_numpy().view(np.uint64)
        return part.loc[fuse_filter.contains(filters["filter"].iloc[0], keys), ["digest"]]

    digest, parts = F.col("digest"), max(1, -(-batch.count() // (snapshot.buckets * KEYS_PER_FILTER)))
    part_of = F.pmod(F.xxhash64(digest, F.lit("part")), F.lit(parts)).cast("int")
    asked = batch.select(
        "digest",
        _key(digest).alias("key"),
        _bucket(digest, snapshot.buckets).alias("bucket"),
        part_of.alias("part"),
    )
    filters = snapshot.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return (
        asked.groupBy("bucket", "part")
        .cogroup(filters.groupBy("bucket", "part"))
        .applyInPandas(probe, batch.select("digest").schema)
    )


def dedup(
    snapshots: Sequence[DataFrame],
    batch: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Digest = sha256,
) -> DataFrame:
    """One row per row of the snapshots' documents and of the batch.

    doc_id, digest, keep_id (the id that stays of all rows of the same bytes),
    group_size, kept. Give each earlier load as the documents it brought.
    """
    loads = [df.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")) for df in [*snapshots, batch]]
    rows = [digests(df, digest=digest) for df in loads]
    built = [build_snapshot(r) for r in rows[:-1]]
    new = stage(_groups(rows[-1]), "batch-groups")

    # what the batch and each later snapshot share with earlier ones; digests new everywhere need no join
    parts = [s.groups.select("digest", "keep_id", "group_size") for s in built]
    asked, known = [*parts[1:], new], parts
    shared = []
    for i, part in enumerate(asked):
        for snapshot, groups in zip(built[: i + 1], known[: i + 1], strict=True):
            positives = screen(part, snapshot)
            shared.append(positives.join(groups, "digest", "left_semi"))
    repeated = [p.where("group_size > 1").select("digest") for p in [*parts, new]]
    suspects = stage(reduce(DataFrame.unionAll, [*repeated, *shared]).distinct(), "suspects")

    texts = reduce(DataFrame.unionAll, loads).withColumn("digest", digest(F.col("text")))
    # suspects grow with the data: the texts are shuffled once, at every size
    exact = stage(
        hub_join(texts, suspects.hint("merge"), ["digest"], "left_semi")
        .groupBy("digest", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "same-bytes",
    )
    per_digest = exact.groupBy("digest").agg(F.count("*").alias("n_texts"))
    clashes = stage(per_digest.where("n_texts > 1").select("digest"), "clashes")
    sole = exact.join(clashes, "digest", "left_anti").where("group_size > 1").drop("text")
    by_digest = hub_join(reduce(DataFrame.unionAll, rows), sole, ["digest"], "left")
    if not clashes.isEmpty():
        # a digest of several texts: its rows are told apart by their bytes
        clashing = hub_join(texts, clashes, ["digest"], "left_semi")
        told = hub_join(clashing, exact, ["digest", "text"], "left").select(by_digest.columns)
        by_digest = hub_join(by_digest, clashes, ["digest"], "left_anti").unionByName(told)
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return by_digest.select(
        "doc_id",
        "digest",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
    )




def keep_one(docs: DataFrame, earlier: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay of equal texts: the greatest id, once.

    Where ``earlier`` is true, a row belongs to the snapshot, else to the batch.
    """
    found = dedup([docs.where(earlier)], docs.where(~earlier), id_col, text_col)
    groups = found.where("group_size > 1").select("digest", "keep_id").distinct()
    key, kept, many = (fresh(n, docs) for n in ("_digest", "_keep_id", "_many"))
    groups = stage(groups.toDF(key, kept).withColumn(many, F.lit(True)), "copies")
    rows = docs.withColumn(key, sha256(whole_text(text_col)))
    rows = hub_join(rows, groups.hint("merge"), [key], "left")
    sole, repeated = rows.where(F.col(many).isNull()), rows.where(F.col(many))
    repeated = repeated.where(F.col(id_col).eqNullSafe(F.col(kept))).dropDuplicates([key])
    return sole.unionByName(repeated).select(docs.columns)
