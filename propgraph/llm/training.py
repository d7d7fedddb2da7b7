"""Labelled rows for fitting: which are held out, and a bounded sample of the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 0 by 5; true for a null id, which has no text."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def sample(labels: DataFrame, label: str, value: int, most: int) -> tuple[DataFrame, int]:
    """Ids of at most ``most`` training rows whose ``label`` is ``value``, and how many there are in all.

    The choice is by hash of the id, so it is the same in every run. ``most`` bounds what
    is sent to all tasks.
    """
    rows = labels.where((F.col(label) == value) & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return chosen.withColumn("label", F.lit(value)), rows.count()
