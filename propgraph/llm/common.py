"""What the text operators share: tables, whole texts, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, most: str = "4m") -> None:
    """Hand texts to Python in batches of a few MB; a session that has the option set keeps it."""
    if spark.conf.get(BATCH_BYTES, None) in (None, "64MB", "67108864b"):  # Spark's own choice
        spark.conf.set(BATCH_BYTES, most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(col), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        step = max(1, batch.num_rows * limit // max(1, batch.column(column).nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


class Remembered(dict):
    """What ``make`` gives for a string, made on demand.

    Once ``most`` strings are held, they become the old ones and those from before go; an
    old one that is met again stays. So frequent strings are kept and the memory is bounded.
    Strings longer than ``longest`` are never held.
    """

    def __init__(self, make: Callable[[str], Any], most: int, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest
        self.old: dict[str, Any] = {}

    def __missing__(self, text: str) -> Any:
        if (value := self.old.get(text)) is None:
            value = self.make(text)
            if len(text) > self.longest:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[text] = value
        return value
