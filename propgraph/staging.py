"""Durable intermediate tables.

Some steps must see the very same rows twice (a dense key needs the row counts of
the partitions it numbers; batches are read one after another). They write their
input once, to a folder that all executors share, and read it back: the lineage
ends there, so a lost executor costs a re-read and nothing is computed anew.

The folder is, in this order: the one given to ``staging``, the setting
``spark.checkpoint.dir``, the checkpoint folder of the Spark context. Without any of
them staging fails: a folder that only one machine sees is never chosen silently.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Shuffle files of a finished write are of no more use; Spark deletes them at once if this is set
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass
class _Scope:
    folder: str | None
    paths: list[str] = field(default_factory=list)


_scope: ContextVar[_Scope | None] = ContextVar("propgraph_staging", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, without a slash at its end."""
    scope = _scope.get()
    path = (scope and scope.folder) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        context = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = context.get() if context.isDefined() else None
    if path:
        return path.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def use_local_folder(spark: SparkSession) -> None:
    """For one machine only (``local``, ``local[n]``): where no folder is set, make one for this session.

    For entry points of tests and benches; the library itself never calls it.
    """
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        return
    try:
        shared_dir(spark)
    except ValueError:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="propgraph-"))


@contextmanager
def staging(spark: SparkSession, folder: str | None = None) -> Iterator[None]:
    """Delete at the end of the block what was staged in it; frames that read it are void then.

    ``folder`` is where the block stages, if not where the block around it does, or in the
    session's folder. Outside of any
    block what is staged stays, since the caller's frames still read it.
    """
    outer = _scope.get()
    scope = _Scope(folder or (outer.folder if outer else None))
    token = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in scope.paths:
            discard(spark, path)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; the block of ``staging`` around it deletes it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if scope := _scope.get():
        scope.paths.append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that no frame needs any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def _shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def write_once(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` and return the frame that reads it."""
    spark = df.sparkSession
    with _shuffles_cleaned(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the frame that reads it."""
    return write_once(df, new_path(df.sparkSession, name), partition_by)
