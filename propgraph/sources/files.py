"""Small text files beside the data (what a version holds, which steps are done), by Hadoop's file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that appears whole or not at all; it is an error if there is one already."""
    place, fs = _at(spark, path)
    if fs.exists(place):
        raise FileExistsError(path)
    draft, _ = _at(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(draft, place):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    place, fs = _at(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if it is not there."""
    place, fs = _at(spark, folder)
    if not fs.exists(place):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(place))
