from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_edge_list(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a headerless comma-separated edge list.

    A bad line is kept: its unreadable fields are null and ``_corrupt`` holds its text.
    """
    fields = [*_as_schema(schema).fields, T.StructField(CORRUPT, T.StringType())]
    return spark.read.csv(
        path, schema=T.StructType(fields), header=False, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a CSV with a header line. Without a schema the types cost a pass of their own."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.csv(path, header=True, schema=_as_schema(schema))
