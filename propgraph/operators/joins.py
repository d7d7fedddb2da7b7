from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, or a longer one that no column of ``frames`` has, whatever its case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def common_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[DataType]:
    try:
        both = left.select(*on).unionAll(right.select(*on))
        return [f.dataType for f in both.schema]
    except Exception as e:
        raise TypeError(f"the join columns {list(on)} have no common type") from e


def plain_key(col: Column, kind: DataType) -> Column | None:
    """A value that is the same for equal keys; None where equality is not that of the bytes."""
    if isinstance(kind, StringType) and kind.collation != "UTF8_BINARY":
        return None
    if isinstance(kind, (FloatType, DoubleType)):
        return col.cast("double") + F.lit(0.0)  # -0.0 equals 0.0
    return col


def hub_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on the equally named columns ``on``; one key may hold much of ``left``.

    ``how`` is inner, left, left_semi or left_anti; the join columns keep the type they
    have on the left. Keys of two types are compared in the type that holds both, as
    Spark's own joins do.

    Adaptive execution splits a hot partition of the left side only if both inputs come
    straight from a shuffle made for this join. An aggregate below the join would lend
    its own partitioning instead and rule that out. A second join column that follows
    from the key makes Spark shuffle both sides for the join; with a side small enough
    to broadcast, Spark broadcasts as usual and no shuffle takes place.
    """
    on = list(on)
    kinds = common_types(left, right, on)
    there = [fresh(f"_right_{i}", left, right) for i in range(len(on))]
    split = fresh("_split", left, right)
    hashed = [plain_key(F.col(c).cast(kind), kind) for c, kind in zip(on, kinds, strict=True)]
    hashed = [h for h in hashed if h is not None]
    rest = [c for c in right.columns if c not in on]
    right_split = split + "r"

    left_part = F.xxhash64(*hashed).bitwiseAND(F.lit(1)) if hashed else None
    right = right.select(
        *[F.col(c).cast(kind).alias(n) for c, kind, n in zip(on, kinds, there, strict=True)],
        *([left_part.alias(right_split)] if hashed else []),  # never null: adds no null test to either side
        *rest,
    )
    same = [F.col(c).cast(kind) == F.col(n) for c, kind, n in zip(on, kinds, there, strict=True)]
    columns = left.columns
    if hashed:
        left = left.withColumn(split, left_part)
        same.append(F.col(split) == F.col(right_split))
    joined = left.join(right, same, how)
    return joined.select(*columns) if how in ("left_semi", "left_anti") else joined.select(*columns, *rest)
