from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_set(cols: Iterable[str]) -> Column:
    """True where none of the columns is null."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def holds(condition: Column) -> Column:
    """The condition with null read as false, so that it can be negated safely."""
    return F.coalesce(condition, F.lit(False))


def group_digest(col: Column) -> Column:
    """What the group of a value is taken from: the leading 32 bits of its md5, as bigint."""
    return F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_group(col: str | Column, n: int) -> Column:
    """A group 0..n-1 that depends on the value only."""
    return (group_digest(F.col(col) if isinstance(col, str) else col) % n).cast("int")


def snake_group(rank: Column, n: int) -> Column:
    """Deal ranks 0, 1, 2, ... over n groups, there and back again."""
    seat = rank % n
    forward = F.floor(rank / n) % 2 == 0
    return F.when(forward, seat).otherwise(n - 1 - seat).cast("int")


def batch_of(source_group: str, target_group: str, n: int) -> Column:
    """The batch of a block; a batch pairs each source group with one target group."""
    return F.pmod(F.col(target_group) - F.col(source_group), F.lit(n)).cast("int")
