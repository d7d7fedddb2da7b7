"""Which values a table may hold: filters that are tables themselves.

A filter is a table of 64-bit words. A value belongs to one word, by its hash, and sets four of
its bits. A value whose bits are not all set is certainly not there; the others are looked
up. A filter is built by one aggregate and asked by one join, both on the word's number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.operators.joins import fresh, plain_key

BITS_PER_VALUE = 12
SEEDS = (11, 12)


@dataclass(frozen=True)
class ValueFilter:
    """A filter at rest: for which property, where, and of how many words."""

    prop: str
    folder: str
    words: int


def words_for(n: int) -> int:
    return max(1, -(-n * BITS_PER_VALUE // 64))


def _hash(value: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), value)


def _word(value: Column, words: int) -> Column:
    return F.pmod(_hash(value, SEEDS[0]), F.lit(words))


def _bits(value: Column) -> Column:
    h = _hash(value, SEEDS[1])
    places = [F.shiftright(h, 6 * i).bitwiseAND(63).cast("int") for i in range(4)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places])


def _value(df: DataFrame, prop: str) -> Column:
    value = plain_key(F.col(prop), df.schema[prop].dataType)
    # equality of texts with a collation is not that of their bytes: all of them are looked up
    return F.lit(0) if value is None else value


def build(df: DataFrame, prop: str, words: int) -> DataFrame:
    """word, bits: the filter of the values of ``prop``."""
    value = _value(df, prop)
    marks = df.where(F.col(prop).isNotNull()).select(_word(value, words).alias("word"), _bits(value).alias("bits"))
    return marks.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def maybe_there(df: DataFrame, prop: str, filters: Sequence[tuple[DataFrame, int]]) -> DataFrame:
    """The distinct values of ``prop`` that any of the ``filters`` (table, words) may hold. Nulls are left out."""
    value, i, word, bits = _value(df, prop), *(fresh(c, df) for c in ("_filter", "_word", "_bits"))
    values = df.where(F.col(prop).isNotNull())
    asked = F.array(*[F.struct(F.lit(n).alias(i), _word(value, words).alias(word)) for n, (_, words) in enumerate(filters)])
    asked = values.select(prop, _bits(value).alias(bits), F.inline(asked))
    held = reduce(
        DataFrame.unionByName,
        [f.select(F.lit(n).alias(f"{i}_"), F.col("word").alias(f"{word}_"), F.col("bits").alias(f"{bits}_")) for n, (f, _) in enumerate(filters)],
    )
    same = (F.col(i) == F.col(f"{i}_")) & (F.col(word) == F.col(f"{word}_"))
    covered = F.col(bits) == F.col(bits).bitwiseAND(F.col(f"{bits}_"))
    return asked.join(held, same & covered, "left_semi").select(prop).distinct()
