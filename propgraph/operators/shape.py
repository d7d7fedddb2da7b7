"""From flat tables to node sets, keyed rows and relationship columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.operators.joins import fresh
from propgraph.staging import stage

# monotonically_increasing_id: partition number above, row number in the lower 33 bits
_ROW_BITS = 33


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the columns in ``names`` (column -> property), renamed. Dots are allowed on the left."""
    return df.select(*[F.col(f"`{col}`").alias(prop) for col, prop in names.items()])


def node_set(df: DataFrame, cols: str | Sequence[str], name: str) -> DataFrame:
    """The distinct non-null values of one or more columns, as one column ``name``.

    Several columns are unpivoted in one pass over ``df`` rather than read once each.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    if len(cols) == 1:
        values = df.select(F.col(cols[0]).alias(name))
    else:
        values = df.select(F.explode(F.array(*cols)).alias(name))
    return values.where(F.col(name).isNotNull()).distinct()


def copies(df: DataFrame, n: int) -> DataFrame:
    """The bag union of ``n`` copies of ``df``, read once."""
    number = fresh("_copy", df)
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias(number)).drop(number)


def head(df: DataFrame, order_cols: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_cols).limit(n)


def row_key(
    df: DataFrame,
    order_cols: Sequence[str],
    name: str = "key",
    buckets: int | None = None,
    keep: Sequence[str] | None = None,
    first: int = 0,
) -> DataFrame:
    """Number the rows from ``first`` (0, 1, 2, ...) in the order of ``order_cols``, as bigint ``name``.

    ``order_cols`` must be unique together; the key then depends on the data alone.
    Rows are range-partitioned into ``buckets`` (default: the shuffle partitions),
    sorted inside each and written once (see ``staging``), so all later reads agree
    on the same numbers. Key = rows in the buckets before + place in the bucket.
    Only the row count per bucket reaches the driver. ``keep`` limits the columns
    that are written and returned.

    Runs jobs when called: the range sample, the write, the count.
    """
    return _numbered(_ranged(df, order_cols, buckets), order_cols, name, keep, first)


def _ranged(df: DataFrame, order_cols: Sequence[str], buckets: int | None = None) -> DataFrame:
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order_cols)


def _numbered(
    df: DataFrame, order_cols: Sequence[str], name: str, keep: Sequence[str] | None, first: int
) -> DataFrame:
    """``row_key`` of range-partitioned rows."""
    spark = df.sparkSession
    keep = list(df.columns if keep is None else keep)
    slot, bucket, start = (fresh(c, df) for c in ("_slot", "_bucket", "_start"))
    ordered = df.sortWithinPartitions(*order_cols).select(*keep, F.monotonically_increasing_id().alias(slot))
    rows = stage(ordered, "keyed").withColumn(bucket, F.shiftright(slot, _ROW_BITS))
    sizes = sorted(rows.groupBy(bucket).agg(F.count("*")).collect())
    starts = accumulate((size for _, size in sizes), initial=first)
    offsets = spark.createDataFrame([(b, at) for (b, _), at in zip(sizes, starts)], f"{bucket} bigint, {start} bigint")
    place = F.col(slot).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # offsets has one row per bucket
    return rows.join(F.broadcast(offsets), bucket).select((F.col(start) + place).alias(name), *keep)


def extend_keys(keyed: DataFrame, incoming: DataFrame, order_cols: Sequence[str], name: str = "key") -> DataFrame:
    """``keyed`` and, numbered after its greatest key, the rows of ``incoming`` that it does not have yet.

    ``order_cols`` are unique together and tell the rows apart (null equals null). No key that
    was given ever changes: of a row that is there already nothing is added, so a load that is
    given twice adds nothing the second time. New rows are numbered in the order of
    ``order_cols`` within their load; repeated ones among them count once. Columns that only
    one side has are null in the other's rows.

    One shuffle serves the search and the numbering: the keys that are there are dealt by range
    among the incoming rows. Both are read twice, so they should be stored tables. Runs jobs when called.
    """
    order_cols = list(order_cols)
    held, new = fresh("_held", incoming), fresh("_new", incoming)
    rest = [c for c in incoming.columns if c not in order_cols]
    rows = incoming.select(*order_cols, F.struct(F.lit(True).alias(new), *rest).alias(held))
    known = keyed.select(*order_cols, F.lit(None).cast(rows.schema[held].dataType).alias(held))
    met = _ranged(rows.unionByName(known), order_cols).groupBy(*order_cols)
    found = met.agg(F.first(held).alias(held), F.bool_and(F.col(held).isNotNull()).alias(new)).where(new)
    found = found.select(*[F.col(c) if c in order_cols else F.col(held)[c].alias(c) for c in incoming.columns])
    last = keyed.agg(F.max(name)).first()[0]
    return keyed.unionByName(_numbered(found, order_cols, name, None, 0 if last is None else last + 1), allowMissingColumns=True)
