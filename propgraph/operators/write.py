"""Writes as functions: the new frame is built from the existing and the incoming one.

Overwrite means upsert by key, append adds rows without looking, and match means
that the ends of a relationship must exist already. A null key never matches.

An upsert runs two jobs when called: they write the deduplicated input and the new
rows among it (see ``staging``). The second and the result each read the existing
frame, so it should be a stored table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from propgraph.functions.columns import all_set
from propgraph.model import PropertyGraph
from propgraph.operators.joins import fresh, hub_join
from propgraph.staging import stage

# of these a maximum is a hash aggregate
FIXED_WIDTH = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)

REL_ID = "rel_id"
DIGEST = 32  # hexadecimal digits of a row's digest in an id
WORD = 60  # copies of a row to a number

Match = tuple[DataFrame, Mapping[str, str]]


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the greatest, compared column by column from left to right.

    The comparison starts with ``order`` and goes on with the other columns, so the
    winner depends on the data alone. Rows with a null key are dropped. It is an
    aggregate, so many rows for one key are combined before the shuffle.
    """
    keys, order = list(keys), list(order or [])
    values = [c for c in df.columns if c not in keys]
    ranked = order + [c for c in values if c not in order]
    df = df.where(all_set(keys))
    if not ranked:
        return df.select(*keys).distinct()
    if len(ranked) == 1:
        # a bare maximum, unlike that of a struct, is a hash aggregate
        return df.groupBy(*keys).agg(F.max(ranked[0]).alias(ranked[0]))
    if len(ranked) == 2 and all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in ranked):
        return _greatest_pair(df, keys, *ranked).select(*keys, *values)
    best = fresh("_best", df)
    found = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias(best))
    return found.select(*keys, *[F.col(best)[c].alias(c) for c in values])


def _greatest_pair(df: DataFrame, keys: list[str], first: str, second: str) -> DataFrame:
    """The greatest (first, second) per key by hash aggregates; null is below every value.

    The copies of a pair are combined before either shuffle.
    """
    pairs = df.groupBy(*keys, first).agg(F.max(second).alias(second))
    top = F.max(first)
    of_null = F.max(F.when(F.col(first).isNull(), F.col(second)))
    return pairs.groupBy(*keys).agg(
        top.alias(first), F.when(top.isNull(), of_null).otherwise(F.max_by(second, first)).alias(second)
    )


def _laid(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> tuple[Column, list[Column], list[Column], dict]:
    """How to lay rows over others: the match, the columns after it, those that are new, and fresh names for the incoming."""
    renamed = {c: fresh(f"_new_{c}", existing, incoming) for c in incoming.columns}
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(renamed[k]) for k in keys])
    hit = F.col(renamed[keys[0]]).isNotNull()  # a key is never null, so it marks a match; an incoming null does overwrite
    values = [c for c in incoming.columns if c not in keys]
    updated = [
        F.when(hit, F.col(renamed[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in existing.columns
    ]
    added = [F.col(renamed[c]).alias(c) for c in values if c not in existing.columns]
    return same, updated, added, renamed


def _upsert(existing: DataFrame, winners: DataFrame, keys: Sequence[str], bulk: bool = False) -> DataFrame:
    """Lay ``winners`` (one row per key, no null keys) over ``existing``.

    Two parts: the existing rows, updated where a winner matches, and the winners
    whose key is new. The existing keys are first cut down to those of the winners:
    Spark broadcasts a small batch, so ``existing`` is not shuffled for it, and beyond
    that one shuffle of the keys serves the cut, the distinct and the comparison.

    The winners and the new ones among them are staged, so the result holds the plan of
    ``existing`` once, and a chain of upserts grows by one plan each time.

    ``bulk`` does both in one full outer join, for a batch of the size of ``existing``:
    it reads that once, but can neither broadcast nor split a hot key.
    """
    keys = list(keys)
    values = [c for c in winners.columns if c not in keys]
    if bulk:
        return lay_over_all(existing, winners, keys)
    if not values:
        # nothing to set, so only the new keys matter
        same, _, _, renamed = _laid(existing, winners, keys)
        known = existing.select(*keys).join(winners.withColumnsRenamed(renamed), same, "left_semi").distinct()
        created = winners.join(known, keys, "left_anti").select(*keys)
        return existing.unionByName(stage(created, "created"), allowMissingColumns=True)
    return lay_over(existing, stage(winners, "winners"), keys)


def lay_over_all(existing: DataFrame, winners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``lay_over``, in one full outer join, with nothing staged."""
    keys = list(keys)
    same, updated, added, renamed = _laid(existing, winners, keys)
    merged_keys = {k: F.coalesce(F.col(k), F.col(renamed[k])).alias(k) for k in keys}
    columns = [merged_keys.get(c, u) for c, u in zip(existing.columns, updated, strict=True)]
    return existing.join(winners.withColumnsRenamed(renamed), same, "full_outer").select(*columns, *added)


def lay_over(existing: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` updated where a row of ``staged`` (one per key, no null keys) matches, and the rows whose key is new."""
    keys = list(keys)
    same, updated, added, renamed = _laid(existing, staged, keys)
    incoming = staged.withColumnsRenamed(renamed).where(all_set(renamed[k] for k in keys))  # as the joins imply: one shuffle serves all
    known = existing.select(*keys).join(incoming.select(*[renamed[k] for k in keys]), same, "left_semi").distinct()
    created = incoming.join(known, same, "left_anti").select(*[F.col(n).alias(c) for c, n in renamed.items()])
    created = stage(created, "created")
    kept = existing.join(incoming, same, "left").select(*updated, *added)
    return kept.unionByName(created, allowMissingColumns=True)


def upsert_nodes(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    bulk: bool = False,
) -> DataFrame:
    """Upsert nodes by key. Incoming columns win; columns absent from the input are kept.

    ``bulk`` says that the batch is about as large as ``existing`` (see ``_upsert``).
    """
    return _upsert(existing, one_per_key(incoming, keys, order), keys, bulk)


def append_nodes(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append nodes without matching; may repeat keys, which ``unique_violations`` finds."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def match_ends(rels: DataFrame, src: Match | None, dst: Match | None, how: str = "inner") -> DataFrame:
    """Keep the relationships whose ends exist.

    ``src`` and ``dst`` are (node frame, {relationship column: node key}). ``inner``
    gives one row per pair of matching nodes, ``left_semi`` one per relationship.
    """
    columns = rels.columns
    for nodes, cols in (end for end in (src, dst) if end is not None):
        rels = hub_join(rels, rename_keys(nodes, cols), list(cols), how).select(*columns)
    return rels


def rename_keys(nodes: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """The node keys under the names of the relationship columns that refer to them."""
    return nodes.select(*[F.col(key).alias(col) for col, key in cols.items()])


def _counted(rels: DataFrame, n: str, digest: str) -> DataFrame:
    """Each distinct row of ``rels`` with its number and a digest of 16 bytes."""
    columns = rels.columns
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}) if columns else F.lit("")
    counted = rels.groupBy(*columns).agg(F.count("*").alias(n))
    return counted.withColumn(digest, F.unhex(F.substring(F.sha2(row, 256), 1, DIGEST)))


def _rel_id(load: str, digest: str, copy: Column) -> Column:
    return F.concat_ws("-", F.lit(load), F.lower(F.hex(digest)), copy.cast("string"))


def with_rel_ids(rels: DataFrame, load: str, name: str = REL_ID) -> DataFrame:
    """``rels`` with an id each that depends on the load's id and the row alone.

    Equal rows are told apart by a copy number: they are counted first and dealt out again, so
    no task has to gather them. The id is the load's, a digest of the row, and that number.
    """
    n, digest, copy = (fresh(c, rels) for c in ("_copies", "_digest", "_copy"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))).alias(copy)
    dealt = _counted(rels, n, digest).select(*rels.columns, digest, copies)
    return dealt.select(*rels.columns, _rel_id(load, digest, F.col(copy)).alias(name))


def not_loaded_yet(rels: DataFrame, existing: DataFrame, load: str, name: str = REL_ID) -> DataFrame:
    """Those of ``rels`` (with ids of ``load``) that ``existing`` does not have; of that only the ids of this load are read."""
    if name not in existing.columns:
        return rels
    known = existing.where(F.col(name).startswith(f"{load}-")).select(name)
    return rels.join(known, name, "left_anti").select(*rels.columns)


def new_with_rel_ids(rels: DataFrame, existing: DataFrame, load: str, name: str = REL_ID) -> DataFrame:
    """``not_loaded_yet`` of ``with_rel_ids``, without the ids of all copies in a shuffle.

    The copies of a row that ``existing`` has are bits, WORD of them to a number. So what is
    joined is each distinct row once, or once for each WORD copies of it.
    """
    if name not in existing.columns:
        return with_rel_ids(rels, load, name)
    columns = rels.columns
    n, digest, word, bits, at = (fresh(c, rels) for c in ("_copies", "_digest", "_word", "_bits", "_at"))
    rest = F.substring(F.col(name), len(load) + 2, DIGEST + 20)
    # other loads' ids may begin alike
    ours = F.col(name).startswith(f"{load}-") & rest.rlike(f"^[0-9a-f]{{{DIGEST}}}-[1-9][0-9]{{0,17}}\\z")
    place = F.substring(rest, DIGEST + 2, 18).cast("long") - 1
    known = existing.where(ours).select(F.unhex(F.substring(rest, 1, DIGEST)).alias(digest), place.alias(at))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(WORD)).cast("int"))
    known = known.groupBy(digest, F.floor(F.col(at) / WORD).alias(word)).agg(F.bit_or(bit).alias(bits))
    last = F.floor((F.col(n) - 1) / WORD)
    counted = _counted(rels, n, digest).select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias(word))
    open_ = counted.join(known, [digest, word], "left").select(
        "*", F.explode(F.sequence(F.lit(0), F.least(F.lit(WORD), F.col(n) - F.col(word) * WORD).cast("int") - 1)).alias(at)
    )
    open_ = open_.where(F.call_function("shiftright", F.coalesce(bits, F.lit(0).cast("long")), F.col(at)).bitwiseAND(F.lit(1)) == 0)
    return open_.select(*columns, _rel_id(load, digest, F.col(word) * WORD + F.col(at) + 1).alias(name))


def append_rels(
    existing: DataFrame,
    incoming: DataFrame,
    src: Match | None = None,
    dst: Match | None = None,
    load: str | None = None,
) -> DataFrame:
    """Create one relationship per incoming row and match of its ends.

    An end that is not given is taken to exist. ``load`` names the load: each relationship then
    gets an id (see ``with_rel_ids``) in column ``REL_ID``, and one that is there already is
    not created again, so a load may be repeated, whole or where it was broken off.
    """
    created = match_ends(incoming, src, dst)
    if load is not None:
        created = new_with_rel_ids(created, existing, load)
    return existing.unionByName(created, allowMissingColumns=True)


def merge_rels(
    existing: DataFrame,
    incoming: DataFrame,
    identity: Sequence[str],
    set_cols: Sequence[str] = (),
    src: Match | None = None,
    dst: Match | None = None,
) -> DataFrame:
    """Merge relationships on ``identity`` and set ``set_cols``.

    Among several incoming rows of one identity the greatest ``set_cols`` win,
    compared in the order given. A row with a null in its identity merges with
    nothing and is dropped. With ``src``/``dst`` the ends must exist; an end that is
    not given is taken to exist.
    """
    wanted = incoming.select(*dict.fromkeys([*identity, *set_cols]))
    matched = match_ends(wanted, src, dst, "left_semi")
    return _upsert(existing, one_per_key(matched, identity, set_cols), identity)


def upsert_endpoints(graph: PropertyGraph, rel_type: str, incoming: DataFrame) -> PropertyGraph:
    """Create the nodes that ``incoming`` relationships refer to and that are missing."""
    rels = graph.rels[rel_type]
    for end in (rels.source, rels.target):
        nodes = graph.nodes[end.label]
        keys = incoming.select(*[F.col(col).alias(key) for col, key in end.cols.items()])
        graph = graph.with_nodes(end.label, replace(nodes, df=upsert_nodes(nodes.df, keys, nodes.keys)))
    return graph


def upsert_rels(
    graph: PropertyGraph, rel_type: str, incoming: DataFrame, set_cols: Sequence[str] | None = None
) -> PropertyGraph:
    """Upsert relationships on their identity, and their ends as well.

    Reads ``incoming`` three times, so stage a costly one first.
    """
    rels = graph.rels[rel_type]
    if set_cols is None:
        set_cols = [c for c in incoming.columns if c not in rels.identity]
    merged = merge_rels(rels.df, incoming.where(all_set([*rels.source.cols, *rels.target.cols])), rels.identity, set_cols)
    return upsert_endpoints(graph, rel_type, incoming).with_rels(rel_type, rels.with_df(merged))
