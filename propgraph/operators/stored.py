"""Changes of a stored graph (see ``sources.buckets``): each returns the next version.

They mean what the functions of the same name without ``stored`` mean. An upsert or merge
reads and rewrites only the buckets that hold a key of the batch. Where it has nothing to set,
it only adds the rows that are new. A delete writes the keys it deletes, which hide the rows
until ``compact`` rewrites their buckets.

Constraints that are declared (``declare``) hold from then on: a batch of nodes that would break
one is refused before anything of it can be seen. Its values are held against the filters of
the stored ones, and only what these cannot rule out is looked up.

The batch is cast to the stored types. What a change reads twice is staged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from propgraph.functions.columns import all_set, holds
from propgraph.model import End
from propgraph.operators.checks import KINDS, key_violations, unique_violations
from propgraph.operators.joins import hub_join
from propgraph.operators.write import (
    REL_ID,
    lay_over,
    match_ends,
    not_loaded_yet,
    one_per_key,
    rename_keys,
    with_rel_ids,
)
from propgraph.sources.buckets import BUCKET, LOAD, Store, StoredTable, Tombs
from propgraph.sources.filters import maybe_there
from propgraph.staging import stage


class ConstraintError(ValueError):
    """A batch would break a constraint of the stored graph."""


def declare(store: Store, label: str, prop: str, kind: str) -> Store:
    """Put a property of a label under a constraint, 'unique' or 'key'; it must hold already.

    ``unique``: no value on two nodes; ``key``: moreover, a value on every node.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")
    table, load = store.nodes(label), store.next_version()
    rows = store.read(table).select(*table.schema.names)
    broken = unique_violations(rows, prop) if kind == "unique" else key_violations(rows, prop)
    _refuse(broken, prop, f"{label}.{prop} is not {kind}")
    known = prop in table.guarded()
    table = replace(table, constraints=tuple(dict.fromkeys([*table.constraints, (prop, kind)])))
    return store.commit({table.name: table if known else store.with_filters(table, rows, load, [prop])})


def _refuse(rows: DataFrame, prop: str, why: str) -> None:
    """Raise if there are ``rows``, with a few of their values."""
    if found := [r[0] for r in rows.select(prop).limit(5).collect()]:
        raise ConstraintError(f"{why}: {', '.join(map(str, found))}")


def _obey(store: Store, table: StoredTable, batch: DataFrame, upsert: bool) -> None:
    """Refuse a staged batch that breaks a constraint, in itself or with the stored rows.

    In an upsert the batch stands for the stored rows of its keys; these are no conflict.
    """
    keys = list(table.keys)
    for prop, kind in table.constraints:
        label = f"{table.name.removeprefix('nodes/')}.{prop}"
        if prop not in batch.columns:
            if kind == "key":
                new = batch
                if upsert:
                    known = store.read(table, _buckets(batch)).select(BUCKET, *keys)
                    new = batch.join(known, [BUCKET, *keys], "left_anti")
                _refuse(new, keys[0], f"nodes without {label}")
            continue
        if kind == "key":
            _refuse(batch.where(F.col(prop).isNull()), keys[0], f"nodes without {label}")
        _refuse(unique_violations(batch, prop), prop, f"{label} repeats in the batch")
        if not (filters := store.filters(table, prop)):
            continue
        maybe = stage(maybe_there(batch, prop, filters), "maybe")
        if maybe.isEmpty():
            continue
        # where the property is the key, its buckets hold all rows that can have it
        places = _buckets(maybe, table.bucket()) if keys == [prop] else None
        there = store.read(table, places).select(BUCKET, *dict.fromkeys([prop, *keys])).join(maybe, prop, "left_semi")
        if upsert:
            there = there.join(batch.select(BUCKET, *keys), [BUCKET, *keys], "left_anti")
        _refuse(there, prop, f"{label} is there already")


def _fitted(table: StoredTable, rows: DataFrame) -> tuple[StoredTable, DataFrame]:
    """The table with the batch's new columns, and the batch in the stored types, with its buckets."""
    known = {f.name: f for f in table.schema.fields}
    new = [StructField(f.name, f.dataType) for f in rows.schema.fields if f.name not in known]
    table = replace(table, schema=StructType([*table.schema.fields, *new]))
    cast = [F.col(c).cast(known[c].dataType).alias(c) if c in known else F.col(c) for c in rows.columns]
    rows = rows.select(*cast)
    return table, rows.withColumn(BUCKET, table.bucket())


def _buckets(rows: DataFrame, bucket: Column | None = None) -> list[int]:
    """The buckets that rows touch: at most as many as the table has."""
    found = rows.select((F.col(BUCKET) if bucket is None else bucket).alias(BUCKET)).distinct()
    return sorted(r[0] for r in found.collect())


def _added(store: Store, table: StoredTable, rows: DataFrame, load: int, unique: bool) -> StoredTable:
    if table.constraints and not unique:
        rows = stage(rows, "batch")
        _obey(store, table, rows, upsert=False)
    present = store.write(table, rows.hint("rebalance", F.col(BUCKET)), load)
    table = replace(table.holding((), load, present, add=True), unique=table.unique and unique)
    return store.with_filters(table, store.written(table, load), load) if present and table.constraints else table


def _merged(store: Store, table: StoredTable, winners: DataFrame, load: int) -> StoredTable:
    """Lay ``winners`` (one row per key, no null keys) over the buckets that they touch."""
    table, winners = _fitted(table, winners)
    staged = stage(winners, "winners")
    touched = _buckets(staged)
    if not touched:
        return table
    _obey(store, table, staged, upsert=True)
    old = store.read(table, touched).drop(LOAD)
    keys = [BUCKET, *table.keys]
    if set(winners.columns) == set(keys):
        known = old.select(*keys).join(staged, keys, "left_semi").distinct()
        return _added(store, table, staged.join(known, keys, "left_anti"), load, True)
    rows = lay_over(old, staged, keys)
    table = table.holding(touched, load, store.write(table, rows, load))
    # what the batch has replaced may stay in older filters: these only say maybe
    return store.with_filters(table, staged, load)


def upsert_stored_nodes(
    store: Store, label: str, incoming: DataFrame, order: Sequence[str] | None = None
) -> Store:
    table = store.nodes(label)
    winners = one_per_key(incoming, table.keys, order)
    return store.commit({table.name: _merged(store, table, winners, store.next_version())})


def append_stored_nodes(store: Store, label: str, incoming: DataFrame) -> Store:
    table, rows = _fitted(store.nodes(label), incoming)
    return store.commit({table.name: _added(store, table, rows, store.next_version(), False)})


def _end_columns(table: StoredTable, end: End) -> list[str]:
    """The relationship columns that refer to the key columns, in the order of these."""
    by_key = {key: col for col, key in end.cols.items()}
    return [by_key[key] for key in table.keys]


def _with_ends(store: Store, rel_type: str, rows: DataFrame) -> DataFrame:
    """The staged rows whose ends exist; only the buckets of their ends are read."""
    for end in store.ends[rel_type]:
        nodes = store.nodes(end.label)
        touched = _buckets(rows, nodes.bucket(_end_columns(nodes, end)))
        rows = match_ends(rows, (store.read(nodes, touched), end.cols), None, "left_semi")
    return rows


def merge_stored_rels(
    store: Store,
    rel_type: str,
    incoming: DataFrame,
    set_cols: Sequence[str] = (),
    match: bool = True,
) -> Store:
    """As ``merge_rels`` on the identity; with ``match`` the ends must exist, else they are taken to."""
    table = store.rels(rel_type)
    wanted = incoming.select(*dict.fromkeys([*table.keys, *set_cols])).where(all_set(table.keys))
    if match:
        wanted = _with_ends(store, rel_type, stage(wanted, "batch"))
    winners = one_per_key(wanted, table.keys, set_cols)
    return store.commit({table.name: _merged(store, table, winners, store.next_version())})


def upsert_stored_rels(
    store: Store, rel_type: str, incoming: DataFrame, set_cols: Sequence[str] | None = None
) -> Store:
    """As ``upsert_rels``: missing ends are created. Relationships and ends become visible at once."""
    table, load = store.rels(rel_type), store.next_version()
    if set_cols is None:
        set_cols = [c for c in incoming.columns if c not in table.keys]
    incoming = stage(incoming, "batch")
    ends = store.ends[rel_type]
    whole = incoming.where(all_set([*ends[0].cols, *ends[1].cols]))
    winners = one_per_key(whole.select(*dict.fromkeys([*table.keys, *set_cols])), table.keys, set_cols)
    changed = {table.name: _merged(store, table, winners, load)}
    missing: dict[str, DataFrame] = {}
    for end in ends:
        keys = incoming.select(*[F.col(col).alias(key) for col, key in end.cols.items()])
        missing[end.label] = missing[end.label].unionByName(keys) if end.label in missing else keys
    for label, keys in missing.items():
        nodes = store.nodes(label)
        changed[nodes.name] = _merged(store, nodes, one_per_key(keys, nodes.keys), load)
    return store.commit(changed)


def append_stored_rels(
    store: Store, rel_type: str, incoming: DataFrame, match: bool = True, load: str | None = None
) -> Store:
    """Create a relationship per row; with ``match`` and match of its ends, as ``append_rels``.

    With the id of its ``load`` a repeated append adds nothing that is there.
    """
    rows = incoming
    if match:
        rows = stage(incoming, "batch")
        for end in store.ends[rel_type]:
            nodes = store.nodes(end.label)
            touched = _buckets(rows, nodes.bucket(_end_columns(nodes, end)))
            rows = match_ends(rows, (store.read(nodes, touched), end.cols), None)
    known = store.rels(rel_type)
    if load is not None:
        rows = with_rel_ids(rows, load)
    table, rows = _fitted(known, rows)
    if load is not None and REL_ID in known.schema.names:
        rows = stage(rows, "created")
        rows = not_loaded_yet(rows, store.read(known, _buckets(rows)), load)
    return store.commit({table.name: _added(store, table, rows, store.next_version(), False)})


def _tombs_of(table: StoredTable, load: int) -> str:
    return f"tombs/{table.name}/{load}"


def _bury(store: Store, table: StoredTable, where: Column, load: int) -> Tombs | None:
    """Write what tells the rows apart for which ``where`` holds: the key, or all columns where keys repeat.

    Equal rows meet the same fate, so all columns are enough.
    """
    cols = list(table.keys if table.unique else table.schema.names)
    gone = store.read(table).where(holds(where)).select(*cols)
    gone = gone if table.unique else gone.distinct()
    folder = _tombs_of(table, load)
    gone.write.mode("overwrite").parquet(f"{store.path}/{folder}")
    tombs = Tombs(folder, load, {c: c for c in cols}, not table.unique)
    return None if store.spark.read.schema(gone.schema).parquet(f"{store.path}/{folder}").isEmpty() else tombs


def delete_stored_rels(store: Store, rel_type: str | None = None, where: Column | None = None) -> Store:
    """Delete the relationships of one type (default: all) for which ``where`` holds (default: all)."""
    changed, load = {}, store.next_version()
    for name in store.ends if rel_type is None else [rel_type]:
        table = store.rels(name)
        if where is None:
            changed[table.name] = table.emptied()
        elif tombs := _bury(store, table, where, load):
            changed[table.name] = replace(table, tombs=(*table.tombs, tombs))
    return store.commit(changed)


def delete_stored_nodes(
    store: Store, label: str | None = None, where: Column | None = None, detach: bool = False
) -> Store:
    """As ``delete_nodes``. The keys of deleted nodes also hide the relationships that are detached."""
    load = store.next_version()
    tables, gone = dict(store.tables), {}
    for name in store.labels() if label is None else [label]:
        table = store.nodes(name)
        if where is None:
            tables[table.name] = table.emptied()
            gone[name] = None
        elif tombs := _bury(store, table, where, load):
            tables[table.name] = replace(table, tombs=(*table.tombs, tombs))
            gone[name] = tombs
    for rel_type, ends in store.ends.items():
        table = store.rels(rel_type)
        for end in ends:
            if end.label not in gone:
                continue
            tombs = gone[end.label]
            if not detach:
                left = store.read(table).where(all_set(end.cols))
                if tombs is not None:
                    keys = store.spark.read.parquet(f"{store.path}/{tombs.folder}")
                    left = hub_join(left, rename_keys(keys, end.cols), list(end.cols), "left_semi")
                if not left.isEmpty():
                    raise ValueError(f"{end.label} nodes still have {rel_type} relationships; delete those first or detach")
            elif tombs is None:
                tables[table.name] = table.emptied()
            elif any(table.loads):
                now = tables[table.name]
                tables[table.name] = replace(now, tombs=(*now.tombs, Tombs(tombs.folder, load, dict(end.cols))))
    return store.commit({n: t for n, t in tables.items() if t is not store.tables[n]})


def _with_dead(store: Store, table: StoredTable) -> set[int]:
    """The buckets that hold deleted rows.

    A table's own tombs are keys of rows that it had, so their buckets say it, unless these were
    rewritten since. Only tombs of other tables' keys are joined with the rows.
    """
    own = [t for t in table.tombs if t.folder == _tombs_of(table, t.load)]
    others = tuple(t for t in table.tombs if t not in own)
    found = set(_buckets(store.hidden(store.raw(table), replace(table, tombs=others), "left_semi"))) if others else set()
    for tombs in own:
        keys = store.spark.read.parquet(f"{store.path}/{tombs.folder}")
        places = _buckets(keys, table.bucket([tombs.cols[k] for k in table.keys]))
        found |= {b for b in places if any(v < tombs.load for v in table.loads[b])}
    return found


def compact(store: Store) -> Store:
    """Rewrite the buckets that hold deleted rows or lie in several folders; no tomb and one filter a property is left."""
    changed, load = {}, store.next_version()
    for table in store.tables.values():
        touched = {b for b, loads in enumerate(table.loads) if len(loads) > 1}
        touched |= _with_dead(store, table)
        if not touched and not table.tombs and len(table.filters) <= len(table.guarded()):
            continue
        after = replace(table, tombs=(), filters=())
        if touched:
            rows = store.read(table, touched).drop(LOAD).hint("rebalance", F.col(BUCKET))
            after = after.holding(touched, load, store.write(table, rows, load))
        changed[table.name] = store.with_filters(after, store.read(after).select(*table.schema.names), load)
    return store.commit(changed) if changed else store
