"""A graph at rest that changes by small steps: tables cut into buckets by key, versions that share them.

Below the folder of a store:

- ``<table>/pg_load=<v>/pg_bucket=<b>/`` the rows of bucket b as version v wrote them; a table
  is ``nodes/<label>`` or ``rels/<type>``, and a row's bucket is a hash of its key or identity;
- ``tombs/<table>/<v>/`` keys that version v deleted; they hide rows that older versions wrote;
- ``filters/<table>/<property>/<v>/`` which values of a property under a constraint there may be;
- ``versions/<v>.json`` what a version consists of: for each bucket of each table the versions
  whose folders hold it, the tombs in force, keys, ends and schemas.

A change writes only the buckets it touches and then, as its last act, the next version's
file; what it leaves alone is referred to. So a change that fails is never seen, its
rest is overwritten by the next try, and a reader of an older version is not disturbed.
One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from propgraph.model import End, Nodes, PropertyGraph, Rels
from propgraph.operators.joins import plain_key
from propgraph.sources import files
from propgraph.sources.filters import ValueFilter, build, words_for

LOAD, BUCKET = "pg_load", "pg_bucket"


@dataclass(frozen=True)
class Tombs:
    """Keys deleted by version ``load``: ``cols`` maps columns of the table to those of the folder."""

    folder: str
    load: int
    cols: Mapping[str, str]
    null_safe: bool = False


@dataclass(frozen=True)
class StoredTable:
    """``loads`` has for each bucket the versions whose folders hold its rows.

    ``unique`` says that no two rows share a key and none lacks one. ``constraints`` are
    (property, 'unique' or 'key'); for each such property every value that the table has is in
    one of its ``filters``.
    """

    name: str
    keys: tuple[str, ...]
    schema: StructType
    loads: tuple[tuple[int, ...], ...]
    unique: bool
    tombs: tuple[Tombs, ...] = ()
    constraints: tuple[tuple[str, str], ...] = ()
    filters: tuple[ValueFilter, ...] = ()

    def bucket(self, cols: Sequence[str] | None = None) -> Column:
        """The bucket of a row whose key is in ``cols`` (default: the key columns), as the stored type."""
        cols = cols or self.keys
        kinds = [self.schema[k].dataType for k in self.keys]
        plain = [plain_key(F.col(c).cast(kind), kind) for c, kind in zip(cols, kinds, strict=True)]
        plain = [c for c in plain if c is not None]
        hashed = F.xxhash64(*plain) if plain else F.lit(0)
        return F.pmod(hashed, F.lit(len(self.loads))).cast("int")

    def holding(self, buckets: Iterable[int], load: int, present: Iterable[int], add: bool = False) -> StoredTable:
        """The table after ``load`` wrote ``buckets``, of which ``present`` have rows."""
        touched, found = set(buckets), set(present)
        loads = tuple(
            (old if add or b not in touched else ()) + ((load,) if b in found else ()) for b, old in enumerate(self.loads)
        )
        return replace(self, loads=loads)

    def emptied(self) -> StoredTable:
        return replace(self, loads=((),) * len(self.loads), tombs=(), filters=())

    def guarded(self) -> list[str]:
        """The properties under a constraint."""
        return list(dict.fromkeys(prop for prop, _ in self.constraints))


@dataclass(frozen=True)
class Store:
    """One version of a stored graph; changes return the next one."""

    spark: SparkSession
    path: str
    version: int
    tables: Mapping[str, StoredTable]
    ends: Mapping[str, tuple[End, End]]

    def nodes(self, label: str) -> StoredTable:
        return self.tables[f"nodes/{label}"]

    def rels(self, rel_type: str) -> StoredTable:
        return self.tables[f"rels/{rel_type}"]

    def labels(self) -> list[str]:
        return [n.removeprefix("nodes/") for n in self.tables if n.startswith("nodes/")]

    def raw(self, table: StoredTable, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of the folders in force, deleted ones too, with ``LOAD`` and ``BUCKET``."""
        wanted = range(len(table.loads)) if buckets is None else sorted(set(buckets))
        root = f"{self.path}/{table.name}"
        paths = [f"{root}/{LOAD}={v}/{BUCKET}={b}" for b in wanted for v in table.loads[b]]
        schema = StructType([*table.schema.fields, StructField(LOAD, IntegerType()), StructField(BUCKET, IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*paths)

    def hidden(self, rows: DataFrame, table: StoredTable, how: str = "left_anti") -> DataFrame:
        """The rows that no tomb covers (``left_semi``: that one covers). Tombs on the same columns are joined once."""
        groups: dict[tuple, list[Tombs]] = {}
        for tombs in table.tombs:
            groups.setdefault((tuple(tombs.cols), tombs.null_safe), []).append(tombs)
        found = []
        for (cols, null_safe), members in groups.items():
            sets = [
                self.spark.read.parquet(f"{self.path}/{t.folder}").select(
                    *[F.col(t.cols[c]).alias(f"{BUCKET}_{i}") for i, c in enumerate(cols)], F.lit(t.load).alias(f"{LOAD}_dead")
                )
                for t in members
            ]
            dead = reduce(DataFrame.unionByName, sets)
            same = [
                F.col(c).eqNullSafe(F.col(f"{BUCKET}_{i}")) if null_safe else F.col(c) == F.col(f"{BUCKET}_{i}")
                for i, c in enumerate(cols)
            ]
            cond = reduce(lambda a, b: a & b, [*same, F.col(LOAD) < F.col(f"{LOAD}_dead")])
            if how == "left_anti":
                rows = rows.join(dead, cond, how)
            else:
                found.append(rows.join(dead, cond, how))
        return rows if how == "left_anti" else reduce(DataFrame.unionByName, found)

    def read(self, table: StoredTable, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a table, or of some of its buckets, with ``LOAD`` and ``BUCKET``."""
        return self.hidden(self.raw(table, buckets), table)

    def graph(self) -> PropertyGraph:
        """The frames of this version."""

        def frame(table: StoredTable) -> DataFrame:
            return self.read(table).select(*table.schema.names)

        nodes = {label: Nodes(frame(self.nodes(label)), self.nodes(label).keys) for label in self.labels()}
        rels = {t: Rels(frame(self.rels(t)), *ends, self.rels(t).keys) for t, ends in self.ends.items()}
        return PropertyGraph(nodes, rels)

    def written(self, table: StoredTable, load: int) -> DataFrame:
        """All that ``load`` wrote of a table."""
        return self.spark.read.schema(table.schema).parquet(f"{self.path}/{table.name}/{LOAD}={load}").select(*table.schema.names)

    def with_filters(self, table: StoredTable, rows: DataFrame, load: int, props: Sequence[str] | None = None) -> StoredTable:
        """``table`` with filters of the values that stored ``rows`` have of the guarded properties."""
        wanted = [p for p in (table.guarded() if props is None else props) if p in rows.columns]
        if not wanted:
            return table
        words, made = words_for(rows.count()), []
        for prop in wanted:
            folder = f"filters/{table.name}/{prop}/{load}"
            build(rows, prop, words).write.mode("overwrite").parquet(f"{self.path}/{folder}")
            made.append(ValueFilter(prop, folder, words))
        return replace(table, filters=(*table.filters, *made))

    def filters(self, table: StoredTable, prop: str) -> list[tuple[DataFrame, int]]:
        read = self.spark.read.schema("word long, bits long")
        return [(read.parquet(f"{self.path}/{f.folder}"), f.words) for f in table.filters if f.prop == prop]

    def write(self, table: StoredTable, rows: DataFrame, load: int) -> list[int]:
        """Write rows (with ``BUCKET``) as ``load``, columns that they lack as null; the buckets that have some."""
        there = set(rows.columns)
        columns = [F.col(f.name) if f.name in there else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema]
        folder = f"{self.path}/{table.name}/{LOAD}={load}"
        # what a failed try left behind is overwritten
        rows.select(*columns, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        found = files.names(self.spark, folder)
        return [int(n.removeprefix(f"{BUCKET}=")) for n in found if n.startswith(f"{BUCKET}=")]

    def next_version(self) -> int:
        """The number of the version to write, an error if another writer has made it meanwhile."""
        if f"{self.version + 1:010d}.json" in files.names(self.spark, f"{self.path}/versions"):
            raise FileExistsError(f"version {self.version + 1} of {self.path} is there; open the store again")
        return self.version + 1

    def commit(self, changed: Mapping[str, StoredTable]) -> Store:
        """Make the changed tables the next version. Nothing is visible before."""
        after = replace(self, version=self.version + 1, tables={**self.tables, **changed})
        files.write_text(self.spark, _version_file(self.path, after.version), _describe(after))
        return after


def _version_file(path: str, version: int) -> str:
    return f"{path}/versions/{version:010d}.json"


def _describe(store: Store) -> str:
    def table(t: StoredTable) -> dict:
        tombs = [{"folder": x.folder, "load": x.load, "cols": dict(x.cols), "null_safe": x.null_safe} for x in t.tombs]
        filters = [{"prop": x.prop, "folder": x.folder, "words": x.words} for x in t.filters]
        return {
            "keys": t.keys,
            "schema": t.schema.jsonValue(),
            "loads": t.loads,
            "unique": t.unique,
            "tombs": tombs,
            "constraints": t.constraints,
            "filters": filters,
        }

    ends = {t: [{"label": e.label, "cols": dict(e.cols)} for e in pair] for t, pair in store.ends.items()}
    return json.dumps({"tables": {n: table(t) for n, t in store.tables.items()}, "ends": ends})


def open_store(spark: SparkSession, path: str, version: int | None = None) -> Store:
    """The latest version of a store, or an older one."""
    path = path.rstrip("/")
    if version is None:
        found = [n for n in files.names(spark, f"{path}/versions") if n.endswith(".json")]
        if not found:
            raise FileNotFoundError(f"no graph is stored below {path}")
        version = int(found[-1].removesuffix(".json"))
    about = json.loads(files.read_text(spark, _version_file(path, version)))
    tables = {
        name: StoredTable(
            name,
            tuple(t["keys"]),
            StructType.fromJson(t["schema"]),
            tuple(tuple(loads) for loads in t["loads"]),
            t["unique"],
            tuple(Tombs(**x) for x in t["tombs"]),
            tuple((prop, kind) for prop, kind in t["constraints"]),
            tuple(ValueFilter(**x) for x in t["filters"]),
        )
        for name, t in about["tables"].items()
    }
    ends = {t: tuple(End(e["label"], e["cols"]) for e in pair) for t, pair in about["ends"].items()}
    return Store(spark, path, version, tables, ends)


def create_store(graph: PropertyGraph, path: str, buckets: int = 64) -> Store:
    """Store a graph below ``path``, which must be new, in ``buckets`` buckets a table.

    Choose so many that a bucket is a few files: a change rewrites whole buckets.
    """
    frames = {f"nodes/{n}": (nodes.df, nodes.keys) for n, nodes in graph.nodes.items()}
    frames |= {f"rels/{t}": (rels.df, rels.identity) for t, rels in graph.rels.items()}
    spark = next(iter(frames.values()))[0].sparkSession
    ends = {t: (rels.source, rels.target) for t, rels in graph.rels.items()}
    store = Store(spark, path.rstrip("/"), -1, {}, ends)
    store.next_version()
    changed = {}
    for name, (df, keys) in frames.items():
        if taken := {LOAD, BUCKET} & {c.lower() for c in df.columns}:
            raise ValueError(f"{name} has a column named {taken.pop()}")
        table = StoredTable(name, tuple(keys), df.schema, ((),) * buckets, False)
        present = store.write(table, df.withColumn(BUCKET, table.bucket()).hint("rebalance", F.col(BUCKET)), 0)
        table = table.holding(range(buckets), 0, present)
        counted = store.raw(table).groupBy(*keys).agg(F.count("*").alias(LOAD))
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        changed[name] = replace(table, unique=counted.where((F.col(LOAD) > 1) | missing).isEmpty())
    return store.commit(changed)
