"""The graph: one frame per node label, one frame per relationship type."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Nodes:
    """Nodes of one label; ``keys`` names the columns that identify a node."""

    df: DataFrame
    keys: tuple[str, ...]


@dataclass(frozen=True)
class End:
    """One end of a relationship: ``cols`` maps relationship column -> node key."""

    label: str
    cols: Mapping[str, str]


@dataclass(frozen=True, eq=False)
class Pool:
    """One table that holds several relationship types, told apart by ``type_col``.

    Relationship types with the same ends may share a pool, so that a question
    about several types reads the data once. A stored pool is partitioned by the
    type column. Readers always filter by type: rows of other types are ignored.
    """

    df: DataFrame
    type_col: str


@dataclass(frozen=True)
class Rels:
    """Directed relationships of one type between two labels.

    ``identity`` names the columns on which a merge matches; by default the
    columns of both ends.
    """

    df: DataFrame
    source: End
    target: End
    identity: tuple[str, ...] = ()
    pool: Pool | None = None

    def __post_init__(self):
        if not self.identity:
            object.__setattr__(self, "identity", (*self.source.cols, *self.target.cols))

    def with_df(self, df: DataFrame, pool: Pool | None = None) -> Rels:
        return replace(self, df=df, pool=pool)

    def is_loop(self) -> Column:
        """True where both ends are the same node."""
        if self.source.label != self.target.label:
            return F.lit(False)
        by_key = {key: col for col, key in self.target.cols.items()}
        same = F.lit(True)
        for col, key in self.source.cols.items():
            same = same & (F.col(col) == F.col(by_key[key]))
        return same


@dataclass(frozen=True)
class PropertyGraph:
    nodes: Mapping[str, Nodes] = field(default_factory=dict)
    rels: Mapping[str, Rels] = field(default_factory=dict)

    def __post_init__(self):
        ends: dict[int, tuple[End, End]] = {}
        for name, rels in self.rels.items():
            if rels.pool is not None and ends.setdefault(id(rels.pool), (rels.source, rels.target)) != (
                rels.source,
                rels.target,
            ):
                raise ValueError(f"{name} shares a pool with relationships between other ends")

    def with_nodes(self, label: str, nodes: Nodes) -> PropertyGraph:
        return replace(self, nodes={**self.nodes, label: nodes})

    def with_rels(self, rel_type: str, rels: Rels) -> PropertyGraph:
        return replace(self, rels={**self.rels, rel_type: rels})

    def map_rels(
        self, change: Callable[[Rels, DataFrame], DataFrame], types: Iterable[str] | None = None
    ) -> PropertyGraph:
        """Apply ``change(rels, frame)`` to the frames of ``types`` (default: all).

        A pool stays shared as long as all of its types are changed alike;
        otherwise the changed types leave it.
        """
        chosen = set(self.rels if types is None else types)
        members: dict[int, set[str]] = {}
        for name, rels in self.rels.items():
            if rels.pool is not None:
                members.setdefault(id(rels.pool), set()).add(name)
        pools: dict[int, Pool] = {}
        out = dict(self.rels)
        for name in self.rels:
            if name not in chosen:
                continue
            rels, pool = self.rels[name], None
            if rels.pool is not None and members[id(rels.pool)] <= chosen:
                key = id(rels.pool)
                if key not in pools:
                    pools[key] = replace(rels.pool, df=change(rels, rels.pool.df))
                pool = pools[key]
            out[name] = rels.with_df(change(rels, rels.df), pool)
        return replace(self, rels=out)

    def rel_reads(self, types: Iterable[str] | None = None) -> list[tuple[DataFrame, Rels, list[str], str | None]]:
        """The frames to read for ``types``, each pool once.

        Returns (frame, rels, types in the frame, type column or None). A type
        asked for alone is read from its own, narrower frame.
        """
        names = list(self.rels if types is None else types)
        groups: dict[object, list[str]] = {}
        for name in names:
            pool = self.rels[name].pool
            groups.setdefault(name if pool is None else id(pool), []).append(name)
        reads = []
        for found in groups.values():
            rels = self.rels[found[0]]
            if len(found) == 1 or rels.pool is None:
                reads.append((rels.df, rels, found, None))
            else:
                kind = F.col(rels.pool.type_col)
                reads.append((rels.pool.df.where(kind.isin(found)), rels, found, rels.pool.type_col))
        return reads
