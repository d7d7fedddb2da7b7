"""Questions asked of the graph: scans, counts and top-k degrees.

One rule for all: a null end is no node, so it is never ranked, and a relationship with
one is neither counted nor scanned. A top-k looks only at the end that it ranks, which
lets it read that column alone. Scans also drop relationships whose ends are not among
the nodes, whatever properties are asked for; counts and top-k take the ends to exist.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.functions.columns import all_set, holds
from propgraph.model import End, PropertyGraph, Rels
from propgraph.operators.joins import fresh, hub_join, plain_key
from propgraph.staging import stage

# cells of values for a top-k over very many; a task hands on at most so many rows
CELLS = 1 << 14


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("the graph has neither nodes nor relationships")
    return reduce(DataFrame.unionByName, frames)


def _has_ends(rels: Rels) -> Column:
    return all_set([*rels.source.cols, *rels.target.cols])


def scan_nodes(graph: PropertyGraph, label: str, props: Sequence[str] | None = None) -> DataFrame:
    """The nodes of one label: keys, then ``props`` (default: all properties)."""
    nodes = graph.nodes[label]
    props = nodes.df.columns if props is None else props
    return nodes.df.select(*nodes.keys, *[p for p in props if p not in nodes.keys])


def scan_rels(
    graph: PropertyGraph,
    rel_type: str,
    source_props: Sequence[str] | None = None,
    target_props: Sequence[str] | None = None,
    ends_exist: bool = False,
) -> DataFrame:
    """The relationships of one type with properties of both ends.

    Columns: ``source_<prop>``, ``target_<prop>`` (default: keys and all
    properties), then the relationship's own properties. An end of which only keys are
    asked for is looked up as well, unless ``ends_exist`` says that each relationship has
    both of its nodes; then the relationship row itself carries the keys.
    """
    rels = graph.rels[rel_type]
    own = [c for c in rels.df.columns if c not in {*rels.source.cols, *rels.target.cols}]
    df, out = rels.df.where(_has_ends(rels)), []
    for side, end, props in (("source", rels.source, source_props), ("target", rels.target, target_props)):
        by_key = {key: col for col, key in end.cols.items()}
        nodes = graph.nodes[end.label].df
        props = list(nodes.columns if props is None else props)
        extra, held = [p for p in props if p not in by_key], {}
        if extra:
            node_cols = [F.col(key).alias(col) for key, col in by_key.items()]
            held = {p: fresh(f"_{side}_{p}", df, nodes) for p in extra}
            wanted = nodes.select(*node_cols, *[F.col(p).alias(held[p]) for p in extra])
            df = hub_join(df, wanted, list(end.cols), "inner")
        elif not ends_exist:
            keys = nodes.select(*[F.col(key).alias(col) for key, col in by_key.items()])
            df = hub_join(df, keys, list(end.cols), "left_semi")
        out += [F.col(by_key.get(p) or held[p]).alias(f"{side}_{p}") for p in props]
    return df.select(*out, *own)


def count_nodes(graph: PropertyGraph) -> DataFrame:
    """One row: the number of nodes of all labels."""
    counts = [nodes.df.agg(F.count("*").alias("n")) for nodes in graph.nodes.values()]
    return _union(counts).agg(F.sum("n").alias("node_count"))


def count_rels(graph: PropertyGraph, directed: bool = True) -> DataFrame:
    """One row: the matches of ``()-[r]->()`` or, undirected, of ``()-[r]-()``.

    The undirected pattern meets a relationship once from each end, a loop once.
    """
    # a graph without relationships still answers, with 0
    counts = [nodes.df.where(F.lit(False)).agg(F.count("*").alias("n")) for nodes in list(graph.nodes.values())[:1]]
    for df, rels, _, _ in graph.rel_reads():
        ways = F.lit(1) if directed else F.when(rels.is_loop(), 1).otherwise(2)
        counts.append(df.where(_has_ends(rels)).agg(F.coalesce(F.sum(ways), F.lit(0)).alias("n")))
    return _union(counts).agg(F.sum("n").alias("rel_count"))


def graph_summary(graph: PropertyGraph) -> DataFrame:
    """One row per label and per type: kind ('node' or 'rel'), name, n."""
    rows = [
        nodes.df.agg(F.count("*").alias("n")).select(F.lit("node").alias("kind"), F.lit(label).alias("name"), "n")
        for label, nodes in graph.nodes.items()
    ]
    for df, rels, types, type_col in graph.rel_reads():
        df = df.where(_has_ends(rels))
        tests = [F.lit(True) if type_col is None else F.col(type_col) == t for t in types]
        counts = df.agg(*[F.count_if(test).alias(f"_{i}") for i, test in enumerate(tests)])
        pairs = [F.struct(F.lit(t).alias("name"), F.col(f"_{i}").alias("n")) for i, t in enumerate(types)]
        rows.append(counts.select(F.lit("rel").alias("kind"), F.inline(F.array(*pairs))))
    return _union(rows)


def cell_totals(df: DataFrame, col: str, cells: int) -> DataFrame:
    """cell, total: how many values lie in each of ``cells`` cells, by hash; each value in one."""
    return df.select(_cell(df, col, cells).alias("cell")).groupBy("cell").agg(F.count("*").alias("total"))


def _cell(df: DataFrame, col: str, cells: int) -> Column:
    value = plain_key(F.col(col), df.schema[col].dataType)
    return F.lit(0).cast("long") if value is None else F.pmod(F.xxhash64(value), F.lit(cells))


def _counted_in(df: DataFrame, col: str, count_col: str, chosen: DataFrame, cells: int, k: int) -> DataFrame:
    """The first ``k`` of the values that lie in the ``chosen`` cells (cell; at most ``cells`` rows)."""
    cell = fresh("_cell", df)
    inside = df.withColumn(cell, _cell(df, col, cells)).join(
        F.broadcast(chosen.withColumnRenamed("cell", f"{cell}_")), F.col(cell) == F.col(f"{cell}_"), "left_semi"
    )
    return inside.groupBy(col).agg(F.count("*").alias(count_col)).orderBy(F.desc(count_col), col).limit(k)


def frequent_top_k(df: DataFrame, col: str, k: int = 10, count_col: str = "n", cells: int = CELLS) -> DataFrame:
    """The ``k`` most frequent values of ``col``; ties go to the smaller. For columns with very many values.

    In three phases, so that not every value is shuffled. First the totals of cells of values,
    which are at most ``cells`` rows a task. Then the values in the fullest cells are counted:
    the k-th count is a threshold that the k-th value of all reaches at least. A cell whose
    total is below it cannot hold such a value; those in the other cells are counted exactly.
    If the values are about equally frequent, most cells stay and it is the plain count.

    Reads ``df`` three times, so it should be a stored table. Nulls are left out. Runs jobs
    when called.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    df = df.where(F.col(col).isNotNull()).select(col)
    totals = stage(cell_totals(df, col, cells), "cells")
    fullest = totals.orderBy(F.desc("total"), "cell").limit(4 * k).select("cell")
    sure = _counted_in(df, col, count_col, fullest, cells, k).collect()
    threshold = sure[-1][count_col] if len(sure) == k else 0
    return _counted_in(df, col, count_col, totals.where(F.col("total") >= threshold).select("cell"), cells, k)


def degree_top_k(
    graph: PropertyGraph,
    label: str,
    other: str,
    types: Sequence[str] | None = None,
    k: int = 10,
    name_prop: str = "name",
    name_col: str = "name",
    count_col: str = "n",
    cells: int | None = None,
) -> DataFrame:
    """The ``k`` names of ``label`` nodes with most relationships to ``other`` nodes.

    Either direction counts, and ``types`` limits the relationship types. Grouping
    is by the property ``name_prop``: nodes of one name count together. Ties go to
    the smaller name. ``cells`` (such as ``CELLS``) says that there are very many names, which
    are the keys; see ``frequent_top_k``.
    """
    nodes = graph.nodes[label]
    keyed = nodes.keys == (name_prop,)
    frames = []

    def take(df: DataFrame, end: End) -> None:
        by_key = {key: col for col, key in end.cols.items()}
        frames.append(df.where(all_set(end.cols)).select(*[F.col(by_key[key]).alias(key) for key in nodes.keys]))

    for df, rels, _, _ in graph.rel_reads(types):
        ends = (rels.source.label, rels.target.label)
        if ends == (label, other):
            take(df, rels.source)
        if ends == (other, label):
            # between nodes of one label both ends count, but a loop only once
            take(df.where(~holds(rels.is_loop())) if label == other else df, rels.target)
    if not frames:
        empty = nodes.df.select(F.col(name_prop).alias(name_col), F.lit(0).cast("bigint").alias(count_col))
        return empty.where(F.lit(False))
    if cells is not None:
        if not keyed:
            raise ValueError(f"{label} nodes are not keyed by {name_prop}")
        found = frequent_top_k(_union(frames), name_prop, k, count_col, cells)
        return found.select(F.col(name_prop).alias(name_col), count_col).orderBy(F.desc(count_col), name_col).limit(k)
    degrees = _union(frames).groupBy(*nodes.keys).agg(F.count("*").alias(count_col))
    if not keyed:
        named_by = fresh("_name", nodes.df)
        names = nodes.df.select(*nodes.keys, F.col(name_prop).alias(named_by))
        named = hub_join(names, degrees, list(nodes.keys), "inner")
        degrees = named.groupBy(F.col(named_by).alias(name_prop)).agg(F.sum(count_col).alias(count_col))
    top = degrees.select(F.col(name_prop).alias(name_col), count_col)
    return top.orderBy(F.desc(count_col), name_col).limit(k)
