"""Deletes return a new graph; frames are immutable."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.functions.columns import all_set, holds
from propgraph.model import PropertyGraph, Rels
from propgraph.operators.joins import hub_join
from propgraph.operators.write import rename_keys


def _nothing(df: DataFrame) -> DataFrame:
    # the optimizer turns this into an empty relation; nothing is read
    return df.where(F.lit(False))


def _without(df: DataFrame, where: Column | None) -> DataFrame:
    # a condition that is null does not delete
    return _nothing(df) if where is None else df.where(~holds(where))


def delete_rels(graph: PropertyGraph, rel_type: str | None = None, where: Column | None = None) -> PropertyGraph:
    """Delete the relationships of one type (default: all) for which ``where`` holds."""
    types = None if rel_type is None else [rel_type]
    return graph.map_rels(lambda _, df: _without(df, where), types)


def _labels(graph: PropertyGraph, label: str | None) -> list[str]:
    return list(graph.nodes) if label is None else [label]


def _ends_in(rels: Rels, labels: list[str]) -> list:
    return [end for end in (rels.source, rels.target) if end.label in labels]


def delete_nodes(
    graph: PropertyGraph, label: str | None = None, where: Column | None = None, detach: bool = False
) -> PropertyGraph:
    """Delete the nodes of one label (default: all) for which ``where`` holds.

    With ``detach`` their relationships go too. Without it the call looks for such
    relationships at once and raises if there is one. Whole labels need no join:
    all relationships that touch the label are meant.
    """
    labels = _labels(graph, label)
    gone = {}
    for name in labels:
        nodes = graph.nodes[name]
        gone[name] = nodes.df if where is None else nodes.df.where(holds(where))
        graph = graph.with_nodes(name, replace(nodes, df=_without(nodes.df, where)))
    touched = [name for name, rels in graph.rels.items() if _ends_in(rels, labels)]

    if not detach:
        for name in touched:
            rels = graph.rels[name]
            for end in _ends_in(rels, labels):
                ends = rels.df.where(all_set(end.cols))
                if where is not None:
                    ends = hub_join(ends, rename_keys(gone[end.label], end.cols), list(end.cols), "left_semi")
                if not ends.isEmpty():
                    raise ValueError(f"{end.label} nodes still have {name} relationships; delete those first or detach")
        return graph

    def drop_ends(rels: Rels, df: DataFrame) -> DataFrame:
        if where is None:
            return _nothing(df)
        for end in _ends_in(rels, labels):
            df = hub_join(df, rename_keys(gone[end.label], end.cols), list(end.cols), "left_anti").select(*df.columns)
        return df

    return graph.map_rels(drop_ends, touched)
