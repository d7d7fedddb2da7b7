"""Constraints as checks. Spark enforces no keys, so a check returns what breaks one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.model import PropertyGraph

KINDS = ("unique", "key")


def unique_violations(nodes: DataFrame, prop: str) -> DataFrame:
    """Values that occur on more than one node, with the number of nodes; nulls are ignored."""
    counted = nodes.where(F.col(prop).isNotNull()).groupBy(prop).agg(F.count("*").alias("n_nodes"))
    return counted.where("n_nodes > 1")


def key_violations(nodes: DataFrame, prop: str) -> DataFrame:
    """Like ``unique_violations``, and a row for null if any node lacks the property."""
    counted = nodes.groupBy(prop).agg(F.count("*").alias("n_nodes"))
    return counted.where((F.col("n_nodes") > 1) | F.col(prop).isNull())


def constraint_report(graph: PropertyGraph, constraints: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per (label, property, kind) with its number of violations.

    ``unique`` counts repeated values; ``key`` counts repeated values and nodes
    without a value. All checks of one property share one aggregation.
    """
    checks: dict[tuple[str, str], list[str]] = {}
    for label, prop, kind in constraints:
        if kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")
        checks.setdefault((label, prop), []).append(kind)
    if not checks:
        raise ValueError("no constraint is declared")
    rows = []
    for (label, prop), kinds in checks.items():
        counted = graph.nodes[label].df.groupBy(prop).agg(F.count("*").alias("n"))
        is_set = F.col(prop).isNotNull()
        totals = counted.agg(
            F.count_if(is_set & (F.col("n") > 1)).alias("unique"),
            F.coalesce(F.sum(F.when(~is_set, F.col("n"))), F.lit(0)).alias("missing"),
        ).select("unique", (F.col("unique") + F.col("missing")).alias("key"))
        pairs = [F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("violations")) for kind in kinds]
        rows.append(totals.select(F.lit(label).alias("label"), F.lit(prop).alias("property"), F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, rows)
