"""How many groups the batches of an edge list should have, before they are made.

A block's size is that of its source group times that of its target group, as a share of all
edges. A group's size is the hubs in it and its part of the rest. So what bounds the
largest block is known from the degrees: the hubs among them one by one, the rest by its
sum and spread. A quantile sketch of the degrees, which tasks make and Spark merges, says
from which degree on a node is a hub.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.functions.columns import group_digest
from propgraph.operators.joins import fresh
from propgraph.staging import stage

HUBS = 256  # nodes of each side that count one by one
MOST_GROUPS = 1 << 14


@dataclass(frozen=True)
class Hub:
    side: str
    node: Any
    degree: int


@dataclass(frozen=True)
class BatchPlan:
    """``largest`` rows are expected in the fullest block of ``n`` groups; ``least`` however many groups there are.

    ``hubs`` are the nodes whose edges fill the fullest block, at most one of each side: if
    ``least`` is above what was asked for, no number of groups helps but theirs must be split.
    """

    n: int
    largest: float
    least: float
    hubs: tuple[Hub, ...]


@dataclass(frozen=True)
class _Side:
    name: str
    hubs: list[tuple[Any, int, int]]  # node, digest behind its group, degree
    rest: int  # edges of the other nodes
    squares: float  # of their degrees, summed

    def groups(self, n: int) -> list[tuple[float, Hub | None]]:
        """The expected fullest groups: their rows and their greatest hub."""
        held: dict[int, list[tuple[Any, int, int]]] = {}
        for hub in self.hubs:
            held.setdefault(hub[1] % n, []).append(hub)
        spread = math.sqrt(self.squares / n * (1 - 1 / n))
        found = []
        for members in held.values():
            node, _, degree = max(members, key=lambda h: h[2])
            found.append((sum(h[2] for h in members) + self.rest / n, Hub(self.name, node, degree)))
        found.sort(key=lambda g: -g[0])
        # among the groups without a hub of weight, the fullest by chance
        lucky = self.rest / n + spread * math.sqrt(2 * math.log(n))
        return [*found[:8], (lucky, None)]


def _side(df: DataFrame, name: str, col: str) -> _Side:
    degree = fresh("_degree", df)
    degrees = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias(degree))
    degrees = stage(degrees, "degrees")
    n, tall = degrees.count(), 0
    if n > HUBS:
        sketch = degrees.agg(F.kll_sketch_agg_bigint(F.col(degree)).alias("s"))
        tall = sketch.select(F.kll_sketch_get_quantile_bigint("s", F.lit(1 - HUBS / 2 / n))).first()[0]
    hubs = degrees.where(F.col(degree) >= tall)
    # the quantile may be shared by many nodes
    top = hubs.orderBy(F.desc(degree), col).limit(HUBS).select(col, group_digest(F.col(col)).alias("g"), degree).collect()
    total, squares = degrees.agg(F.sum(degree), F.sum(F.col(degree).cast("double") * F.col(degree))).first()
    listed = [(r[0], r[1], r[2]) for r in top]
    return _Side(
        name,
        listed,
        (total or 0) - sum(d for _, _, d in listed),
        max(0.0, (squares or 0.0) - sum(float(d) * d for _, _, d in listed)),
    )


def _fullest(sides: tuple[_Side, _Side], edges: int, n: int) -> tuple[float, tuple[Hub, ...]]:
    best, hubs = 0.0, ()
    for rows, a in sides[0].groups(n):
        for cols, b in sides[1].groups(n):
            size = rows * cols / edges
            if size > best:
                best, hubs = size, tuple(h for h in (a, b) if h is not None)
    # of so many blocks of about that size one is above it by chance
    chance = math.sqrt(best) * math.sqrt(2 * math.log(max(n, 2)))
    return min(float(edges), best + (chance if n > 1 else 0.0)), hubs


def plan_batches(df: DataFrame, src: str, dst: str, block: int) -> BatchPlan:
    """The least number of groups, a power of two, whose fullest block is expected to hold at most ``block`` edges.

    For groups by hash, as ``batch_edges`` makes them. Reads ``df`` twice, one column each
    time. If hubs keep a block above ``block`` whatever the number of groups, the plan is
    the number from which on more groups make it less than a tenth smaller.
    """
    if block < 1:
        raise ValueError("block must be at least 1")
    whole = df.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(src, dst)
    sides = _side(whole, "source", src), _side(whole, "target", dst)
    edges = sides[0].rest + sum(h[2] for h in sides[0].hubs)
    if not edges:
        return BatchPlan(1, 0.0, 0.0, ())
    least = 1.0
    if sides[0].hubs and sides[1].hubs:
        least = max(1.0, sides[0].hubs[0][2] * sides[1].hubs[0][2] / edges)
    n, size, hubs = 1, float(edges), ()
    while size > block and n < MOST_GROUPS:
        more, others = _fullest(sides, edges, 2 * n)
        if more > 0.9 * size and least > block:
            break
        n, size, hubs = 2 * n, more, others
    return BatchPlan(n, size, least, hubs)
