"""Prefix sums along linked lists, by contraction.

The elements are dealt into blocks of bounded size. Inside a block every chain of elements
that follow each other becomes one element, which stands for their sums; what is left is a
shorter list, which is treated likewise until it fits into one block. On the way back each
element adds what lies before its chain. Blocks are cut by id, which shortens a list most
if neighbours have near ids, in turns with blocks that bring about a quarter of all
neighbours together by lot, so the list shrinks whatever the ids.

Each step is written, so a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.operators.joins import hub_join
from propgraph.staging import stage

BLOCK = 1 << 18  # elements of a block


def chains(ids: np.ndarray, following: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each element the index of its chain's head, the weights before it there, and whether it is the last.

    ``following`` is the next element's id, -1 for none; only those among ``ids`` count.
    """
    n = len(ids)
    order = np.argsort(ids)
    at = np.minimum(np.searchsorted(ids, following, sorter=order), n - 1)
    here = (following >= 0) & (ids[order[at]] == following)
    jump, preceded = np.arange(n), np.zeros(n, bool)
    jump[order[at[here]]] = np.flatnonzero(here)
    preceded[order[at[here]]] = True
    before = np.where(preceded[:, None], weights[jump], 0)
    for _ in range(n.bit_length()):
        before += before[jump]
        jump, held = jump[jump], jump
        if (jump == held).all():
            break
    if preceded[jump].any():
        raise ValueError("the links form a cycle")
    return jump, before, ~here


def _contract(links: DataFrame, weights: list[str]) -> DataFrame:
    """Per element its head and the sums before it; a last one also has its chain's next and totals."""
    sums = [f"before_{w}" for w in weights]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        ids, following = (rows.column(c).fill_null(-1).to_numpy() for c in ("id", "next"))
        values = np.column_stack([rows.column(w).to_numpy() for w in weights])
        head, before, last = chains(ids, following, values)
        totals = before + values
        columns = [ids, ids[head], *before.T, last, following, *totals.T]
        out = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "head", *sums, "last", "next", *weights])
        step = 1 << 16
        yield from (out.slice(i, step) for i in range(0, out.num_rows, step))

    longs = ", ".join(f"{c} long" for c in ["id", "head", *sums])
    return links.mapInArrow(run, f"{longs}, last boolean, next long, " + ", ".join(f"{w} long" for w in weights))


def prefix_sums(links: DataFrame, weights: Sequence[str], block: int = BLOCK) -> DataFrame:
    """id and ``before_<w>``, the sums of the weights before each element of its list.

    ``links``: id (long, unique, not negative), next (its successor, null or -1 at an end) and
    the weights (long, not null). Several lists are summed each by itself; a cycle is an error.
    """
    weights = list(weights)
    sums = [f"before_{w}" for w in weights]
    links = stage(links.select("id", F.coalesce("next", F.lit(-1).cast("long")).alias("next"), *weights), "links")
    levels, turn = [], 0
    while True:
        n, open_ends = links.agg(F.count("*"), F.count_if(F.col("next") >= 0)).first()
        if levels and not open_ends:  # every list is one element
            found = links.select("id", *[F.lit(0).cast("long").alias(s) for s in sums])
            break
        blocks = -(-n // block)
        if blocks <= 1:
            dealt = links.repartition(1)  # at most ``block`` rows
        elif turn % 2 == 0:
            dealt = links.repartitionByRange(blocks, "id")
        else:
            follows = (F.col("next") >= 0) & (F.xxhash64(F.lit(turn), "id").bitwiseAND(1) == 0)
            dealt = links.repartition(blocks, F.when(follows, F.col("next")).otherwise(F.col("id")))
        levels.append(stage(_contract(dealt, weights), f"chains-{turn}"))
        if blocks <= 1:
            found = levels.pop().select("id", *sums)
            break
        links = levels[-1].where("last").select(F.col("head").alias("id"), "next", *weights)
        turn += 1

    for level in reversed(levels):
        found = stage(found, "sums")  # one join a plan, however many levels there are
        above = found.withColumnsRenamed({"id": "head", **{s: f"above_{s}" for s in sums}})
        joined = hub_join(level.select("id", "head", *sums), above, ["head"], "inner")
        found = joined.select("id", *[(F.col(s) + F.col(f"above_{s}")).alias(s) for s in sums])
    return found
