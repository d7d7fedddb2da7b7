"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are compared if they share a seed, a run of ``least``
words. Greedy string tiling then covers the item by non-overlapping matches, the longest
first, found by running Karp-Rabin hashing at falling search lengths. As tiles may stand
in any order in the document, a reordered passage is covered like an untouched one. A
document is contaminated by an item if the tiles cover enough of its words.

The seeds of a benchmark are sent to all tasks if its texts take at most SEED_LIMIT bytes,
and documents are then compared where they lie, without a shuffle. A larger benchmark is
joined to the documents' word runs by hash. Both ways give the same rows.

Defined results: a null text counts as empty. An item with fewer words than a seed, or
without text, matches nothing. Each of repeated rows is reported; other columns are
ignored. Items of one id are compared one by one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from propgraph.llm import shingles
from propgraph.llm.common import slices, whole_text
from propgraph.operators.joins import fresh, hub_join
from propgraph.staging import stage

LEAST = 5  # words of a seed and of the shortest tile
COVERAGE = 0.5
SEED_LIMIT = 4_000_000  # bytes; a word takes at least one, so there are no more seeds than that
ITEM_BYTES = 16  # counted for an item besides its text
FIRST_SEARCH = 32  # words of the first search length

find_words = re.compile(r"[^\W_]+").findall
TILE = StructType([StructField(n, IntegerType()) for n in ("item_at", "doc_at", "words")])
LEAK = StructType(
    [
        StructField("item_id", LongType()),
        StructField("coverage", DoubleType()),
        StructField("matched_words", IntegerType()),
        StructField("tiles", ArrayType(TILE)),
    ]
)
ARROW_TILE = pa.struct([(n, pa.int32()) for n in ("item_at", "doc_at", "words")])
ARROW_LEAK = pa.struct(
    [("item_id", pa.int64()), ("coverage", pa.float64()), ("matched_words", pa.int32()), ("tiles", pa.list_(ARROW_TILE))]
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


# greedy string tiling


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The Karp-Rabin hash of each run of ``size`` words, from running sums of powers."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    hashes = np.zeros(len(words) - size + 1, np.uint64)
    for j in range(size):  # Horner's rule over all runs at once
        hashes = hashes * _BASE + words[j : len(words) - size + 1 + j]
    return hashes


def _matches(item: np.ndarray, doc: np.ndarray, free_i: np.ndarray, free_d: np.ndarray, size: int) -> list[tuple]:
    """The maximal matches of unmarked words of at least ``size`` words: (length, place in item, place in doc)."""
    places = defaultdict(list)
    runs_i, runs_d = (np.lib.stride_tricks.sliding_window_view(f, size).all(axis=1) for f in (free_i, free_d))
    hashes_i, hashes_d = _window_hashes(item, size), _window_hashes(doc, size)
    for i in np.flatnonzero(runs_i).tolist():
        places[int(hashes_i[i])].append(i)
    found, covered = [], {}
    for d in np.flatnonzero(runs_d & np.isin(hashes_d, hashes_i[runs_i])).tolist():
        for i in places[int(hashes_d[d])]:
            if covered.get(i - d, -1) > d or not np.array_equal(item[i : i + size], doc[d : d + size]):
                continue  # a part of a longer match on this diagonal, or equal by hash only
            n = size
            while i + n < len(item) and d + n < len(doc) and free_i[i + n] and free_d[d + n] and item[i + n] == doc[d + n]:
                n += 1
            found.append((n, i, d))
            covered[i - d] = d + n - size + 1
    return found


def _free_parts(match: tuple[int, int, int], free_i: np.ndarray, free_d: np.ndarray, least: int) -> list[tuple]:
    """What is left of a match, (-length, place in item, place in doc), in runs of at least ``least`` free words."""
    n, i, d = -match[0], *match[1:]
    free = np.concatenate([[False], free_i[i : i + n] & free_d[d : d + n], [False]])
    starts, ends = np.flatnonzero(free[1:-1] & ~free[:-2]), np.flatnonzero(free[1:-1] & ~free[2:]) + 1
    return [(a - b, i + a, d + a) for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a >= least]


def tile(item: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in doc, length) of greedy string tiling, by falling length.

    Again and again the longest match of unmarked words is marked; of equally long ones
    the first in the item, then the first in the document. A match that a tile has cut
    waits for its turn with what is left of it.
    """
    free_i, free_d = np.ones(len(item), bool), np.ones(len(doc), bool)
    tiles, left, size = [], len(item), max(least, FIRST_SEARCH)
    while min(left, len(doc)) >= least:
        size = max(least, min(size, left, len(doc)))
        waiting = [(-n, i, d) for n, i, d in _matches(item, doc, free_i, free_d, size)]
        heapify(waiting)
        if waiting and -waiting[0][0] > 2 * size:
            size = -waiting[0][0]  # search for the very long ones first
            continue
        while waiting and left >= size:
            match = heappop(waiting)
            n, i, d = -match[0], *match[1:]
            if free_i[i : i + n].all() and free_d[d : d + n].all():
                free_i[i : i + n] = free_d[d : d + n] = False
                tiles.append((i, d, n))
                left -= n
            else:
                for part in _free_parts(match, free_i, free_d, size):
                    heappush(waiting, part)
        if size == least:
            break
        size = max(least, size // 2)
    return tiles


# the benchmark as an index


@dataclass
class SeedIndex:
    """The words of all items as numbers, and which items have which seed."""

    number: dict[str, int]
    items: list[tuple[int, np.ndarray]]
    seeds: np.ndarray  # sorted
    seed_items: np.ndarray  # row numbers of items, by seed

    @classmethod
    def of(cls, rows: list[tuple[int, str]], least: int) -> SeedIndex:
        number: dict[str, int] = {}
        items = [
            (item_id, np.array([number.setdefault(w, len(number)) for w in find_words((text or "").lower())], np.uint64))
            for item_id, text in rows
        ]
        pairs = {(int(h), k) for k, (_, words) in enumerate(items) for h in _seed_hashes(words, least)}
        ordered = sorted(pairs)
        return cls(number, items, np.array([p[0] for p in ordered], np.uint64), np.array([p[1] for p in ordered], np.int64))

    def leaks(self, text: str, least: int, coverage: float) -> list[dict]:
        get = self.number.get
        words = np.array([get(w, -1) for w in find_words(text.lower())], np.int64)
        if len(words) < least or not len(self.seeds):
            return []
        known = np.lib.stride_tricks.sliding_window_view(words >= 0, least).all(axis=1)
        if not known.any():
            return []
        words = words.view(np.uint64)
        hashes = np.unique(_seed_hashes(words, least)[known])
        first, last = np.searchsorted(self.seeds, hashes, "left"), np.searchsorted(self.seeds, hashes, "right")
        hits = [self.seed_items[a:b] for a, b in zip(first, last, strict=True) if a < b]
        return self.tiled(words, np.unique(np.concatenate(hits)).tolist() if hits else [], least, coverage)

    def tiled(self, words: np.ndarray, candidates: list[int], least: int, coverage: float) -> list[dict]:
        out = []
        for k in candidates:
            item_id, item = self.items[k]
            tiles = tile(item, words, least)
            matched = sum(n for _, _, n in tiles)
            if matched >= coverage * len(item):
                rows = [{"item_at": i, "doc_at": d, "words": n} for i, d, n in tiles]
                out.append({"item_id": item_id, "coverage": matched / len(item), "matched_words": matched, "tiles": rows})
        return out


def _seed_hashes(words: np.ndarray, least: int) -> np.ndarray:
    return shingles.windows(shingles.mix(words), least) if len(words) >= least else np.empty(0, np.uint64)


def _index_leaks(spark, index: SeedIndex, text: Column, least: int, coverage: float) -> Column:
    sent = spark.sparkContext.broadcast(index)

    @F.arrow_udf(ArrayType(LEAK))
    def leaks(texts: pa.Array) -> pa.Array:
        return pa.array([sent.value.leaks(t.as_py(), least, coverage) for t in texts], pa.list_(ARROW_LEAK))

    return leaks(text)


# a benchmark of any size


def _runs(texts: DataFrame, id_col: str, least: int) -> DataFrame:
    """``id_col`` and the hash of each distinct run of ``least`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            for row_id, text in zip(batch.column(0), batch.column("text"), strict=True):
                words = shingles.hash_words([w.encode() for w in find_words(text.as_py().lower())])
                seeds = np.unique(_seed_hashes(words, least)).view(np.int64)
                ids = pa.array([row_id.as_py()] * len(seeds), batch.schema.types[0])
                yield pa.RecordBatch.from_arrays([ids, pa.array(seeds, pa.int64())], [id_col, "seed"])

    return texts.mapInArrow(run, f"{id_col} string, seed long")


def _joined_leaks(docs: DataFrame, items: DataFrame, least: int, coverage: float) -> DataFrame:
    """text_key and leaks of each text, through a join of the word runs of texts and items."""
    texts = docs.select(F.sha2("text", 256).alias("text_key"), "text").dropDuplicates(["text_key"])
    named = items.select(F.sha2(F.concat_ws("\n", F.col("item_id").cast("string"), "text"), 256).alias("item_key"), "item_id", "text")
    seeds = stage(_runs(named.select("item_key", "text"), "item_key", least), "item-seeds")
    pairs = hub_join(_runs(texts, "text_key", least), seeds, ["seed"], "inner").select("text_key", "item_key").distinct()
    pairs = stage(pairs, "seed-pairs")
    both = hub_join(pairs, named.withColumnRenamed("text", "item_text"), ["item_key"], "inner")
    both = hub_join(both, texts, ["text_key"], "inner")

    @F.arrow_udf(ArrayType(LEAK))
    def leaks(item_ids: pa.Array, item_texts: pa.Array, doc_texts: pa.Array) -> pa.Array:
        out = []
        for item_id, item, text in zip(item_ids, item_texts, doc_texts, strict=True):
            index = SeedIndex.of([(item_id.as_py(), item.as_py())], least)
            out.append(index.leaks(text.as_py(), least, coverage))
        return pa.array(out, pa.list_(ARROW_LEAK))

    found = both.select("text_key", F.inline(leaks("item_id", "item_text", "text")))
    return found.select("text_key", F.struct(*LEAK.names).alias("leak"))


# both


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(id_col).cast("long").alias("item_id"), whole_text(text_col).alias("text"))


def _fits(items: DataFrame, limit: int) -> bool:
    """Whether the items take at most ``limit`` bytes, so that they may be collected and sent to all tasks."""
    taken = items.agg(F.sum(F.octet_length("text") + ITEM_BYTES)).first()[0] or 0
    return taken <= limit


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = LEAST,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    seed_limit: int = SEED_LIMIT,
) -> DataFrame:
    """One row per document and item whose tiles cover at least ``coverage`` of the item's words.

    doc_id, item_id, coverage, matched_words, tiles (places in words of item and document).
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    items = _items(benchmark, item_id_col, item_text_col)
    if _fits(items, seed_limit):
        index = SeedIndex.of([tuple(r) for r in items.collect()], least)
        found = docs.select("doc_id", _index_leaks(docs.sparkSession, index, F.col("text"), least, coverage).alias("all"))
        return found.select("doc_id", F.inline("all"))
    found = stage(_joined_leaks(docs, items, least, coverage), "leaks")
    keyed = docs.select("doc_id", F.sha2("text", 256).alias("text_key"))
    return hub_join(keyed, found, ["text_key"], "inner").select("doc_id", "leak.*")


def clean(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE, text_col: str = "text", seed_limit: int = SEED_LIMIT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no item contaminates."""
    items = _items(benchmark, "item_id", "text")
    if _fits(items, seed_limit):
        index = SeedIndex.of([tuple(r) for r in items.collect()], least)
        return docs.where(F.size(_index_leaks(docs.sparkSession, index, whole_text(text_col), least, coverage)) == 0)
    named = docs.select(whole_text(text_col).alias("text"))
    found = stage(_joined_leaks(named, items, least, coverage), "leaks").select("text_key").distinct()
    key = fresh("_text_key", docs)
    keyed = docs.withColumn(key, F.sha2(whole_text(text_col), 256))
    return hub_join(keyed, found.withColumnRenamed("text_key", key), [key], "left_anti").drop(key)
