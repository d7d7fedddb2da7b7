"""Substring dedup by paragraphs: MinHash banding, exact verification, runs, components.

A paragraph is a line of a text that has words. All of them are banded by the minima of
several hash functions over their word shingles; the bands are tuned so that a pair at the
threshold collides with a stated probability. Colliding paragraphs are verified by the
exact Jaccard similarity of their shingles; the components of the verified links say which
paragraphs are alike.

A passage is a run of neighbouring paragraphs (lines without words between them do not
count) of at least ``least`` words, and it repeats where paragraphs alike follow each other
in the same order elsewhere. Words are counted by the longest of the paragraphs alike, so
that all copies of a run are of one length. Each run is cut into its shortest windows of
``least`` words from every paragraph on and up to every paragraph, which together cover it;
equal windows tie their paragraphs one by one, and clusters are the components of these
ties. In a cluster the first paragraph stays. No pairs of documents are made.

A passage may also stand within longer lines, which then are no paragraphs alike. Its exact
copies are found word by word (see ``repeated_runs``).

Paragraphs with equal shingles are one node, however often they occur, and a group of
near copies is tied to its smallest node first (see ``jaccard_join.link_buckets``).

Defined results: a null text counts as empty and has no paragraphs. Null ids come first,
so such a row's paragraph stays. Of repeated rows the same paragraph stays in each, and of
paragraphs at one place under one id (two texts of a repeated id) both do. A passage that
repeats inside one text is removed there too, also where it overlaps itself. Other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm import shingles
from propgraph.llm.common import slices, whole_text
from propgraph.llm.components import components
from propgraph.llm.jaccard_join import Threshold, link_buckets, many_prints, parity_sketch
from propgraph.llm.repeated_runs import body_of, repeated_runs, text_facts
from propgraph.operators.joins import hub_join
from propgraph.staging import new_path, stage, staging, write_once

LEAST_WORDS = 50
ROWS = 3  # hash functions of a band
RECALL = 0.999  # of pairs right at the threshold; of closer ones it is higher


def tune_bands(threshold: Threshold, recall: float = RECALL, rows: int = ROWS) -> int:
    """The fewest bands by which a pair at the threshold collides with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (threshold.num / threshold.den) ** rows))


@cache
def _draw(n: int) -> np.ndarray:
    return np.random.default_rng(11).integers(0, 1 << 63, (2, n), np.uint64)


def band_keys(tokens: np.ndarray, starts: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """The keys of sets that stand one after another in ``tokens``, a row of ``bands`` each."""
    factor, shift = _draw(bands * rows)
    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(starts), 1))
    for j in range(rows):
        for band in range(bands):
            f = band * rows + j
            least = np.minimum.reduceat(tokens * (factor[f] | np.uint64(1)) + shift[f], starts)
            keys[:, band] = shingles.mix(keys[:, band] ^ least, j + 1)
    return keys.view(np.int64)


def has_near(n: np.ndarray, threshold: Threshold) -> np.ndarray:
    """Whether a set of ``n`` tokens can reach the threshold with any set but itself: with one token more at best."""
    return n * threshold.den >= (n + 1) * threshold.num


def paragraphs(text: str) -> Iterator[tuple[int, int, list[bytes]]]:
    """Start, end (in characters) and words of each line with words."""
    at = 0
    for line in text.split("\n"):
        if found := shingles.words(line):
            yield at, at + len(line), found
        at += len(line) + 1


def windows(spans: np.ndarray, least: int) -> list[tuple[int, int]]:
    """First place and end of the shortest windows that sum up to ``least``, from each place on and up to each place."""
    sums = np.append(0, spans.cumsum())
    ends = np.searchsorted(sums, sums[:-1] + least)
    found = {(i, j) for i, j in enumerate(ends.tolist()) if j < len(sums)}
    begins = np.searchsorted(sums, sums[1:] - least, side="right") - 1
    found.update((i, j + 1) for j, i in enumerate(begins.tolist()) if i >= 0)
    return sorted(found)


def _keyed(docs: DataFrame, k: int, threshold: Threshold, least: int) -> DataFrame:
    """doc_id, own, row, line, start, end, n_words, f1, f2 of each paragraph, and its band keys.

    ``own`` names the id and the text; ``row`` tells rows apart and holds once written; ``line`` counts the
    paragraphs of a text. The first one also has the text's facts (see ``repeated_runs.facts_of``).
    """
    names, bands = ["doc_id", "own", "row", "line", "start", "end", "n_words", "f1", "f2"], tune_bands(threshold)
    facts = {n: pa.int64() for n in ("body", "first", "last", "total")} | {n: pa.list_(pa.int64()) for n in ("seed_at", "seeds")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            rows, found, texts = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "own", "row", "body", "text"))
            for doc_id, own, row, body, text in zip(*columns, strict=True):
                before = len(found)
                for line, (a, b, words) in enumerate(paragraphs(text)):
                    rows.append((doc_id, own, row, line, a, b, len(words)))
                    found += words
                if len(found) > before:
                    texts.append((body, text, len(found) - before))
            if not rows:
                continue
            # all lines at once
            counts, hashes = np.array([r[-1] for r in rows]), shingles.hash_words(found)
            tokens, starts = shingles.shingle_sets(hashes, counts, k)
            f1, f2 = many_prints(tokens, starts)
            sizes = np.diff(np.append(starts, len(tokens)))
            near = has_near(sizes, threshold)
            keys = band_keys(tokens[np.repeat(near, sizes)], np.cumsum(sizes[near]) - sizes[near], bands)
            ends = np.cumsum(np.where(near, bands, 0))
            listed = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(keys.ravel()))
            columns = [pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)]
            bodies, whole, totals = zip(*texts, strict=True)
            told = text_facts(whole, hashes, np.array(totals), least)
            told = ((body, *facts) for body, facts in zip(bodies, told, strict=True))
            of = [next(told) if r[3] == 0 else (None,) * len(facts) for r in rows]
            extra = [pa.array(list(c), kind) for c, kind in zip(zip(*of, strict=True), facts.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(f1), pa.array(f2), listed, *extra], [*names, "keys", *facts])

    docs = docs.select("doc_id", "own", F.monotonically_increasing_id().alias("row"), body_of().alias("body"), "text")
    kinds = [f"{n} long" for n in (*names, "body", "first", "last", "total")]
    kinds[len(names) : len(names)] = ["keys array<long>"]
    return docs.mapInArrow(run, ", ".join([*kinds, "seed_at array<long>", "seeds array<long>"]))


def _windows(found: DataFrame, least: int) -> DataFrame:
    """doc_id, start, row, line, size, run of each window of matched neighbours: ``run`` stands for what it holds."""
    names = ["doc_id", "start", "row", "line", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "lines"):
            rows, runs = [], []
            columns = (batch.column(c) for c in ("doc_id", "row", "lines"))
            for doc_id, row, lines in zip(*columns, strict=True):
                fields = lines.values.flatten()  # line, start, like, span
                line, start, like, span = (f.to_numpy()[np.argsort(fields[0].to_numpy())] for f in fields)
                cuts = np.flatnonzero(np.diff(line) != 1) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(line)], strict=True):
                    for i, j in windows(span[a:b], least):
                        rows.append((doc_id.as_py(), int(start[a + i]), row.as_py(), int(line[a + i]), j - i))
                        runs.append(xxhash.xxh3_128_digest(like[a + i : a + j].tobytes()))
            columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * len(names)
            arrays = [*(pa.array(c, pa.int64()) for c in columns), pa.array(runs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "run"])

    lines = F.collect_list(F.struct("line", "start", "like", "span")).alias("lines")
    listed = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), lines)
    return listed.mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", run binary")


def _ties(found: DataFrame, least: int) -> DataFrame:
    """a, b: each paragraph of a repeated window, and that in its place in the window's first occurrence."""
    met = stage(_windows(found, least), "windows")
    first = F.min(F.struct("doc_id", "start", "row", "line")).alias("first")
    repeated = met.groupBy("run").agg(F.count("*").alias("times"), first).where("times > 1").select("run", "first")
    again = hub_join(met, repeated, ["run"], "inner").where("row <> first.row OR line <> first.line")
    again = again.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1)))
    return again.select(_node("row", F.col("line") + F.col("at")).alias("a"), _node("first.row", F.col("first.line") + F.col("at")).alias("b"))


def _node(row: str, line: Column) -> Column:
    return F.xxhash64(F.col(row), line)


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """node, f2, n, tokens, sketch of the paragraphs asked for: ``places`` (start, end, node) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            found, counts, nodes = [], [], []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True):
                for place in places:
                    if words := shingles.words(text[place["start"] : place["end"]]):
                        found += words
                        counts.append(len(words))
                        nodes.append(place["node"])
            if not nodes:
                continue
            tokens, starts = shingles.shingle_sets(shingles.hash_words(found), np.array(counts), k)
            f1, f2 = many_prints(tokens, starts)
            rows = []
            for node, one, two, own in zip(nodes, f1.tolist(), f2.tolist(), np.split(tokens, starts[1:]), strict=True):
                if one == node:
                    rows.append((one, two, len(own), own.view(np.int64), parity_sketch(own).tobytes()))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                arrays = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "f2", "n", "tokens", "sketch"])

    wanted = docs.select("text", "places")
    return wanted.mapInArrow(run, "node long, f2 long, n long, tokens array<long>, sketch binary")


def repeated_paragraphs(
    docs: DataFrame,
    k: int = 5,
    threshold: Threshold = Threshold(80, 100),
    least: int = LEAST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per repeated passage's paragraph, and one per run of words that has an exact copy within other lines.

    doc_id, unit ('line' or 'run'), start, end (characters of the text), n_words, cluster_id,
    keep_doc_id (the document whose paragraph or run stays), kept. A run of whole lines is
    found both ways: what is not kept goes.
    """
    docs = _named(docs, id_col, text_col)
    spark = docs.sparkSession
    with_lines, with_runs = new_path(spark, "lines"), new_path(spark, "runs")
    with staging(spark):
        rows, met, facts = _prepared(docs, k, threshold, least)
        with staging(spark):
            lines = write_once(_lines(docs, rows, met, k, threshold, least).withColumn("unit", F.lit("line")), with_lines)
        with staging(spark):
            runs = write_once(repeated_runs(docs, facts, least).withColumn("unit", F.lit("run")), with_runs)
    found = lines.unionByName(runs)
    return found.select("doc_id", "unit", "start", "end", "n_words", "cluster_id", "keep_doc_id", "kept")


def repeated_lines(
    docs: DataFrame,
    k: int = 5,
    threshold: Threshold = Threshold(80, 100),
    least: int = LEAST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per paragraph of a repeated passage: a run of ``least`` words in whole lines that has a copy or near copy.

    doc_id, start, end (characters of the text), n_words, cluster_id, keep_doc_id (the
    document whose paragraph stays), kept.
    """
    docs = _named(docs, id_col, text_col)
    rows, met, _ = _prepared(docs, k, threshold, least)
    return _lines(docs, rows, met, k, threshold, least)


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, own (names the id and the text), text."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("own"), "text")


def _prepared(docs: DataFrame, k: int, threshold: Threshold, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of one pass over the texts: the paragraphs, the band keys that several of them have, and the texts' facts."""
    spark = docs.sparkSession
    rows, met, facts = new_path(spark, "paragraphs"), new_path(spark, "met"), new_path(spark, "facts")
    with staging(spark):
        keyed = stage(_keyed(docs, k, threshold, least), "keyed")
        rows = write_once(keyed.select("doc_id", "own", "row", "line", "start", "end", "n_words", "f1", "f2"), rows)
        told = keyed.where("line = 0").select("doc_id", "own", "body", "first", "last", "total", "seed_at", "seeds")
        facts = write_once(told, facts)
        keys = keyed.select(F.explode("keys").alias("key"), F.col("f1").alias("node"))
        shared = keys.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y").select("key")
        shared = stage(shared, "shared-bands").hint("shuffle_hash")
        met = write_once(hub_join(keys, shared, ["key"], "left_semi").distinct(), met)
    return rows, met, facts


def _lines(docs: DataFrame, rows: DataFrame, met: DataFrame, k: int, threshold: Threshold, least: int) -> DataFrame:
    # one place of each node that meets another, and the places by document
    asked = met.select(F.col("node").alias("f1")).distinct()
    place = F.min(F.struct("own", "start", "end")).alias("place")
    places = hub_join(rows, asked, ["f1"], "left_semi").groupBy("f1").agg(place)
    listed = F.collect_list(F.struct("place.start", "place.end", F.col("f1").alias("node"))).alias("places")
    places = stage(places.groupBy(F.col("place.own").alias("own")).agg(listed), "places").hint("shuffle_hash")
    texts = hub_join(docs.select("own", "text"), places, ["own"], "inner")
    sets = stage(_sets(texts, k).dropDuplicates(["node"]), "sets")
    linked = components(link_buckets(met, sets, threshold)).withColumnRenamed("node", "f1")
    linked = hub_join(linked, sets.select(F.col("node").alias("f1"), "f2"), ["f1"], "inner")

    # like: the component of paragraphs alike; span: the words of its longest
    copies = rows.groupBy("f1", "f2").agg(F.count("*").alias("copies"), F.max("n_words").alias("most"))
    groups = hub_join(copies, linked, ["f1", "f2"], "left").where("copies > 1 OR component IS NOT NULL")
    groups = stage(groups.select("f1", "f2", "most", F.coalesce("component", "f1").alias("like")), "groups")
    spans = groups.groupBy("like").agg(F.max("most").alias("span"))
    groups = stage(hub_join(groups.drop("most"), spans, ["like"], "inner"), "spans")
    found = stage(hub_join(rows.drop("own"), groups, ["f1", "f2"], "inner").drop("f1", "f2"), "alike")
    clusters = components(_ties(found, least))
    found = found.withColumn("node", _node("row", F.col("line"))).drop("row", "line", "span")
    found = stage(hub_join(found, clusters, ["node"], "inner").drop("node"), "clustered")
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    return hub_join(found, first, ["component"], "inner").select(
        "doc_id",
        "start",
        "end",
        "n_words",
        F.xxhash64("like", "first.doc_id", "first.start").alias("cluster_id"),
        F.col("first.doc_id").alias("keep_doc_id"),
        (F.struct("doc_id", "start").eqNullSafe(F.col("first"))).alias("kept"),
    )
