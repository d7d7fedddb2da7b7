"""Runs of words that occur again elsewhere, wherever they stand in a line.

Seeds are short windows of words, chosen by winnowing (Schleimer et al., SIGMOD 2003): of any
``least - SEED + 1`` windows in a row that with the least hash is a seed. So two copies of
``least`` words have a seed in common, whatever is around them. Around the seeds that occur
twice all windows of ``least`` words are hashed, and those that occur twice are what repeats:
no pairs are made, and a window's copies only meet in an aggregate. Overlapping windows of a
text are one run; runs are tied to the run of the first copy of each of their windows, and
clusters are the components.

Equal texts are one body, which is searched once. A body under several ids repeats as a whole;
within bodies the windows decide. Repeated rows (one id and text) are one document. A run is
kept if it holds the first copy (by id, null first, then text, then place) of any of its
windows, or words that occur nowhere else; so of all that repeats one copy stays. Words are
lower-cased (A-Z) and compared by their hashes, windows and bodies by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propgraph.llm import shingles
from propgraph.llm.common import slices
from propgraph.llm.components import components
from propgraph.operators.joins import hub_join
from propgraph.staging import stage

SEED = 16
WORD_BITS = 31  # of a place: more words than a text can have
SPACE = " \t\n\v\f\r"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each window of ``k`` words, by doubling; there must be one."""
    n = len(hashes) - k + 1
    power, factor, width, out, done = shingles.mix(hashes), _ODD, 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            if k & width:
                part = power[done : done + n]
                out = part.copy() if out is None else out * factor + part
                done += width
            if done == k:
                return shingles.mix(out)
            power = power[:-width] * factor + power[width:]
            factor, width = factor * factor, width * 2


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each ``width`` neighbours."""
    n, span = len(values) - width + 1, 1
    while 2 * span <= width:
        values, span = pick(values[:-span], values[span:]), span * 2
    return pick(values[:n], values[width - span : width - span + n])


def seed_places(hashes: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds of texts of ``counts`` words that stand one after another: text, place within it, hash.

    Of each ``least`` words in a row at least one, the same in every copy.
    """
    size, width = min(SEED, least), max(least - SEED, 0) + 1
    if len(hashes) < least:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    begins = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    left = begins[text] + counts[text] - np.arange(len(hashes))  # words from here to the end of its text
    found = window_hashes(hashes, size)
    lows = _sliding(found, width, np.minimum)
    # no window reaches beyond the ends; texts in a row are kept apart by the last places of each
    lows[left[: len(lows)] < least] = 0
    edge = np.zeros(width - 1, np.uint64)
    highest = _sliding(np.concatenate([edge, lows, edge]), width, np.maximum)
    at = np.flatnonzero((highest == found) & (left[: len(found)] >= size) & (counts >= least)[text[: len(found)]])
    return text[at], at - begins[text[at]], found[at]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word, in characters of the text whose UTF-8 bytes are given."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    turns = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return chars[turns[::2]], chars[turns[1::2]]


def text_facts(texts: list[str], hashes: np.ndarray, counts: np.ndarray, least: int) -> Iterator[tuple]:
    """first, last (characters of its words), total (words), seed_at, seeds of each of ``texts``, all with words.

    ``hashes`` has the words of all texts in order, ``counts`` how many each has.
    """
    of, places, found = seed_places(hashes, counts, least)
    cuts = np.searchsorted(of, np.arange(1, len(texts)))
    seeds = zip(np.split(places, cuts), np.split(found.view(np.int64), cuts), strict=True)
    for text, total, (at, seed) in zip(texts, counts.tolist(), seeds, strict=True):
        yield len(text) - len(text.lstrip(SPACE)), len(text.rstrip(SPACE)), total, at, seed


def body_of(text: str = "text"):
    return F.xxhash64(text)


def facts_of(texts: DataFrame, least: int) -> DataFrame:
    """doc_id, own, body, first, last, total, seed_at, seeds of each row with words. ``texts``: doc_id, own, text."""
    names = ["doc_id", "own", "body", "first", "last", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.list_(pa.int64())] * 2
        for batch in slices(batches, "text", 1 << 20):
            rows, found = [], []
            for *row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "own", "body", "text")), strict=True):
                if words := shingles.words(text):
                    rows.append((row, text, len(words)))
                    found += words
            if rows:
                counts = np.array([r[-1] for r in rows])
                told = text_facts([r[1] for r in rows], shingles.hash_words(found), counts, least)
                rows = [(*r[0], *facts) for r, facts in zip(rows, told, strict=True)]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "seed_at", "seeds"])

    longs = ", ".join(f"{n} long" for n in names)
    chosen = texts.select("doc_id", "own", body_of().alias("body"), "text")
    return chosen.mapInArrow(run, f"{longs}, seed_at array<long>, seeds array<long>")


def _ranked(wanted: DataFrame) -> DataFrame:
    """``wanted`` with ``rank``: 0, 1, … by least_doc, null first, and body."""
    rows = (1 << 33) - 1  # of a partition
    placed = wanted.orderBy("least_doc", "body").withColumn("at", F.monotonically_increasing_id())
    placed = stage(placed.withColumn("part", F.shiftrightunsigned("at", 33)), "ordered-bodies")
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")
    ranked = placed.join(F.broadcast(sizes.select("part", before.alias("before"))), "part")
    return ranked.withColumn("rank", F.col("before") + F.col("at").bitwiseAND(F.lit(rows))).drop("part", "at", "before")


def _windows(texts: DataFrame, least: int) -> DataFrame:
    """place, run, start, end of the windows whose seed is in one of ``places``; ``place`` has the body's rank and the first word."""
    schema = "place long, run long, start int, end int"
    names = ["place", "run", "start", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = min(SEED, least)
        for batch in slices(batches, "text", 1 << 20):
            parts = []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("places"), strict=True):
                data = text.encode()
                hashes = shingles.hash_words(data.translate(shingles.ASCII_LOWER).split())
                # the seed of a window is that with the least hash within it
                short = window_hashes(hashes, size)
                s = np.flatnonzero(np.isin(_sliding(short, least - size + 1, np.minimum), short[places.values.to_numpy()]))
                found = window_hashes(hashes, least)[s].view(np.int64)
                starts, ends = word_spans(data)
                parts.append((s, found, starts[s], ends[s + least - 1]))
            ranks = np.repeat(batch.column("rank").to_numpy(), [len(p[0]) for p in parts])
            s, found, starts, ends = (np.concatenate(c) for c in zip(*parts, strict=True))
            columns = [ranks << WORD_BITS | s, found, starts.astype(np.int32), ends.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return texts.mapInArrow(run, schema)


def _spans(repeated: DataFrame, least: int) -> DataFrame:
    """Per run of a body: rank, s0, s1 (words), start, end (characters), kept, of (the first copy's rank), and ``ties`` to first copies."""
    schema = (
        "rank long, s0 long, s1 long, start long, end long, kept boolean, of long,"
        " ties array<struct<of: long, s: long>>"
    )
    names = ["rank", "s0", "s1", "start", "end", "kept", "of", "ties"]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.list_(pa.struct([("of", pa.int64()), ("s", pa.int64())]))]
    words_of = (1 << WORD_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "found"):
            rows = []
            for rank, found in zip(batch.column("rank").to_pylist(), batch.column("found"), strict=True):
                fields = [f.to_numpy() for f in found.values.flatten()]  # place, start, end, first
                order = np.argsort(fields[0], kind="stable")
                place, start, end, first = (f[order] for f in fields)
                s, of, at, own = place & words_of, first >> WORD_BITS, first & words_of, first == place
                cuts = np.flatnonzero(s[1:] > s[:-1] + least) + 1
                # along one copy the distance to it stays the same
                new = np.concatenate([[True], (of[1:] != of[:-1]) | (np.diff(at - s) != 0)])
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(s)], strict=True):
                    ties = dict.fromkeys([a, *(a + np.flatnonzero(new[a:b])).tolist()])
                    ties = [{"of": int(of[i]), "s": int(at[i])} for i in ties if not own[i]]
                    words = int(s[a]), int(s[b - 1]) + least
                    # one of its windows is the first copy, or two passages meet that are together nowhere else
                    kept = bool(own[a:b].any() or (np.diff(s[a:b]) > 1).any())
                    rows.append((rank, *words, int(start[a]), int(end[b - 1]), kept, int(of[a]), ties))
            if rows:
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return repeated.mapInArrow(run, schema)


def repeated_runs(texts: DataFrame, facts: DataFrame, least: int) -> DataFrame:
    """doc_id, start, end, n_words, cluster_id, keep_doc_id, kept of each run.

    ``texts``: doc_id (long), own (a hash of id and text), text (not null). ``facts``: what
    ``facts_of`` gives of them, written.
    """
    # in another body, or twice in one; of repeated rows the same places come again
    seeds = facts.select("body", F.inline(F.arrays_zip(F.col("seed_at").alias("at"), F.col("seeds").alias("seed"))))
    times = seeds.groupBy("seed").agg(
        F.min("body").alias("b0"), F.max("body").alias("b1"), F.min("at").alias("a0"), F.max("at").alias("a1")
    )
    twice = stage(times.where("b0 <> b1 OR a0 <> a1").select("seed"), "seeds-again")
    places = hub_join(seeds, twice.hint("shuffle_hash"), ["seed"], "left_semi").groupBy("body")
    places = places.agg(F.collect_set("at").alias("places"))
    bodies = facts.groupBy("body").agg(
        F.min(F.struct("doc_id")).alias("least"),  # null first
        F.max(F.struct("doc_id")).alias("most"),
        F.min("own").alias("own"),
        F.max("first").alias("first"),
        F.max("last").alias("last"),
        F.max("total").alias("total"),
    )
    bodies = stage(
        bodies.select("body", F.col("least.doc_id").alias("least_doc"), (F.col("least") != F.col("most")).alias("copied"), "own", "first", "last", "total"),
        "bodies",
    )
    wanted = hub_join(places, bodies.select("body", "own", "least_doc").hint("merge"), ["body"], "inner")
    wanted = stage(_ranked(wanted), "seed-places")
    asked = wanted.select("own", "rank", "places").hint("shuffle_hash")
    windows = stage(_windows(hub_join(texts.select("own", "text"), asked, ["own"], "inner"), least), "windows")

    again = windows.groupBy("run").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    again = stage(again.where("first <> last").select("run", "first"), "windows-again")
    copied = hub_join(windows, again.hint("merge"), ["run"], "inner")
    found = F.collect_list(F.struct("place", "start", "end", "first")).alias("found")
    spans = stage(_spans(copied.groupBy(F.shiftright("place", WORD_BITS).alias("rank")).agg(found), least), "spans")
    spans = hub_join(spans, wanted.select(F.col("rank").alias("of"), F.col("least_doc").alias("keep_doc")).hint("merge"), ["of"], "inner")
    spans = hub_join(spans.drop("of"), wanted.select("rank", "body").hint("merge"), ["rank"], "inner")

    # a body under several ids is one run, from its first word to its last
    spans = hub_join(spans, bodies.select("body", "copied", "total").hint("merge"), ["body"], "inner")
    whole = bodies.where(F.col("copied") & (F.col("total") >= least))
    elsewhere = spans.where("copied AND s0 = 0 AND s1 = total AND NOT kept").select("body", "keep_doc", F.lit(False).alias("kept"))
    whole = hub_join(whole, elsewhere.hint("merge"), ["body"], "left").select(
        "body",
        F.lit(0).cast("long").alias("s0"),
        F.col("total").alias("s1"),
        F.col("first").alias("start"),
        F.col("last").alias("end"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        F.when(F.col("kept").isNull(), F.col("least_doc")).otherwise(F.col("keep_doc")).alias("keep_doc"),
        F.xxhash64("body").alias("node"),
    )
    own_node = F.when(F.col("copied"), F.xxhash64("body")).otherwise(F.xxhash64("body", "s0"))
    ties = spans.select(own_node.alias("a"), F.inline("ties"))
    parts = spans.where("NOT copied").withColumn("node", own_node).select(*whole.columns)
    runs = stage(parts.unionByName(whole), "runs")
    holders = runs.select("body", F.col("node").alias("b"), "s0", "s1")
    holders = hub_join(holders, wanted.select("body", F.col("rank").alias("of")).hint("merge"), ["body"], "inner").drop("body")
    links = hub_join(ties, holders.hint("merge"), ["of"], "inner").where("s0 <= s AND s < s1").select("a", "b").distinct()
    clusters = components(stage(links, "ties")).withColumnRenamed("component", "cluster_id")
    runs = hub_join(runs, clusters.hint("merge"), ["node"], "left")

    ids = facts.select("body", "doc_id").distinct()
    runs = hub_join(runs, bodies.select("body", "least_doc").hint("merge"), ["body"], "inner")
    found = hub_join(ids, runs.hint("merge"), ["body"], "inner")
    stays = F.col("kept") & F.col("doc_id").eqNullSafe(F.col("least_doc"))
    return found.select(
        "doc_id",
        "start",
        "end",
        (F.col("s1") - F.col("s0")).alias("n_words"),
        F.coalesce("cluster_id", "node").alias("cluster_id"),
        F.when(F.col("kept"), F.col("least_doc")).otherwise(F.col("keep_doc")).alias("keep_doc_id"),
        stays.alias("kept"),
    )
