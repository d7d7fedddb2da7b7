"""Set similarity join by parity sketches.

Each token toggles bits of a sketch, so the Hamming distance of two sketches is at most
the symmetric difference of the sets. Two sets of a size band whose Jaccard similarity
reaches the threshold differ in at most D tokens; a sketch of more than D segments then
has a segment that is equal in both (pigeonhole). Sets are joined on (band, segment, its
XOR of token hashes), candidates are cut down by the Hamming distance of their whole
sketches, and the rest are verified on the full sets.

Segments with very few tokens are equal by accident in many sets. A sketch has some
segments more than D + 1, so that a set may leave its poor segments out: a pair agrees in
more segments than either has poor ones, unless both have too many, and sets with too
many give all their segments. So no pair is lost, and no bucket fills up with strangers.

Equal sets are one node. A bucket's members are first compared with one of them, then with a few
others, which links a group of near copies in linear time; of buckets with the same members one
is looked at further; only buckets whose members are still in several
components are then compared pair by pair, in blocks of bounded size, inside tasks: first the
nearest pairs that would join the components are verified, then what is still apart.
Nothing is capped and no list of a bucket's members is ever built.

A set is named by its fingerprint, so two texts under one id are two sets with links of their
own; a component is named by the smallest id in it.

Defined results: a null or empty text has an empty set and no links. Rows with a null id
have links like any other, and a null component. Of repeated ids each row stays, with the
component of its own text. Ids are whole numbers; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from propgraph.llm import shingles
from propgraph.llm.common import slices, whole_text
from propgraph.llm.components import components
from propgraph.operators.joins import fresh, hub_join
from propgraph.staging import new_path, stage, staging, write_once

BLOCK = 512  # members of a bucket that are compared at once with as many others
STAR_TURNS = 4  # members of a bucket that all others are compared with, first one, then the rest at once
PAIRS = 200_000  # pairs that a task compares at once
BEFORE = 4  # other buckets of a member that a pair is looked for in
SKETCH_BITS = 1 << 15  # the longest sketch that is kept for the Hamming distance


@dataclass(frozen=True)
class Threshold:
    """Linked are sets with ``den`` * intersection >= ``num`` * union."""

    num: int
    den: int

    @cache
    def edges(self, most: int = 1 << 31) -> list[int]:
        """The least size of each band; a set's partners are in its own or a neighbouring one."""
        out = [1]
        while out[-1] <= most:
            out.append(out[-1] * self.den // self.num + 1)
        return out

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.edges(), size, side="right")) - 1

    @cache
    def layout(self, band: int) -> tuple[int, int, int]:
        """Segments, tokens a segment must have not to be poor, and poor ones a set may leave out.

        For pairs whose smaller set lies in ``band``. D follows from i >= t (a + b) / (1 + t)
        and b <= a / t.
        """
        low, high = self.edges()[band], self.edges()[band + 1] - 1
        d = high * (self.den - self.num) // self.num
        for tokens in (2, 1):
            for spare in range(d // 4 + 3):
                k = d + 1 + spare
                rate = low / k
                poor = k * math.exp(-rate) * (1 + rate * (tokens == 2))
                if poor + 2.5 * math.sqrt(poor) <= spare:
                    return k, tokens, spare
        return d + 1, 1, 0

    def holds(self, common: Column, a: Column, b: Column) -> Column:
        return common * self.den >= self.num * (a + b - common)

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The most tokens in which linked sets of these sizes differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)


def _xor_by(segment: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(k, np.uint64)
    np.bitwise_xor.at(out, segment, values)
    return out


def segment_keys(tokens: np.ndarray, threshold: Threshold) -> np.ndarray:
    """The join keys of a set, for its own band and the one below."""
    own, keys = threshold.band(len(tokens)), []
    for band in (own, own - 1):
        if band < 0:
            continue
        k, least, spare = threshold.layout(band)
        h = shingles.mix(tokens, band + 1)
        segment = ((h >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        values, counts = _xor_by(segment, h, k), np.bincount(segment, minlength=k)
        place = np.uint64(band) << np.uint64(32) | np.arange(k, dtype=np.uint64)
        names = shingles.mix(values ^ shingles.mix(place, 1), 2)
        rich = counts >= least
        keys.append(names[rich] if k - rich.sum() <= spare else names)
    return np.concatenate(keys).view(np.int64)


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """Bits, as 64-bit words, whose number is a power of two and at least that of the tokens.

    Strangers differ in nearly half of them, which is far above what linked sets may differ in.
    """
    bits = min(SKETCH_BITS, max(64, 1 << (len(tokens) - 1).bit_length()))
    at = (shingles.mix(tokens, 3) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1, bitorder="little").view(np.uint64)


def fold(sketch: np.ndarray, n_words: int) -> np.ndarray:
    """The same tokens' sketch with fewer words (powers of two)."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, n_words), axis=0)


def set_prints(tokens: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit fingerprints of a set."""
    one = int(np.bitwise_xor.reduce(shingles.mix(tokens, 4)))
    two = int(np.add.reduce(shingles.mix(tokens, 5)))
    half = np.array([one, two], np.uint64).view(np.int64)
    return int(half[0]), int(half[1])


def many_prints(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``set_prints`` of sets that stand one after another in ``tokens``."""
    one = np.bitwise_xor.reduceat(shingles.mix(tokens, 4), starts)
    return one.view(np.int64), np.add.reduceat(shingles.mix(tokens, 5), starts).view(np.int64)


# steps over texts


def _keyed(docs: DataFrame, k: int, threshold: Threshold) -> DataFrame:
    """doc_id, own, n, f1, f2 of each row's set, and its join keys; the fingerprints are 0 for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            sets = [shingles.shingle_set(t, k) for t in batch.column("text").to_pylist()]
            prints = [set_prints(s) if len(s) else (0, 0) for s in sets]
            columns = [[len(s) for s in sets], [p[0] for p in prints], [p[1] for p in prints]]
            keys = [segment_keys(s, threshold) if len(s) else s.view(np.int64) for s in sets]
            starts = np.cumsum([0, *map(len, keys)])
            listed = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate(keys)))
            named = [batch.column("doc_id"), batch.column("own")]
            arrays = [*named, *(pa.array(c, pa.int64()) for c in columns), listed]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "own", "n", "f1", "f2", "keys"])

    return docs.mapInArrow(run, "doc_id long, own long, n long, f1 long, f2 long, keys array<long>")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """node (the first fingerprint), n, tokens, sketch of each row with a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            rows = []
            for text in batch.column("text").to_pylist():
                tokens = shingles.shingle_set(text, k)
                if len(tokens):
                    rows.append((set_prints(tokens)[0], len(tokens), tokens.view(np.int64), parity_sketch(tokens).tobytes()))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                arrays = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "n", "tokens", "sketch"])

    return docs.select("text").mapInArrow(run, "node long, n long, tokens array<long>, sketch binary")


@F.arrow_udf(IntegerType())
def _hamming(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
        n = min(len(x), len(y))
        out.append(int(np.bitwise_count(fold(x, n) ^ fold(y, n)).sum()))
    return pa.array(out, pa.int32())


def verify(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """The linked ones among ``pairs`` (a, b: nodes of ``sets``): by size, then by sketch, then by all tokens."""

    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    # a is the centre of a bucket, so it may stand in very many pairs; the sets grow with the data
    near = hub_join(pairs, side("a", "n", "sketch").hint("merge"), ["a"], "inner")
    near = hub_join(near, side("b", "n", "sketch").hint("merge"), ["b"], "inner")
    n_a, n_b = F.col("n_a"), F.col("n_b")
    differ = F.floor((n_a + n_b) * (threshold.den - threshold.num) / (threshold.den + threshold.num))
    near = near.where(threshold.holds(F.least(n_a, n_b), n_a, n_b)).where(_hamming("sketch_a", "sketch_b") <= differ)
    near = stage(near.select("a", "b"), "near-pairs")
    both = hub_join(near, side("a", "n", "tokens").hint("merge"), ["a"], "inner")
    both = hub_join(both, side("b", "n", "tokens").hint("merge"), ["b"], "inner")
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return stage(both.where(threshold.holds(common, n_a, n_b)).select("a", "b"), "verified")


# pairs of buckets


def _block_pairs(members: DataFrame, sets: DataFrame, threshold: Threshold, forest: bool) -> DataFrame:
    """Pairs of nodes of one bucket and two components that may be linked by their sketches.

    ``members``: key, node, component. A bucket is dealt into blocks, and each two blocks meet in
    one group of at most 2 * BLOCK rows, so a large bucket is many groups. The sets join last,
    so they are shuffled once.

    ``forest``: only the nearest pairs that join the components of a group, one less than it has
    components at most. Otherwise a pair that is also in one of the last buckets before, by key, of
    both its nodes is left to that one; so the first bucket of a pair always gives it.
    """
    by_node = Window.partitionBy("node").orderBy("key")
    before = [] if forest else [f"before_{i}" for i in range(BEFORE)]
    members = members.select("key", "node", "component", *[F.lag("key", i + 1).over(by_node).alias(c) for i, c in enumerate(before)])
    sizes = members.groupBy("key").agg(F.count("*").alias("size"))
    members = hub_join(members, sizes, ["key"], "inner")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = members.withColumn("blocks", blocks)
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "key",
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        "mine",
        "node",
        "component",
        *before,
    )
    rows = hub_join(rows, sets.select("node", "n", "sketch").hint("merge"), ["node"], "inner")
    group = ["key", "i", "j"]
    dealt = rows.repartition(*group).sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if rest is None else pa.concat_tables([rest, part])
            cuts = _cuts(part, group)
            yield from _compare(part, cuts, threshold, forest)
            rest = part.slice(cuts[-1])  # its group may go on in the next batch
        if rest is not None:
            yield from _compare(rest, [0, len(rest)], threshold, forest)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _cuts(part: pa.Table, by: list[str]) -> list[int]:
    """Where groups of equal ``by`` begin in a sorted table."""
    new = np.zeros(max(0, len(part) - 1), bool)
    for name in by:
        column = part.column(name).to_numpy()
        new |= column[1:] != column[:-1]
    return [0, *(np.flatnonzero(new) + 1).tolist()]


@cache
def _triangle(size: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(size, 1)


def _compare(part: pa.Table, cuts: list[int], threshold: Threshold, forest: bool) -> Iterator[pa.RecordBatch]:
    """The pairs within each group, PAIRS at a time, that their sketches do not rule out."""
    column = {c: part.column(c).to_numpy() for c in ("i", "j", "mine", "node", "component", "n")}
    sketches = [np.frombuffer(s, np.uint64) for s in part.column("sketch").to_pylist()]
    groups = np.searchsorted(np.array(cuts), np.arange(len(part)), side="right")
    left, right, waiting = [], [], 0
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if column["i"][a] == column["j"][a]:
            x, y = _triangle(b - a)
        else:
            first = column["mine"][a:b] == column["i"][a]
            x, y = (g.ravel() for g in np.meshgrid(np.flatnonzero(first), np.flatnonzero(~first)))
        left.append(x + a)
        right.append(y + a)
        waiting += len(x)
        if waiting >= PAIRS or k == len(cuts) - 2:
            x, y, away = _near(np.concatenate(left), np.concatenate(right), column, sketches, threshold)
            if forest:
                x, y = _forest(x, y, away, groups, column["component"])
            else:
                x, y = _first_met(x, y, part)
            x, y = column["node"][x], column["node"][y]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])
            left, right, waiting = [], [], 0


def _first_met(x: np.ndarray, y: np.ndarray, part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that have no bucket in common among the last ones before."""
    before = [part.column(f"before_{i}") for i in range(BEFORE)]
    there, keys = [c.is_valid().to_numpy() for c in before], [c.fill_null(0).to_numpy() for c in before]
    met = np.zeros(len(x), bool)
    for i in range(BEFORE):
        for j in range(BEFORE):
            met |= there[i][x] & there[j][y] & (keys[i][x] == keys[j][y])
    return x[~met], y[~met]


def _forest(
    x: np.ndarray, y: np.ndarray, away: np.ndarray, groups: np.ndarray, component: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs, the nearest first, that join two components of their group which no pair before has joined."""
    root = np.unique(np.stack([groups, component]), axis=1, return_inverse=True)[1].ravel()
    above = list(range(int(root.max()) + 1))

    def find(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    kept = []
    for at in np.argsort(away, kind="stable").tolist():
        p, q = find(int(root[x[at]])), find(int(root[y[at]]))
        if p != q:
            above[p] = q
            kept.append(at)
    return x[kept], y[kept]


def _near(
    x: np.ndarray, y: np.ndarray, column: dict, sketches: list[np.ndarray], threshold: Threshold
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of the pairs (places of rows) that are of two components and that sizes and sketches do not rule out.

    Also how far apart they are, as a share of the tokens.
    """
    n = column["n"]
    apart = column["component"][x] != column["component"][y]
    sized = np.minimum(n[x], n[y]) * threshold.den >= np.maximum(n[x], n[y]) * threshold.num
    x, y = x[apart & sized], y[apart & sized]
    widths = np.array([len(s) for s in sketches])
    width, far = np.minimum(widths[x], widths[y]), np.zeros(len(x))
    for w in np.unique(width).tolist():
        of_width = np.flatnonzero(width == w)
        rows = np.unique(np.concatenate([x[of_width], y[of_width]]))
        bits = np.stack([fold(sketches[r], w) for r in rows.tolist()])
        step = max(1, (1 << 22) // w)
        for at in range(0, len(of_width), step):
            some = of_width[at : at + step]
            p, q = np.searchsorted(rows, x[some]), np.searchsorted(rows, y[some])
            far[some] = np.bitwise_count(bits[p] ^ bits[q]).sum(axis=1)
    close = far <= threshold.differ(n[x], n[y])
    x, y = x[close], y[close]
    return x, y, far[close] / (n[x] + n[y])


def link_buckets(buckets: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """Verified links (a, b) that join all nodes which any chain of links within buckets joins.

    ``buckets``: key, node, distinct. ``sets``: node, n, tokens, sketch. First the members of a bucket
    are compared with one of them, then with a few others; then, in buckets that are still of several
    components, the nearest pairs that would join these; last whatever pairs are left apart.
    """
    spark = buckets.sparkSession
    path, links = new_path(spark, "links"), None
    with staging(spark):
        placed = buckets.select("key", "node", F.col("node").alias("component"))
        for turn, orders in enumerate(([0], range(1, STAR_TURNS))):
            if not orders:
                break
            pairs = stage(_stars(placed, orders), "stars")
            found = verify(pairs, sets, threshold)
            if links is not None and found.isEmpty():
                break
            links = found if links is None else links.unionByName(found)
            placed = _still_mixed(placed, links)
            if turn == 0:
                if placed.isEmpty():
                    return write_once(links, path)
                placed = _once_each(placed)
        nearest = verify(stage(_block_pairs(placed, sets, threshold, forest=True), "nearest-pairs"), sets, threshold)
        links = links.unionByName(nearest)
        placed = _still_mixed(placed, links)
        rest = verify(stage(_block_pairs(placed, sets, threshold, forest=False), "block-pairs"), sets, threshold)
        return write_once(links.unionByName(rest), path)


def _stars(placed: DataFrame, orders: Iterable[int]) -> DataFrame:
    """a, b: the members of each bucket with its first one by each order, where they are of two components."""
    # the same order in all buckets, so most pairs come up once
    order = [F.struct(F.xxhash64("node", F.lit(i)).alias("order"), "node", "component") for i in orders]
    firsts = placed.groupBy("key").agg(*[F.min(c).alias(f"first_{i}") for i, c in enumerate(order)])
    centres = [F.struct(F.col(f"first_{i}.node").alias("a"), F.col(f"first_{i}.component").alias("of_a")) for i in range(len(order))]
    centres = firsts.select("key", F.inline(F.array_distinct(F.array(*centres))))
    stars = hub_join(placed, centres, ["key"], "inner").where("component <> of_a")
    return stars.select("a", F.col("node").alias("b")).distinct()


def _once_each(placed: DataFrame) -> DataFrame:
    """``placed`` with one of the buckets that have the same members, by fingerprint: their pairs are the same.

    Two near copies meet in very many buckets, mostly without others.
    """
    halves = [F.sum(F.xxhash64("node", F.lit(i)).bitwiseAND(F.lit((1 << 31) - 1))).alias(f"h{i}") for i in range(4)]
    prints = placed.groupBy("key").agg(F.count("*").alias("size"), *halves)
    same = ["size", *(f"h{i}" for i in range(4))]
    chosen = stage(prints.groupBy(*same).agg(F.min("key").alias("key")).select("key"), "distinct-buckets")
    return stage(hub_join(placed, chosen, ["key"], "left_semi"), "once-each")


def _still_mixed(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``placed`` (key, node, component) after ``links``, without buckets that are of one component now."""
    placed = hub_join(placed.drop("component"), components(links), ["node"], "left")
    placed = stage(placed.select("key", "node", F.coalesce("component", "node").alias("component")), "placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return stage(hub_join(placed, mixed.select("key"), ["key"], "left_semi"), "mixed-buckets")


def _groups(docs: DataFrame, k: int, threshold: Threshold) -> DataFrame:
    """doc_id, own, n, group of each row of ``docs`` (doc_id, own, text).

    ``group`` is null where the set is alone; it is the same number for all that links reach.
    """
    spark = docs.sparkSession
    members, met = new_path(spark, "members"), new_path(spark, "met")
    with staging(spark):
        keyed = stage(_keyed(docs, k, threshold), "keyed")
        members = write_once(keyed.drop("keys"), members)
        keys = keyed.select(F.explode("keys").alias("key"), "f1")
        # several sets in one bucket; copies of a set are combined before the shuffle
        shared = keys.groupBy("key").agg(F.min("f1").alias("x"), F.max("f1").alias("y")).where("x <> y").select("key")
        shared = stage(shared, "shared-keys").hint("shuffle_hash")
        met = write_once(hub_join(keys, shared, ["key"], "left_semi").distinct(), met)
    nodes = members.where("n > 0").groupBy("f1").agg(F.min("own").alias("own"), F.count("*").alias("copies"))
    nodes = stage(nodes, "nodes")
    asked = hub_join(nodes, met.select("f1").distinct(), ["f1"], "left_semi").select("own")
    asked = hub_join(docs, stage(asked, "asked").hint("merge"), ["own"], "left_semi")
    sets = stage(_sets(asked, k).dropDuplicates(["node"]), "sets")
    buckets = met.select("key", F.col("f1").alias("node"))
    linked = components(link_buckets(buckets, sets, threshold)).select(F.col("node").alias("f1"), "component")
    grouped = hub_join(nodes.select("f1", "copies"), linked, ["f1"], "left").where("copies > 1 OR component IS NOT NULL")
    grouped = stage(grouped.select("f1", F.coalesce("component", "f1").alias("group")), "groups")
    return hub_join(members, grouped, ["f1"], "left").select(
        "doc_id", "own", "n", F.when(F.col("n") > 0, F.col("group")).alias("group")
    )


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, own (names the id and the text), text."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("own"), "text")


def jaccard_groups(
    docs: DataFrame,
    k: int = 5,
    threshold: Threshold = Threshold(80, 100),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id (the smallest id that links reach, its own included)."""
    rows = stage(_groups(_named(docs, id_col, text_col), k, threshold), "grouped")
    least = rows.where("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("least"))
    placed = hub_join(rows, stage(least, "least"), ["group"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return placed.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(
    docs: DataFrame,
    k: int = 5,
    threshold: Threshold = Threshold(80, 100),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, without those that a row of a smaller id is linked to by a chain.

    Of two texts of one id and one group one stays; repeated rows stay or go together. Rows with
    a null id stay, and nothing goes on their account alone.
    """
    rows = stage(_groups(_named(docs, id_col, text_col), k, threshold), "grouped")
    rows = rows.where("group IS NOT NULL AND doc_id IS NOT NULL")
    first = rows.groupBy("group").agg(F.min(F.struct("doc_id", "own")).alias("first"))
    dropped = hub_join(rows, stage(first, "first"), ["group"], "inner").where("own <> first.own")
    dropped = stage(dropped.select("own").distinct(), "near-copies")
    key = fresh("_own", docs)
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col).cast("long"), whole_text(text_col)))
    return hub_join(keyed, dropped.withColumnRenamed("own", key).hint("merge"), [key], "left_anti").drop(key)
