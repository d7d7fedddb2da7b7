"""Prefix trie of conversations, measured by an Euler tour.

Turns are hashed where they are read; from then on a turn is two 64-bit hashes and a length.
The first d turns of a conversation are named by the XOR of their hashes with their places,
128 bits in all, and equal names are one node. Each node gives an enter and an exit arc; the arcs are linked into
one tour, the tour is ranked (``list_rank``), and the sums of leaves and savings before a
node's exit less those before its enter arc are those of its subtree.

Nothing depends on a group being small: turns, siblings and the tour are numbered by ranges,
long conversations are scanned in blocks, and the ids that end at one node are hashed as a
stream. Children are visited in the order of their smallest members.

Defined results: turns are ordered by turn (null first), then role, then text; a null role
or text is empty; repeated rows are turns of their own. Rows with a null conv_id are no
conversation and are left out. Without conversations there is no node. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propgraph.llm.list_rank import BLOCK, prefix_sums
from propgraph.operators.joins import fresh, hub_join
from propgraph.operators.shape import row_key
from propgraph.staging import stage

SCAN = 4096  # turns of a conversation that one window scans
PIECE = 4096  # characters of ids that are handed on at once
HEADS, CENTURY = 6, 100


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns: conv_id, at (from 1), h1, h2, chars. Conversations: conv_id, n."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    hashed = rows.select(
        "*",
        F.xxhash64(F.lit(1), "role", "text").alias("h1"),
        F.xxhash64(F.lit(2), "role", "text").alias("h2"),
        F.char_length("text").cast("long").alias("chars"),
    )
    order = ["conv_id", "turn", "role", "text"]
    turns = row_key(hashed, order, name="key", keep=["conv_id", "h1", "h2", "chars"])
    counted = turns.groupBy("conv_id").agg(F.min("key").alias("start"), F.count("*").alias("n"))
    convs = stage(counted, "conversations")
    placed = hub_join(turns, convs.select("conv_id", "start"), ["conv_id"], "inner")
    at = (F.col("key") - F.col("start") + 1).alias("at")
    return stage(placed.select("conv_id", at, "h1", "h2", "chars"), "turns"), convs.select("conv_id", "n")


def borrowed_heads(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths after each conversation c took its first h turns from c - c % 100; h = crc32(c) % 6."""
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("long")
    plans = convs.select("conv_id", "n", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % CENTURY).alias("base"))
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))
    plans = plans.join(lengths, "base", "left").select("conv_id", "n", "h", "base", taken.alias("taken"))
    plans = stage(plans.withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "plans")

    columns = ["conv_id", "at", "h1", "h2", "chars", "total"]
    own = hub_join(turns, plans.select("conv_id", "h", "taken", "total"), ["conv_id"], "inner").where("at > h")
    own = own.withColumn("at", F.col("taken") + F.col("at") - F.col("h")).select(*columns)
    # at most five turns of each, wanted by fewer than two centuries of conversations
    lent = turns.where((F.col("conv_id") % CENTURY == 0) & (F.col("at") < HEADS)).withColumnRenamed("conv_id", "base")
    heads = plans.select("conv_id", "base", "h", "total").join(lent, "base").where("at <= h").select(*columns)
    return own.unionByName(heads), plans.select("conv_id", "total")


def running_xor(df: DataFrame, key: str, at: str, values: Sequence[str], most: int, size: int = SCAN) -> DataFrame:
    """``values`` replaced by the XOR of those up to and with ``at`` (0 to ``most``) of the same ``key``.

    A window sees at most ``size`` rows; beyond that the blocks' own XORs are scanned likewise.
    """
    columns, block = df.columns, fresh("_block", df)
    df = df.withColumn(block, F.expr(f"{at} div {size}"))
    upto = Window.partitionBy(key, block).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = df.select(*[F.bit_xor(c).over(upto).alias(c) if c in values else F.col(c) for c in df.columns])
    if most < size:
        return within.select(*columns)
    blocks = df.groupBy(key, block).agg(*[F.bit_xor(v).alias(v) for v in values])
    before = running_xor(blocks, key, block, values, most // size, size)
    # places have no gaps, so the block before one is there
    before = before.select(key, (F.col(block) + 1).alias(block), *[F.col(v).alias(f"{block}_{v}") for v in values])
    joined = within.join(before, [key, block], "left")
    both = [
        F.col(c).bitwiseXOR(F.coalesce(f"{block}_{c}", F.lit(0))).alias(c) if c in values else F.col(c) for c in columns
    ]
    return joined.select(*both)


def _ends(ends: DataFrame) -> DataFrame:
    """p1, p2, depth, ends_sha256: the ids that end at a node, ascending, comma-joined.

    Neighbours of one range are joined to pieces of bounded size first; the pieces of a node
    pass through one digest in order.
    """
    names = ["p1", "p2", "depth"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()]
        node, first, ids, size = None, 0, [], 0
        for batch in batches:
            done = []
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (key != node or size >= PIECE):
                    done.append((*node, first, ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    node, first = key, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if done:
                columns = [pa.array(list(c), k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "first", "ids"])
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip((*node, first, ",".join(ids)), kinds, strict=True)], [*names, "first", "ids"]
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 3 + [pa.string()]
        node, state = None, None

        def out(done: list) -> pa.RecordBatch:
            columns = [pa.array(list(c), k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, [*names, "ends_sha256"])

        for batch in batches:
            done = []
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            if done:
                yield out(done)
        if node is not None:
            yield out([(*node, state.hexdigest())])

    order = [*names, "conv_id"]
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
    parts = ranged.mapInArrow(pieces, "p1 long, p2 long, depth long, first long, ids string")
    sorted_parts = parts.repartition(*names).sortWithinPartitions(*names, "first")
    return sorted_parts.mapInArrow(digests, "p1 long, p2 long, depth long, ends_sha256 string")


def _nodes(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes under a dense number by (conv_id, depth): node, conv_id, depth, p1, p2, up1, up2, n_convs, chars."""
    found = prefixes.groupBy("p1", "p2", F.col("at").alias("depth")).agg(
        F.max("up1").alias("up1"),
        F.max("up2").alias("up2"),
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("chars").alias("chars"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        *[zero.alias(c) for c in ("p1", "p2", "depth", "chars")], none.alias("up1"), none.alias("up2"), "conv_id", "n_convs"
    )
    return row_key(stage(found.unionByName(root), "nodes"), ["conv_id", "depth"], name="node")


def _tour(nodes: DataFrame) -> DataFrame:
    """``nodes`` with parent, parent_conv_id, n_children, and the next arc after each of a node's two."""
    above = nodes.select(
        F.col("p1").alias("up1"),
        F.col("p2").alias("up2"),
        (F.col("depth") + 1).alias("depth"),
        F.col("node").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    tree = stage(hub_join(nodes, above, ["up1", "up2", "depth"], "left").drop("up1", "up2"), "tree")
    below = tree.where("parent IS NOT NULL").select("parent", "node")
    children = below.groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children"), F.min("node").alias("first_child")
    )
    seats = row_key(below, ["parent", "node"], name="seat")
    here = seats.select("seat", "node", F.col("parent").alias("of"))
    right = seats.select((F.col("seat") - 1).alias("seat"), F.col("node").alias("sibling"), F.col("parent").alias("of"))
    siblings = here.join(right, ["seat", "of"]).select("node", "sibling")
    joined = tree.join(children, "node", "left").join(siblings, "node", "left")
    enter, leave = _arc("node", 0), _arc("node", 1)
    return stage(
        joined.select(
            *tree.columns,
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            enter.alias("enter"),
            F.coalesce(_arc("first_child", 0), leave).alias("after_enter"),
            leave.alias("leave"),
            F.coalesce(_arc("sibling", 0), _arc("parent", 1)).alias("after_leave"),
        ),
        "tour",
    )


def _arc(node: str, leaving: int) -> Column:
    return F.col(node) * 2 + leaving


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK, scan: int = SCAN) -> DataFrame:
    """The nodes of all conversations, even those without turns.

    ``turns``: conv_id, at (1, 2, … without gaps), h1, h2, chars, total (the conversation's
    length); ``convs``: conv_id, total. Returns conv_id (the smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, entered (the place
    of its enter arc in the tour).
    """
    most = convs.agg(F.max("total")).first()[0] or 0
    salted = turns.select(
        *["conv_id", "at", "chars", "total"],
        *[F.xxhash64(F.lit(i), "at", "h1", "h2").alias(f"{kind}{i}") for kind in ("s", "p") for i in (1, 2)],
    )
    prefixes = running_xor(salted, "conv_id", "at", ["p1", "p2"], most, scan).select(
        *["conv_id", "at", "chars", "total", "p1", "p2"],
        *[F.col(f"p{i}").bitwiseXOR(F.col(f"s{i}")).alias(f"up{i}") for i in (1, 2)],
    )
    prefixes = stage(prefixes, "prefixes")
    tour = _tour(_nodes(prefixes, convs))

    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    saved = (F.col("n_convs") - 1) * F.col("chars")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    arcs = F.array(
        F.struct(F.col("enter").alias("id"), F.col("after_enter").alias("next"), leaf.alias("leaves"), saved.alias("saved")),
        F.struct(F.col("leave").alias("id"), F.col("after_leave").alias("next"), zero.alias("leaves"), zero.alias("saved")),
    )
    sums = prefix_sums(tour.select(F.inline(arcs), one.alias("arcs")), ["arcs", "leaves", "saved"], block)
    leaving = F.col("id").bitwiseAND(1) == 1

    def inside(name: str) -> Column:
        return F.sum(F.when(leaving, F.col(name)).otherwise(-F.col(name)))

    subtrees = sums.groupBy(F.shiftright("id", 1).alias("node")).agg(
        inside("before_leaves").alias("n_leaves"), inside("before_saved").alias("saved_tokens"), F.min("before_arcs").alias("entered")
    )

    at_turn = prefixes.where("at = total").select("p1", "p2", F.col("at").alias("depth"), "conv_id")
    at_root = convs.where("total = 0").select(*[zero.alias(c) for c in ("p1", "p2", "depth")], "conv_id")
    ended = hub_join(tour.join(subtrees, "node"), _ends(at_turn.unionByName(at_root)), ["p1", "p2", "depth"], "left")
    return ended.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        "entered",
    )


def rebuilt_trie(conversations: DataFrame, block: int = BLOCK, scan: int = SCAN) -> DataFrame:
    """The trie of the conversations after ``borrowed_heads``."""
    turns, lengths = borrowed_heads(*numbered_turns(conversations))
    return trie(turns, lengths, block, scan)
