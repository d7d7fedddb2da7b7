"""Merkle manifest of a dataset: a tree of digests per source, one over the sources, and proofs.

Nodes carry nested-interval labels: the half-open interval of leaf ranks that they cover,
leaves being ranked by source and id. Going up, every run of 16 neighbours becomes one
node whose interval is theirs together. Going down, each node meets the node above it by
a containment join, bucketed by level, tree and place, and its siblings are the members of
that node whose intervals lie outside of its own. No list is longer than a run.

A leaf is the digest of the row's fields, each ``-`` if null, else UTF-8 byte count, colon, value.

Defined results: a null source is a source of its own and comes first, as does a null id
in its source. Rows of one source and id are ordered by their leaf digests; equal rows
have equal leaves and each has its place. An empty table gives no rows. Further columns
are ignored. Texts are hashed where they are read and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import LOWER, UPPER
from propgraph.operators.shape import row_key
from propgraph.staging import stage

RUN = 16  # neighbours that become one node
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row; ``changed`` gives other values for some of its fields."""
    return F.sha2(F.concat(*[_field(changed.get(name, F.col(name))) for name in FIELDS]), 256)


def lower_cased() -> Column:
    """The leaf of a row whose text had A-Z lower-cased, where 5 divides the crc32 of its id; else null."""
    edited = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    return F.when(edited, leaf_digest(text=F.translate("text", UPPER, LOWER)))


def ranked_leaves(docs: DataFrame, claim: Column) -> DataFrame:
    """Leaves with their labels: source, tree (rank of the source), place in it, its size, lo, hi, digest, doc_id, claim."""
    hashed = docs.select("doc_id", "source", leaf_digest().alias("digest"), claim.alias("claim"))
    ranked = row_key(stage(hashed, "leaves"), ["source", "doc_id", "digest"], name="lo")
    extents = ranked.groupBy("source").agg(F.min("lo").alias("start"), F.count("*").alias("size"))
    trees = row_key(extents, ["source"], name="tree").withColumnRenamed("source", "of")
    placed = ranked.join(trees, F.col("source").eqNullSafe(F.col("of")))
    return stage(
        placed.select(
            "source",
            "tree",
            (F.col("lo") - F.col("start")).alias("place"),
            "size",
            "lo",
            (F.col("lo") + 1).alias("hi"),
            "digest",
            F.struct("doc_id", "claim").alias("held"),
        ),
        "ranked",
    )


def _joined(members: Column) -> Column:
    return F.array_join(F.transform(members, lambda m: m["digest"]), "")


def levels_above(nodes: DataFrame) -> list[DataFrame]:
    """The runs of each level above ``nodes`` (tree, place, size, lo, hi, digest, held), lowest first.

    A run has tree, place, size (nodes of its tree on its level), members, lo, hi, digest. A
    tree whose size is 1 ends there. Each level is a group of at most ``RUN`` rows a key.
    """
    most = nodes.agg(F.max("size")).first()[0] or 0
    levels, below = [], nodes
    while most > 1:
        label = F.struct("lo", "hi", "digest", *(["held"] if "held" in below.columns else []))
        grouped = (
            below.where("size > 1")
            .groupBy("tree", F.expr(f"place div {RUN}").alias("place"))
            .agg(F.max("size").alias("size"), F.sort_array(F.collect_list(label)).alias("members"))
        )
        runs = grouped.select(
            "tree",
            "place",
            F.expr(f"(size + {RUN - 1}) div {RUN}").alias("size"),
            "members",
            F.col("members")[0]["lo"].alias("lo"),
            F.element_at("members", -1)["hi"].alias("hi"),
            F.sha2(_joined(F.col("members")), 256).alias("digest"),
        )
        below = stage(runs, f"runs-{len(levels) + 1}")
        levels.append(below)
        most = -(-most // RUN)
    return levels


def tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """tree, lo, hi, digest of the node that remains of each tree."""
    columns = ["tree", "lo", "hi", "digest"]
    found = nodes.where("size = 1").select(*columns)
    for runs in levels:
        found = found.unionByName(runs.where("size = 1").select(*columns))
    return found


def _outside(members: Column, lo: Column, hi: Column) -> Column:
    """The members of a run that the interval does not cover, before it and after it."""
    return F.struct(
        _joined(F.filter(members, lambda m: m["hi"] <= lo)).alias("left"),
        _joined(F.filter(members, lambda m: m["lo"] >= hi)).alias("right"),
    )


def _attach(runs: DataFrame, above: DataFrame | None, start: DataFrame) -> DataFrame:
    """``runs`` with ``path`` (siblings level by level upwards) and the digests that ``start`` has by tree."""
    columns = ["tree", "place", "lo", "hi", "members"]
    kept = [c for c in start.columns if c != "tree"]
    whole = runs.where("size = 1").select(*columns).join(start, "tree")
    if above is None:
        return whole
    parents = above.select(*[F.col(c).alias(f"up_{c}") for c in above.columns])
    inside = (
        (F.col("tree") == F.col("up_tree"))
        & (F.expr(f"place div {RUN}") == F.col("up_place"))
        & (F.col("up_lo") <= F.col("lo"))
        & (F.col("hi") <= F.col("up_hi"))
    )
    step = _outside(F.col("up_members"), F.col("lo"), F.col("hi"))
    rest = [F.concat(F.array(step), "up_path").alias(c) if c == "path" else F.col(f"up_{c}").alias(c) for c in kept]
    lower = runs.where("size > 1").join(parents, inside).select(*columns, *rest)
    return whole.select(*columns, *kept).unionByName(lower)


def siblings(nodes: DataFrame, levels: list[DataFrame], start: DataFrame) -> DataFrame:
    """Per node: lo, digest, held, path and what ``start`` (tree, path, …) has by tree.

    ``start`` gives the siblings above each tree's top.
    """
    above = None
    for n, runs in reversed(list(enumerate(levels, 1))):
        above = stage(_attach(runs, above, start), f"attached-{n}")
    kept = [c for c in start.columns if c not in ("tree", "path")]
    alone = nodes.where("size = 1").join(start, "tree").select("lo", "digest", "held", "path", *kept)
    if above is None:
        return alone
    with_steps = F.transform(
        "members", lambda m: F.struct(m.alias("member"), _outside(F.col("members"), m["lo"], m["hi"]).alias("step"))
    )
    each = above.select(F.explode(with_steps).alias("one"), "path", *kept)
    member = F.col("one")["member"]
    return alone.unionByName(
        each.select(
            member["lo"].alias("lo"),
            member["digest"].alias("digest"),
            member["held"].alias("held"),
            F.concat(F.array(F.col("one")["step"]), "path").alias("path"),
            *kept,
        )
    )


def proofs(docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, path, folded_root, verified of each row.

    ``path`` has the siblings (left, right) of each level upwards. ``claim`` is the leaf that
    is held against the manifest, null where it is the row's own; ``folded_root`` is what
    comes of it and the path, ``verified`` whether that is the root.
    """
    claim = F.lit(None).cast("string") if claim is None else claim
    nodes = ranked_leaves(docs, claim)
    levels = levels_above(nodes)

    # the tree over the sources: its leaves are the trees' tops, in the same ranks
    n_sources = nodes.agg(F.max("tree")).first()[0]
    subroots = tops(nodes, levels).select(
        F.lit(0).alias("tree"),
        F.col("tree").alias("place"),
        F.lit((n_sources or 0) + 1).cast("long").alias("size"),
        "lo",
        "hi",
        "digest",
        F.struct("tree").alias("held"),
    )
    subroots = stage(subroots, "subroots")
    upper = levels_above(subroots)
    empty_path = F.array().cast("array<struct<left: string, right: string>>")
    root = tops(subroots, upper).select("tree", empty_path.alias("path"), F.col("digest").alias("root"))
    start = siblings(subroots, upper, root).select(
        F.col("held")["tree"].alias("tree"), "path", F.col("digest").alias("subroot"), "root"
    )

    found = siblings(nodes, levels, stage(start, "tree-paths"))
    fold = F.aggregate(
        "path",
        F.coalesce(F.col("held")["claim"], F.col("digest")),
        lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256),
    )
    return found.select(
        F.col("held")["doc_id"].alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        fold.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest() -> Column:
    """The digest of all siblings of ``path``, level by level upwards."""
    return F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
