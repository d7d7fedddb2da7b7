"""A graph at rest: Parquet folders, nodes by label and relationships by type."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from propgraph.model import End, Nodes, Pool, PropertyGraph, Rels


def _pools(graph: PropertyGraph) -> dict[int, tuple[str, list[str]]]:
    """Pools with a folder name and the types in each."""
    found: dict[int, list[str]] = {}
    for name, rels in graph.rels.items():
        if rels.pool is not None:
            found.setdefault(id(rels.pool), []).append(name)
    return {key: ("+".join(types), types) for key, types in found.items()}


def write_graph(graph: PropertyGraph, path: str) -> None:
    """Write all frames and what tells them apart below ``path``, which must be new. Pools are partitioned by type."""
    for label, nodes in graph.nodes.items():
        nodes.df.write.parquet(f"{path}/nodes/{label}")
    for name, rels in graph.rels.items():
        if rels.pool is None:
            rels.df.write.parquet(f"{path}/rels/{name}")
    for folder, types in _pools(graph).values():
        pool = graph.rels[types[0]].pool
        kept = pool.df.where(pool.df[pool.type_col].isin(types))
        kept.write.partitionBy(pool.type_col).parquet(f"{path}/rels/{folder}")
    # last, so a graph that was not written to its end cannot be opened
    spark = next(iter([*graph.nodes.values(), *graph.rels.values()])).df.sparkSession
    spark.createDataFrame([(_describe(graph),)], "value string").coalesce(1).write.text(f"{path}/about")


def _describe(graph: PropertyGraph) -> str:
    """Keys, ends, identities, pools and schemas as JSON."""
    folders = {t: folder for folder, types in _pools(graph).values() for t in types}

    def end(e: End) -> dict:
        return {"label": e.label, "cols": dict(e.cols)}

    return json.dumps(
        {
            "nodes": {n: {"keys": nodes.keys, "schema": nodes.df.schema.jsonValue()} for n, nodes in graph.nodes.items()},
            "rels": {
                n: {
                    "source": end(r.source),
                    "target": end(r.target),
                    "identity": r.identity,
                    "schema": r.df.schema.jsonValue(),
                    "pool": folders.get(n),
                }
                for n, r in graph.rels.items()
            },
            "pools": {
                folder: {"type_col": pool.type_col, "schema": pool.df.schema.jsonValue()}
                for folder, types in _pools(graph).values()
                for pool in [graph.rels[types[0]].pool]
            },
        }
    )


def read_graph(spark: SparkSession, path: str) -> PropertyGraph:
    """The graph that ``write_graph`` wrote below ``path``, from what it says about itself."""
    about = json.loads(spark.read.text(f"{path}/about").first()[0])

    def load(folder: str, schema: dict) -> DataFrame:
        kind = StructType.fromJson(schema)
        return spark.read.schema(kind).parquet(f"{path}/{folder}").select(*kind.names)

    nodes = {n: Nodes(load(f"nodes/{n}", d["schema"]), tuple(d["keys"])) for n, d in about["nodes"].items()}
    pools = {f: Pool(load(f"rels/{f}", d["schema"]), d["type_col"]) for f, d in about["pools"].items()}
    rels = {}
    for name, d in about["rels"].items():
        pool = pools.get(d["pool"])
        if pool is None:
            df = load(f"rels/{name}", d["schema"])
        else:
            # one type alone reads only its own partition folder
            columns = StructType.fromJson(d["schema"]).names
            df = pool.df.where(pool.df[pool.type_col] == name).select(*columns)
        ends = (End(d[side]["label"], d[side]["cols"]) for side in ("source", "target"))
        rels[name] = Rels(df, *ends, tuple(d["identity"]), pool)
    return PropertyGraph(nodes, rels)
