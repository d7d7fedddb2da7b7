"""Property graphs held in ordinary Spark DataFrames."""

from propgraph.model import End, Nodes, Pool, PropertyGraph, Rels
from propgraph.operators.batching import (
    Batched,
    append_in_batches,
    batch_edges,
    batch_heatmap,
    group_edges,
    ingest_in_batches,
    ingest_serially,
    merge_in_batches,
)
from propgraph.operators.checks import (
    constraint_report,
    key_violations,
    unique_violations,
)
from propgraph.operators.delete import delete_nodes, delete_rels
from propgraph.operators.match import (
    count_nodes,
    count_rels,
    degree_top_k,
    frequent_top_k,
    graph_summary,
    scan_nodes,
    scan_rels,
)
from propgraph.operators.planning import BatchPlan, Hub, plan_batches
from propgraph.operators.shape import copies, extend_keys, head, node_set, rename, row_key
from propgraph.operators.stored import (
    ConstraintError,
    append_stored_nodes,
    append_stored_rels,
    compact,
    declare,
    delete_stored_nodes,
    delete_stored_rels,
    merge_stored_rels,
    upsert_stored_nodes,
    upsert_stored_rels,
)
from propgraph.operators.write import (
    append_nodes,
    append_rels,
    merge_rels,
    upsert_endpoints,
    upsert_nodes,
    upsert_rels,
    with_rel_ids,
)
from propgraph.sources.buckets import Store, create_store, open_store
from propgraph.sources.store import read_graph, write_graph
from propgraph.sources.text import read_edge_list, read_table

__all__ = [
    "BatchPlan",
    "Batched",
    "ConstraintError",
    "End",
    "Hub",
    "Nodes",
    "Pool",
    "PropertyGraph",
    "Rels",
    "Store",
    "append_in_batches",
    "append_nodes",
    "append_rels",
    "append_stored_nodes",
    "append_stored_rels",
    "batch_edges",
    "batch_heatmap",
    "compact",
    "constraint_report",
    "copies",
    "count_nodes",
    "count_rels",
    "create_store",
    "declare",
    "degree_top_k",
    "delete_nodes",
    "delete_rels",
    "delete_stored_nodes",
    "delete_stored_rels",
    "extend_keys",
    "frequent_top_k",
    "graph_summary",
    "group_edges",
    "head",
    "ingest_in_batches",
    "ingest_serially",
    "key_violations",
    "merge_in_batches",
    "merge_rels",
    "merge_stored_rels",
    "node_set",
    "open_store",
    "plan_batches",
    "read_edge_list",
    "read_graph",
    "read_table",
    "rename",
    "row_key",
    "scan_nodes",
    "scan_rels",
    "unique_violations",
    "upsert_endpoints",
    "upsert_nodes",
    "upsert_rels",
    "upsert_stored_nodes",
    "upsert_stored_rels",
    "with_rel_ids",
    "write_graph",
]
