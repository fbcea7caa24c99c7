"""Graph assembly: referential integrity (J6), MERGE of edges (K4), graph build (K7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketgraph.session import hashed_if_large

# Reject reasons.
MISSING_SRC = "missing_src"
MISSING_DST = "missing_dst"
MISSING_BOTH = "missing_both"


def _node_keys(nodes: DataFrame, node_col: str, as_col: str) -> DataFrame:
    # Node ids are unique in a valid node table; distinct guards against a
    # duplicated node multiplying edges, and leaves the keys hash-partitioned
    # for the join that follows.
    return hashed_if_large(nodes.select(F.col(node_col).alias(as_col)).where(F.col(as_col).isNotNull()).distinct(), nodes)


def valid_edges(
    edges: DataFrame, src_nodes: DataFrame, dst_nodes: DataFrame,
    src_col: str = "src", dst_col: str = "dst", node_col: str = "id",
) -> DataFrame:
    """Edges whose both ends exist: two semi joins, edge columns unchanged."""
    out = edges.join(_node_keys(src_nodes, node_col, src_col), src_col, "left_semi")
    return out.join(_node_keys(dst_nodes, node_col, dst_col), dst_col, "left_semi").select(edges.columns)


def flag_edges(
    edges: DataFrame, src_nodes: DataFrame, dst_nodes: DataFrame,
    src_col: str = "src", dst_col: str = "dst", node_col: str = "id",
) -> DataFrame:
    """Edge columns plus ``reason``: null when both ends exist, else which end is missing."""
    s = _node_keys(src_nodes, node_col, src_col).withColumn("_src_ok", F.lit(True))
    d = _node_keys(dst_nodes, node_col, dst_col).withColumn("_dst_ok", F.lit(True))
    j = edges.join(s, src_col, "left").join(d, dst_col, "left")
    src_ok = F.col("_src_ok").isNotNull()
    dst_ok = F.col("_dst_ok").isNotNull()
    reason = (
        F.when(~src_ok & ~dst_ok, MISSING_BOTH).when(~src_ok, MISSING_SRC).when(~dst_ok, MISSING_DST)
    )
    return j.select(*edges.columns, reason.alias("reason"))


def rejected_edges(
    edges: DataFrame, src_nodes: DataFrame, dst_nodes: DataFrame,
    src_col: str = "src", dst_col: str = "dst", node_col: str = "id",
) -> DataFrame:
    """Edges with a missing end plus ``reason``; with ``valid_edges`` they sum to the input."""
    flagged = flag_edges(edges, src_nodes, dst_nodes, src_col, dst_col, node_col)
    return flagged.where(F.col("reason").isNotNull())


def merge_edges(existing: DataFrame, new: DataFrame, keys: Sequence[str] = ("src", "dst")) -> DataFrame:
    """Insert-if-absent (MERGE): existing edges plus new edges whose key is not present yet.

    New edges are de-duplicated on the key first, so merging a batch twice adds
    nothing the second time.
    """
    keys = list(keys)
    fresh = new.dropDuplicates(keys).join(existing.select(keys), keys, "left_anti")
    return existing.unionByName(fresh.select(existing.columns))


@dataclass(frozen=True)
class EdgeSpec:
    """An edge table and the node tables its ends must exist in."""

    edges: DataFrame
    src_label: str
    dst_label: str


@dataclass(frozen=True)
class Graph:
    nodes: dict[str, DataFrame]
    edges: dict[str, DataFrame]
    flagged: DataFrame  # edge_type, src, dst, reason (null for kept edges)
    by_type: dict[str, DataFrame]  # edge columns and reason, per edge type

    @property
    def rejects(self) -> DataFrame:
        return self.flagged.where(F.col("reason").isNotNull())


def assemble_graph(nodes: Mapping[str, DataFrame], edges: Mapping[str, EdgeSpec]) -> Graph:
    """Typed node and edge tables with dangling edges removed and reported.

    Node tables have an ``id`` column, edge tables ``src`` and ``dst``. The
    result is lazy; write it with ``write_graph`` or the graph file writer.
    """
    by_type = {name: flag_edges(spec.edges, nodes[spec.src_label], nodes[spec.dst_label]) for name, spec in edges.items()}
    kept = {name: by_type[name].where(F.col("reason").isNull()).select(spec.edges.columns) for name, spec in edges.items()}
    parts = [flagged.select(F.lit(name).alias("edge_type"), "src", "dst", "reason") for name, flagged in by_type.items()]
    return Graph(dict(nodes), kept, reduce(DataFrame.unionByName, parts), by_type)


def write_graph(graph: Graph, path: str, mode: str = "overwrite") -> None:
    """Persist every node and edge table and the reject report (one folder per edge type) as parquet under ``path``.

    The joins of an edge type run once: its flagged edges are held while the kept ones and the rejects are written.
    """
    for name, df in graph.nodes.items():
        df.write.mode(mode).parquet(f"{path}/nodes/{name}")
    for name, flagged in graph.by_type.items():
        held = flagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            missing = F.col("reason").isNotNull()
            held.where(~missing).drop("reason").write.mode(mode).parquet(f"{path}/edges/{name}")
            held.where(missing).select("src", "dst", "reason").write.mode(mode).parquet(f"{path}/rejects/edge_type={name}")
        finally:
            held.unpersist()
