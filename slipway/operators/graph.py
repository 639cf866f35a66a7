"""Blocking along the model graph.

A model whose build fails, or one of whose blocking checks fails, stops
everything built from it. Edges are rows (run, node, upstream); the nodes to
skip are those that a failed node reaches.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from graphlib import TopologicalSorter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipway.session import scratch_path

# Statuses that stop dependants; a warning does not.
BLOCKING = ("error", "fail")


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "graph")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def downstream(edges: DataFrame, failed: DataFrame, by: str = "run_id", node: str = "node",
               upstream: str = "upstream") -> DataFrame:
    """(by, node) of all nodes that a failed node reaches over ``edges``.

    A breadth-first closure: each round joins the nodes found last with the
    edges and drops those known before, so a cycle ends it too. Rounds are as
    many as the longest path; each is written to the shared folder, so the
    plan stays small and a lost executor repeats one round. A node with very
    many dependants is one key of the join, whose larger side AQE splits.
    """
    edges = _stored(edges.select(by, node, upstream).where(F.col(upstream).isNotNull()).distinct())
    frontier = _stored(failed.select(by, node).distinct())
    found = None
    while True:
        reached = edges.join(frontier.withColumnRenamed(node, upstream), [by, upstream]).select(by, node).distinct()
        if found is not None:
            reached = reached.join(found, [by, node], "left_anti")
        frontier = _stored(reached)
        if frontier.isEmpty():
            return frontier if found is None else found
        found = frontier if found is None else _stored(found.unionByName(frontier))


def effective_status(nodes: DataFrame, edges: DataFrame, by: str = "run_id", node: str = "node",
                     status: str = "status") -> DataFrame:
    """``nodes`` with ``effective``: ``skipped`` below a failed node, else the node's own status."""
    blocked = downstream(edges, nodes.where(F.col(status).isin(*BLOCKING)), by, node)
    below: Column = F.col("_below")
    return nodes.join(blocked.withColumn("_below", F.lit(True)), [by, node], "left") \
        .withColumn("effective", F.when(below, F.lit("skipped")).otherwise(F.col(status))).drop("_below")


def waves(depends: Mapping[str, Iterable[str]], models: Iterable[str]) -> list[list[str]]:
    """The models of one project in build order: each wave needs only earlier ones.

    Edges to models that are not built in this run are met already. A cycle raises.
    """
    models = list(models)
    unknown = sorted(set(depends) - set(models))
    if unknown:
        raise ValueError(f"dependants that are not built: {unknown}")
    sorter = TopologicalSorter({m: [u for u in depends.get(m, ()) if u in models] for m in models})
    sorter.prepare()
    out = []
    while sorter.is_active():
        ready = sorted(sorter.get_ready(), key=models.index)
        out.append(ready)
        sorter.done(*ready)
    return out
