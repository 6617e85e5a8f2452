"""Connected components of an edge table, by large-star and small-star steps in turn."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.scratch import files, stage

#: Edges that a task shortens at once.
PIECE = 1 << 18


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node of its component) for every node of edges(a, b).

    Each round moves an edge to the smallest neighbour its smaller node has, then
    all edges of a node to the smallest of them: one join with the table of nodes
    and one window. Tasks shorten the edges they have at hand to trees of depth
    one before they write them, so a node has at most one edge to a smaller node
    in each task's piece. The table of nodes (minima with map-side combine) tells
    when only stars are left and is the answer then, so no round is spent on
    seeing that nothing changes. No component is ever gathered in one task. Loops
    and repeated edges do no harm; nodes that only occur in a loop have no row.
    """
    links = stage(_shortened(edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v"))), "components")
    rows = links.count()  # no round adds edges
    while True:
        nodes = stage(_nodes(links), "components-nodes", 2 * rows)
        if not nodes.where("least <> most or (below and least is not null)").limit(1).count():
            return nodes.select("node", F.coalesce("least", "node").alias("component"))
        lower = nodes.where("least is not null").select(F.col("node").alias("v"), "least")
        large = links.join(lower, "v", "left").select("u", F.coalesce("least", "v").alias("v"))
        large = large.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        moved = large.select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        links = stage(_shortened(moved.coalesce(files(links.sparkSession, rows))), "components")


def smallest_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n items the smallest one that the pairs (a, b) connect it with."""
    label = np.arange(n)
    while len(a):
        # What both ends of a pair point at is joined, then all point at the end of their chain.
        np.minimum.at(label, label[a], label[b])
        np.minimum.at(label, label[b], label[a])
        while ((above := label[label]) != label).any():
            label = above
        open_ones = label[a] != label[b]
        a, b = a[open_ones], b[open_ones]
    return label


def _nodes(links: DataFrame) -> DataFrame:
    """node, least and most (of its smaller neighbours; null: none), below (it has larger ones). links: u, v, where u > v."""
    nothing = F.lit(None).cast("long")
    ends = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("to")), F.struct(F.col("v").alias("node"), nothing.alias("to")))
    ends = links.select(F.explode(ends).alias("e")).select("e.node", "e.to")
    return ends.groupBy("node").agg(F.min("to").alias("least"), F.max("to").alias("most"), F.max(F.col("to").isNull()).alias("below"))


def _shortened(pairs: DataFrame) -> DataFrame:
    """The edges at hand as stars around the smallest node of what they connect, the larger node first, without loops."""

    def shorten(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= PIECE:
                yield _stars(held)
                held, n = [], 0
        if n:
            yield _stars(held)

    return pairs.mapInArrow(shorten, "u long, v long")


def _stars(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    u, v = (np.concatenate([np.asarray(batch.column(n)) for batch in batches]) for n in ("u", "v"))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    label = smallest_reached(len(nodes), at[: len(u)], at[len(u) :])
    apart = label != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[apart]), pa.array(nodes[label[apart]])], ["u", "v"])
