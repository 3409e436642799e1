"""Connected components as joins and aggregations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.plans.shared import materialize

#: Graphs of up to so many edges (16 MB) are solved in one task.
SMALL = 1 << 20


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) for every node of the edges that isn't the smallest of its component."""
    node, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    up = np.arange(len(node))
    while True:
        low = np.minimum(up[a], up[b])
        new = up.copy()
        np.minimum.at(new, up[a], low)
        np.minimum.at(new, up[b], low)
        new = new[new]
        if (new == up).all():
            break
        up = new
    own = np.flatnonzero(up != np.arange(len(node)))
    return node[own], node[up[own]]


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's edges as stars of its own components, in steps of bounded size."""
    u = v = np.zeros(0, np.int64)
    for b in batches:
        u, v = (np.concatenate([x, b.column(i).to_numpy()]) for i, x in enumerate((u, v)))
        if len(u) > SMALL:
            u, v = stars(u, v)
            if len(u) > SMALL // 2:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
                u = v = np.zeros(0, np.int64)
    u, v = stars(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", small: int = SMALL, max_rounds: int = 100) -> DataFrame:
    """Smallest reachable node for every node of an edge list of integers: columns node, component.

    Every partition first contracts its own edges to stars. If at most `small` edges are left, one task finishes them.
    Otherwise large-star and small-star steps alternate, each a groupBy-min with map-side combine and one join, until the
    edge set no longer changes. A hub keeps one edge per neighbour, so no step makes more rows than there are edges;
    skewed hubs are split by the adaptive join. Every step is written to the shared folder, which bounds the lineage. A
    graph that isn't done after max_rounds (rounds grow with the logarithm of its diameter) raises RuntimeError.
    """
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    e = materialize(e.mapInArrow(contract, "u long, v long"), "cc")
    n = e.count()
    if n <= small:
        nodes = e.coalesce(1).mapInArrow(contract, "u long, v long").toDF("node", "component")
        nodes = materialize(nodes, "cc")
        return nodes.union(nodes.select("component", "component").distinct())
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of u is linked to u's smallest neighbour (or u)
        both = e.union(e.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: every smaller neighbour of u, and u, is linked to the smallest of them
        low = large.where("u <> v").distinct()
        m = low.groupBy("u").agg(F.min("v").alias("m"))
        step = low.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v")))
        e = materialize(step.where("u <> v").distinct(), "cc")
        # the edge set as a count and two hashes of it; ids themselves may be too large to sum
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == before:
            nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.union(e.select("v", "v").distinct())
        before = now
    raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
