"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Between steps each task replaces the edges it holds by a spanning forest of stars, which joins the same
nodes with fewer and shorter paths, so that few steps are needed. A node leaves with an edge for each task that holds
one of its edges, so the edges are gathered into as few tasks as CHUNK edges a task allow before they are contracted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rhythmica.llm.common import HOT_KEYS, HOT_ROWS, join_one
from rhythmica.session import settled


#: A task contracts at most so many edges at a time.
CHUNK = 1_000_000


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges that is not the smallest it can reach, with that smallest one."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    top = np.arange(len(nodes))
    while True:
        low, new = np.minimum(top[a], top[b]), top.copy()
        np.minimum.at(new, top[a], low)
        np.minimum.at(new, top[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == top).all():
            break
        top = new
    below = top != np.arange(len(nodes))
    return nodes[below], nodes[top[below]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def edges(u, v):
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    u = v = np.zeros(0, np.int64)
    for batch in batches:
        u, v = (np.concatenate([x, batch.column(c).to_numpy(zero_copy_only=False)]) for x, c in ((u, "u"), (v, "v")))
        if len(u) >= CHUNK:
            u, v = stars(u, v)
            if len(u) >= CHUNK // 2:
                yield edges(u, v)
                u = v = np.zeros(0, np.int64)
    if len(u):
        yield edges(*stars(u, v))


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) that connect what these connect: a forest of stars for each task."""
    return edges.select(F.col("u").cast("bigint"), F.col("v").cast("bigint")).mapInArrow(_contracted, "u bigint, v bigint")


def gathered(edges: DataFrame) -> DataFrame:
    """Contract stored edges in tasks of about CHUNK edges, again and again as long as that halves them."""
    n = edges.count()
    while n:
        tasks = -(-n // CHUNK)
        if tasks >= edges.rdd.getNumPartitions():
            return edges
        edges = settled(contracted(edges.coalesce(tasks)), "edges")
        before, n = n, edges.count()
        if tasks == 1 or 2 * n > before:
            return edges
    return edges


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Per node that has an edge to another node: node, component (its smallest node).

    Loops and repeated edges are harmless; edges with a null end are ignored; no edges give no rows. A
    node may hold any share of the edges: its rows are salted. Each step is written to the shared folder.
    """
    rows = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    rows = gathered(settled(contracted(rows), "edges"))
    while True:
        both = rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = settled(both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most"), F.count(F.lit(1)).alias("n")), "ends")
        # in a star, a node with a smaller neighbour has no other one
        if ends.where("m < u AND most <> m").isEmpty():
            return ends.select(F.col("u").alias("node"), F.least("u", "m").alias("component"))
        least = ends.select("u", F.least("u", "m").alias("m"))
        hot = ends.where(F.col("n") > HOT_ROWS).orderBy(F.desc("n"), "u").limit(HOT_KEYS).select(F.col("u").alias("_hot"))
        large = join_one(both.where("v > u"), least, "u", F.xxhash64("v"), hot=hot).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = settled(contracted(large), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        rows = gathered(settled(contracted(small.where("u <> v").distinct()), "edges"))
