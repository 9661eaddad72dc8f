"""Exact top-k inner products through vector-approximation files.

Vectors are whole numbers. The approximation file keeps one byte per component, the cell of an even grid
between the component's least and greatest value. A query's scan of the approximations gives every vector
an upper and a lower bound of its score from the corners of its cells; each task keeps the vectors whose
upper bound reaches the k-th lower bound it has seen, and the k-th lower bound over all tasks prunes once
more. Then exact vectors are read only for what is left, in the order of upper bounds, until the k-th score
exceeds the next upper bound. Ties go to the smaller id, so equality reads on.

Equal vectors are one row of the file, with the k + 1 smallest of their ids - more of them cannot be among a
query's k - so a vector with very many copies is compared once per query. The ids are ranked with a limit
that Spark applies in every task before the shuffle.

Queries are a stated subset of the rows and are scanned in blocks of about BLOCK, each one pass over the
approximation file; a block's vectors are sent with the job (its size is bounded by BLOCK).

Defined results: vectors that are null or hold null or non-finite components, and ids that are null, take
no part; vectors of unequal lengths score over the components that both have (an empty vector: 0), as if the
shorter one ended in zeros; a query with fewer than k candidates gets all; an id with several vectors is a
candidate with each of them, asks with its smallest one and never finds itself; an empty table gives an empty
table; further columns are ignored. Scores beyond 64 bits are cut to the nearest 64-bit number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rhythmica.session import settled

BLOCK = 1024
CELLS = 256
#: Exact vectors that are read at a time.
READ = 64
#: Components up to this size multiply and add exactly in doubles and 64-bit numbers.
PLAIN = 1 << 20


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """vec_id and v: floor(scale * component), of the rows that take part."""
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL")
    sound = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(sound).select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def bounds(queries: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of the scores, queries by vectors."""
    left = low + cells * step
    right = left + step
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    slack = 1 + 1e-9 * (np.abs(queries) @ np.maximum(np.abs(low), np.abs(low + CELLS * step)))[:, None]
    return up @ right.T + down @ left.T + slack, up @ left.T + down @ right.T - slack


def scan(queries: dict[int, np.ndarray], low: np.ndarray, step: np.ndarray, k: int):
    ids, vectors = np.array(list(queries), np.int64), np.array(list(queries.values()), np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(ids), k), -np.inf)  # the greatest lower bounds so far
        kept: list[tuple] = []
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                own, only = part.column("num").to_numpy(), part.column("only").to_numpy()
                cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(len(own), -1).astype(np.float64)
                upper, lower = bounds(vectors, low, step, cells)
                self_ = (ids[:, None] == only[None, :]) & part.column("single").to_numpy(zero_copy_only=False)[None, :]
                upper[self_] = lower[self_] = -np.inf
                both = np.hstack([best, lower])
                best = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                q, c = np.nonzero((upper >= best.min(axis=1)[:, None]) & ~self_)
                kept.append((q, own[c], upper[q, c], lower[q, c]))
        if kept:
            q, c, upper, lower = (np.concatenate([x[i] for x in kept]) for i in range(4))
            keep = upper >= best.min(axis=1)[q]
            yield pa.RecordBatch.from_arrays([pa.array(ids[q[keep]]), pa.array(c[keep]), pa.array(upper[keep]), pa.array(lower[keep])], ["query_id", "num", "upper", "lower"])

    return run


def exact(query: np.ndarray, vectors: np.ndarray) -> list[int]:
    if max(np.abs(query).max(initial=0), np.abs(vectors).max(initial=0)) <= PLAIN:
        return (vectors @ query).tolist()
    return [min(max(sum(int(a) * int(b) for a, b in zip(query, v, strict=True)), -(2**63)), 2**63 - 1) for v in vectors]


def refine(queries: dict[int, np.ndarray], width: int, k: int):
    """Rows (query_id, ids, upper, v) by query and falling bound: exact scores until the k-th is certain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, []

        def rows():
            ranked = list(enumerate(best, 1))
            return pa.RecordBatch.from_pydict(
                {"query_id": pa.array([now] * len(best), pa.int64()), "rank": pa.array([i for i, _ in ranked], pa.int32()), "vec_id": pa.array([v for _, (_, v) in ranked], pa.int64()), "score": pa.array([-s for _, (s, _) in ranked], pa.int64())}
            )

        for batch in batches:
            query, upper = (batch.column(x).to_numpy() for x in ("query_id", "upper"))
            ids = batch.column("ids").to_pylist()
            vectors = matrix(batch.column("v"), width)
            start = 0
            while start < len(ids):
                if query[start] != now:
                    if best:
                        yield rows()
                    now, best = int(query[start]), []
                end = min(start + READ, int(np.searchsorted(query[start:], now, "right")) + start)
                if len(best) == k and -best[-1][0] > upper[start]:  # certain: skip the rest of the query
                    start = int(np.searchsorted(query[start:], now, "right")) + start
                    continue
                scores = exact(queries[now], vectors[start:end])
                best = sorted({*best, *((-s, i) for s, of in zip(scores, ids[start:end], strict=True) for i in of if i != now)})[:k]
                start = end
        if best:
            yield rows()

    return run


def top_k(table: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Per query and rank (from 1): query_id, rank, vec_id, score. ``is_query``: over ``vec_id``."""
    spark = table.sparkSession
    out = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    rows = settled(whole_vectors(table, id_col, vector_col), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return out
    width = max(width, 1)
    padded = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("v"))))
    ranked = padded.select("v", "vec_id").distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id")))
    distinct = ranked.where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    vectors = settled(distinct.select(F.monotonically_increasing_id().alias("num"), "ids", "v"), "distinct")  # numbered once, as written
    ends = vectors.agg(F.array(*[F.min(F.col("v")[i]) for i in range(width)]), F.array(*[F.max(F.col("v")[i]) for i in range(width)])).first()
    low = np.array(ends[0], np.float64)
    step = np.maximum((np.array(ends[1], np.float64) - low) / CELLS, 1e-9)

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.clip(np.floor((matrix(batch.column("v"), width) - low) / step), 0, CELLS - 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("num", "only", "single")), pa.array([c.tobytes() for c in cells], pa.binary())], ["num", "only", "single", "cells"])

    named = vectors.select("num", F.col("ids")[0].alias("only"), (F.size("ids") == 1).alias("single"), "v")
    file = settled(named.mapInArrow(quantise, "num bigint, only bigint, single boolean, cells binary"), "approximations")
    asked = padded.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = -(-rows.where(is_query).select("vec_id").distinct().count() // block)
    asked = settled(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks)))), "queries")
    for b in range(blocks):
        queries = {r.vec_id: np.array(r.v, np.int64) for r in asked.where(F.col("block") == b).collect()}
        if not queries:
            continue
        found = settled(file.mapInArrow(scan(queries, low, step, k), "query_id bigint, num bigint, upper double, lower double"), "candidates")
        best = found.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("lower"))))
        kth = best.where(F.col("r") <= k).groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("lower")).alias("kth"))
        left = found.join(kth, "query_id").where("kth IS NULL OR upper >= kth").select("query_id", "num", "upper")
        near = left.join(vectors, "num").select("query_id", "ids", "upper", "v")
        near = near.repartition("query_id").sortWithinPartitions("query_id", F.desc("upper"), F.col("ids")[0])
        out = out.union(settled(near.mapInArrow(refine(queries, width, k), "query_id bigint, rank int, vec_id bigint, score bigint"), "top"))
    return out
