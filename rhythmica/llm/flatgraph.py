"""Near-duplicate vectors through a robust-pruned flat graph on overlapping cluster shards.

Vectors of one label are dealt into shards around centroids (k-means on a sample of about SAMPLE vectors
per shard, assigned and summed in tasks that hold slices of it); each goes to its OVERLAP nearest ones. Each shard builds a graph: vectors are inserted in
batches that double, a batch searches the graph so far from the medoid, and its candidates are pruned
robustly (a candidate closer by ALPHA to a chosen neighbour is dropped). The lists of a vector from all its
shards are united. Every vector is then searched for in its shards, on the united lists: greedily from the
medoid, and from everything near the limit on, along the lists in both directions, until no such neighbour is left unread. Links are verified
in double precision. A link that two shards share is counted in the first of them.

Equal vectors of a label are collapsed first, so a group of copies of any size is one node; of a shard's
links only their counts and a spanning forest leave the task. A sample that holds AUDIT vectors with a true link,
or else every vector, is compared with all (the audit); below MEASURED recall, over links or as the mean over those
vectors, all is repeated with twice the overlap and beam, up to ATTEMPTS times.
Where comparing all vectors of each label costs less than that, or ATTEMPTS were not enough, all are compared
(a ball of unequal vectors larger than its shards has links between any two of them), so the result is exact.

Bounds: centroids are at most about 2 * CENTROIDS in all (shards grow beyond that) and travel with the job;
so do the vectors that a pass over all compares, about QUERIES. Comparing all takes one pass per QUERIES vectors.

Defined results: vectors that are null, zero, or hold null or non-finite components, and rows without a
label, have no links and are their own component; vectors of unequal lengths are not linked, each length of a
label is a label of its own; equal rows are copies of each other; a null id has no component; the audited recall is null where
no two unequal vectors are linked; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rhythmica.llm.common import join_one, splitmix
from rhythmica.llm.components import components, stars
from rhythmica.session import settled

LIMIT = 0.93
SHARD, OVERLAP, SAMPLE = 400, 2, 64
CENTROIDS = 65_536
#: First centroids are drawn from so many vectors per shard; steps of k-means.
SEEDS, STEPS = 4, 6
DEGREE, BEAM, ALPHA = 24, 32, 1.2
#: Neighbours this far below the limit are still expanded.
SLACK = 0.06
BATCH = 256
AUDIT, MEASURED, ATTEMPTS = 256, 0.95, 4
#: Vectors that one pass compares with all, and entries of a matrix of similarities.
QUERIES, ENTRIES = 4096, 4_000_000
#: A vector in a shard's graph costs as much as so many plain comparisons or more (estimated).
COMPARISONS = 100_000


class Graph:
    """A shard's vectors (unit length) and padded neighbour lists; number n stands for no neighbour."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, beam: int = BEAM):
        self.x = np.vstack([x, np.zeros((1, x.shape[1]))]).astype(np.float32)
        self.n, self.degree, self.beam = len(x), degree, beam
        self.medoid = int(np.argmax(x @ x.mean(axis=0))) if len(x) else 0
        self.lists = np.full((self.n + 1, degree), self.n, np.int64)

    def greedy(self, queries: np.ndarray) -> np.ndarray:
        """Beam search of a batch: the similarity of every vector that was read, -2 elsewhere."""
        b, n = len(queries), self.n
        queries = queries.astype(np.float32)
        near = np.full((b, n + 1), -2.0, np.float32)
        near[:, self.medoid] = queries @ self.x[self.medoid]
        beam = np.full((b, self.beam), n)
        beam[:, 0] = self.medoid
        done = np.zeros((b, n + 1), bool)
        done[:, n] = True
        rows = np.arange(b)
        while True:
            score = np.where(done[rows[:, None], beam], -3.0, near[rows[:, None], beam])
            pick = score.argmax(axis=1)
            live = np.flatnonzero(score[rows, pick] > -2.5)
            if not len(live):
                return near[:, :n]
            node = beam[live, pick[live]]
            done[live, node] = True
            found = self.lists[node]
            fresh = (near[live[:, None], found] == -2.0) & (found < n)
            found = np.where(fresh, found, n)
            value = np.einsum("brd,bd->br", self.x[found], queries[live])
            near[live[:, None], found] = value
            near[:, n] = -2.0
            both = np.hstack([beam[live], found])
            score = near[live[:, None], both]
            keep = np.argpartition(-score, self.beam - 1, axis=1)[:, : self.beam]
            beam[live] = np.take_along_axis(both, keep, axis=1)

    def within(self, queries: np.ndarray, limit: float) -> np.ndarray:
        """Similarities after the greedy search has been widened through all that is above ``limit``."""
        near = self.greedy(queries)
        queries = queries.astype(np.float32)
        open_ = near >= limit
        done = np.zeros_like(open_)
        while True:
            row, node = np.nonzero(open_ & ~done)
            if not len(row):
                return near
            done[row, node] = True
            sizes = self.ends[node + 1] - self.ends[node]
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.ends[node], sizes)
            place = np.unique(np.repeat(row, sizes) * self.n + self.both_ways[at])
            row, found = place // self.n, place % self.n
            fresh = near[row, found] == -2.0
            row, found = row[fresh], found[fresh]
            for start in range(0, len(row), 100_000):
                part = slice(start, start + 100_000)
                near[row[part], found[part]] = np.einsum("rd,rd->r", self.x[found[part]], queries[row[part]])
            open_ = near >= limit

    def turn(self) -> None:
        """Neighbours in both directions: vectors that no list names are found through those they name."""
        from_, slot = np.nonzero(self.lists[: self.n] < self.n)
        to = self.lists[from_, slot]
        edges = np.unique(np.concatenate([from_ * self.n + to, to * self.n + from_]))
        self.both_ways = edges % max(1, self.n)
        self.ends = np.searchsorted(edges, np.arange(self.n + 1) * self.n)

    def prune(self, node: int, candidates: np.ndarray) -> None:
        """Robust pruning: the nearest stays, and drops what is closer to it than to the node by ALPHA."""
        candidates = np.unique(candidates)
        candidates = candidates[(candidates != node) & (candidates < self.n)]
        x = self.x[candidates]
        own = 1 - x @ self.x[node]
        order = np.argsort(own, kind="stable")
        candidates, own, between = candidates[order], own[order], 1 - x[order] @ x[order].T
        alive, chosen = np.ones(len(candidates), bool), []
        while len(chosen) < self.degree and alive.any():
            c = int(alive.argmax())
            chosen.append(candidates[c])
            alive &= ALPHA * between[c] > own
            alive[c] = False
        self.lists[node] = self.n
        self.lists[node, : len(chosen)] = chosen

    def build(self, seed: np.ndarray) -> None:
        order = np.argsort(splitmix(seed), kind="stable")
        order = np.concatenate([[self.medoid], order[order != self.medoid]]) if self.n else order
        start, size = min(1, self.n), 1
        while start < self.n:
            batch = order[start : start + size]
            near = self.greedy(self.x[batch])
            peers = self.x[batch] @ self.x[batch].T
            np.fill_diagonal(peers, -2)
            back: dict[int, list[int]] = {}
            for i, node in enumerate(batch):
                read = np.flatnonzero(near[i] > -2)
                if len(read) > 2 * self.beam:
                    read = read[np.argpartition(-near[i, read], 2 * self.beam)[: 2 * self.beam]]
                close = batch[np.argsort(-peers[i])[: min(8, len(batch) - 1)]]
                self.prune(int(node), np.concatenate([read, close]))
                for c in self.lists[node]:
                    if c < self.n:
                        back.setdefault(int(c), []).append(int(node))
            for node, more in back.items():
                own = self.lists[node][self.lists[node] < self.n]
                own = np.unique(np.concatenate([own, more]))
                if len(own) <= self.degree:
                    self.lists[node] = self.n
                    self.lists[node, : len(own)] = own
                else:
                    self.prune(node, own)
            start, size = start + len(batch), min(BATCH, 2 * size)


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1)


def comparable(table: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """All rows as vec_id, label, v and whether they can link with anything (sound)."""
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite
    return rows.withColumn("sound", F.coalesce(sound, F.lit(False)))


def sound_vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    return comparable(table, id_col, vector_col, label_col).where("sound").drop("sound")


def _nearest(x: np.ndarray, centre: np.ndarray, most: int) -> np.ndarray:
    """Per row of ``x`` its ``most`` most similar centroids, the best first, in slices of about ENTRIES similarities."""
    out, step = [], max(1, ENTRIES // len(centre))
    for start in range(0, len(x), step):
        near = -(x[start : start + step] @ centre.T)
        if most < len(centre):
            some = np.sort(np.argpartition(near, most - 1, axis=1)[:, :most], axis=1)
        else:
            some = np.tile(np.arange(len(centre)), (len(near), 1))
        out.append(np.take_along_axis(some, np.argsort(np.take_along_axis(near, some, axis=1), axis=1, kind="stable"), axis=1))
    return np.concatenate(out) if out else np.zeros((0, min(most, len(centre))), np.int64)


def _assigned(tables: dict[str, np.ndarray]):
    """Per task, label and shard: the sum of the unit vectors that are nearest to it."""

    def run(batches):
        sums = {label: np.zeros_like(c) for label, c in tables.items()}
        met = {label: np.zeros(len(c), bool) for label, c in tables.items()}
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), object)
            for label in set(labels) & tables.keys():
                x = _unit(_vectors(batch.column("v").take(pa.array(np.flatnonzero(labels == label)))))
                near = _nearest(x, tables[label], 1)[:, 0]
                np.add.at(sums[label], near, x)
                met[label][near] = True
        for label in tables:
            shards = np.flatnonzero(met[label])
            for start in range(0, len(shards), 1000):
                part = shards[start : start + 1000]
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(part)), pa.array(part, pa.int64()), pa.array(list(sums[label][part]), pa.list_(pa.float64()))], ["label", "shard", "c"])

    return run


def _summed(table: pa.Table) -> pa.Table:
    """The tasks' sums of one label and shard as its new centroid."""
    c = _unit(_vectors(table["c"]).sum(axis=0)[None])[0]
    return pa.table({"label": table["label"].slice(0, 1), "shard": table["shard"].slice(0, 1), "c": pa.array([c.tolist()], pa.list_(pa.float64()))})


def centroids(nodes: DataFrame, target: int) -> dict[str, np.ndarray]:
    """k-means of each label that has more than ``target`` vectors; tasks hold slices of the sample, only centroids come to the driver."""
    sizes = nodes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / target).cast("int").alias("k")).where("k > 1")
    part = F.pmod(F.xxhash64("node"), F.lit(target))
    sampled = settled(nodes.where(part < SAMPLE).join(F.broadcast(sizes), "label").select("label", "v", "k", "node", part.alias("part")), "sample")  # at most total / target labels have k > 1
    drawn: dict[str, list] = {}
    for r in sorted(sampled.where(F.col("part") < SEEDS).collect(), key=lambda r: (r.label, r.part, r.node)):
        if len(drawn.setdefault(r.label, [])) < r.k:
            drawn[r.label].append(r.v)
    tables = {label: _unit(np.array(v)) for label, v in drawn.items()}
    for _ in range(STEPS if tables else 0):
        sums = sampled.select("label", "v").mapInArrow(_assigned(tables), "label string, shard bigint, c array<double>")
        for r in sums.groupBy("label", "shard").applyInArrow(_summed, "label string, shard bigint, c array<double>").collect():
            tables[r.label][r.shard] = r.c
    return tables


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def in_shards(nodes: DataFrame, shard: int, overlap: int) -> DataFrame:
    """nodes (label, v, node, n) with their shards, nearest first."""
    total = nodes.count()
    target = max(shard, -(-total // CENTROIDS))
    tables = centroids(nodes, target)

    def run(batches):
        for batch in batches:
            shards: list = [[0]] * batch.num_rows
            labels = np.array(batch.column("label").to_pylist(), object)
            for label in set(labels) & tables.keys():
                rows = np.flatnonzero(labels == label)
                near = _nearest(_unit(_vectors(batch.column("v").take(pa.array(rows)))), tables[label], overlap)
                for i, s in zip(rows, near.tolist(), strict=True):
                    shards[i] = s
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "v", "node", "n")), pa.array(shards, pa.list_(pa.int64()))], ["label", "v", "node", "n", "shards"])

    return nodes.select("label", "v", "node", "n").mapInArrow(run, "label string, v array<double>, node bigint, n bigint, shards array<bigint>")


def _built(table: pa.Table) -> pa.Table:
    ids = np.asarray(table["node"])
    graph = Graph(_unit(_vectors(table["v"])))
    graph.build(ids.astype(np.uint64))
    rows = [ids[a[a < graph.n]].tolist() for a in graph.lists[: graph.n]]
    return pa.table({"node": pa.array(ids, pa.int64()), "near": pa.array(rows, pa.list_(pa.int64()))})


def _searched(limit: float, beam: int):
    """Per shard: each node's linked vectors outside shared earlier shards (to, null), and a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        ids, weight, shard = np.asarray(table["node"]), np.asarray(table["n"]), table["shard"][0].as_py()
        x = _unit(_vectors(table["v"]))
        place = {int(i): k for k, i in enumerate(ids)}
        lists = [[place[j] for j in near if j in place] for near in table["near"].to_pylist()]
        graph = Graph(x, max([1, *map(len, lists)]), beam)
        for i, near in enumerate(lists):
            graph.lists[i, : len(near)] = near
        graph.turn()
        first: dict[int, int] = {}
        shards = table["shards"].to_pylist()
        code = [tuple(sorted(s)) for s in shards]
        kinds = {c: first.setdefault(c, len(first)) for c in code}
        own = np.array([kinds[c] for c in code])
        meets = np.array([[min(set(a) & set(b)) == shard for b in first] for a in first])  # whether two kinds meet here first
        pairs = []
        for start in range(0, len(x), BATCH):
            near = graph.within(x[start : start + BATCH], limit - SLACK)
            row, col = np.nonzero(near >= limit - 1e-3)
            row = row + start
            true = np.array([], bool) if not len(row) else np.einsum("rd,rd->r", x[row], x[col]) >= limit
            low, high = np.minimum(row, col)[true], np.maximum(row, col)[true]
            pairs.append(np.unique((low * len(x) + high)[low != high]))
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        a, b = pairs // max(1, len(x)), pairs % max(1, len(x))
        here = meets[own[a], own[b]] if len(a) else np.zeros(0, bool)
        links = np.bincount(a[here], weight[b[here]], len(x)) + np.bincount(b[here], weight[a[here]], len(x))
        top = np.arange(len(x))
        while True:  # smallest reachable number: its edges are a forest of stars
            low = np.minimum(top[a], top[b])
            new = top.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == top).all():
                break
            top = new
        return pa.table({"node": pa.array(ids, pa.int64()), "links": pa.array(links.astype(np.int64)), "joined": pa.array(ids[top], pa.int64())})

    return run


def _forest(mask: np.ndarray, rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the pairs of ``mask`` (rows by queries) connect: from each node to its smallest."""
    ids = np.unique(np.concatenate([rows, queries]))
    row, col, top = np.searchsorted(ids, rows), np.searchsorted(ids, queries), np.arange(len(ids))
    while True:
        rest = mask & (top[row][:, None] != top[col][None, :])
        r, c = np.flatnonzero(rest.any(axis=1)), np.flatnonzero(rest.any(axis=0))
        if not len(r):
            below = top != np.arange(len(ids))
            return ids[below], ids[top[below]]
        below = np.flatnonzero(top != np.arange(len(ids)))
        a = np.concatenate([below, row[r], row[rest[:, c].argmax(axis=0)]])
        b = np.concatenate([top[below], col[rest[r].argmax(axis=1)], col[c]])
        node, least = stars(a, b)
        top[node] = least


def _compared(queries: list, limit: float, forest: bool):
    """Per query: how many vectors of its label it is linked to in this task; with ``forest`` also a spanning forest of the links."""
    by_label: dict[str, list] = {}
    for r in queries:
        by_label.setdefault(r.label, []).append(r)
    asked = {label: (np.array([r.node for r in rows], np.int64), _unit(np.array([r.v for r in rows]))) for label, rows in by_label.items()}

    def run(batches):
        counts = {label: np.zeros(len(ids), np.int64) for label, (ids, _) in asked.items()}
        u = v = np.zeros(0, np.int64)
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), object)
            for label in set(labels) & asked.keys():
                ids, q = asked[label]
                every, step = np.flatnonzero(labels == label), max(1, ENTRIES // len(ids))
                for start in range(0, len(every), step):
                    rows = every[start : start + step]
                    part = batch.take(pa.array(rows))
                    own, n, x = np.asarray(part.column("node")), np.asarray(part.column("n")), _unit(_vectors(part.column("v")))
                    near = x.astype(np.float32) @ q.T.astype(np.float32)
                    mask = near >= limit + 1e-4
                    r, c = np.nonzero(np.abs(near - limit) < 1e-4)  # too close for single precision
                    for k in range(0, len(r), 100_000):
                        a, b = r[k : k + 100_000], c[k : k + 100_000]
                        mask[a, b] = np.einsum("rd,rd->r", x[a], q[b]) >= limit
                    mask &= own[:, None] != ids[None, :]
                    for c in range(0, len(ids), 512):
                        counts[label][c : c + 512] += n @ mask[:, c : c + 512]
                    if forest and mask.any():
                        some, asks = mask.any(axis=1), mask.any(axis=0)
                        a, b = _forest(mask[some][:, asks], own[some], ids[asks])
                        u, v = np.concatenate([u, a]), np.concatenate([v, b])
                        if len(u) > ENTRIES:
                            u, v = stars(u, v)
        ids = np.concatenate([asked[label][0] for label in asked])
        u, v = stars(u, v)
        parts = (np.concatenate([ids, u]), np.concatenate([*(counts[label] for label in asked), np.zeros(len(u), np.int64)]), np.concatenate([ids, v]))
        for start in range(0, len(parts[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[start : start + 100_000]) for x in parts], ["node", "links", "joined"])

    return run


def compared(nodes: DataFrame, limit: float, blocks: int, wanted: range, forest: bool = True) -> DataFrame:
    """The nodes of the ``wanted`` of ``blocks`` blocks against all of their label: node, links, joined, as of ``_searched``."""
    out = None
    for block in wanted:
        queries = nodes.where(F.pmod(F.xxhash64("node"), F.lit(blocks)) == block).select("label", "v", "node").collect()
        if queries:
            now = settled(nodes.select("label", "v", "node", "n").mapInArrow(_compared(queries, limit, forest), "node bigint, links bigint, joined bigint"), "compared")
            out = now if out is None else out.union(now)
    return nodes.sparkSession.createDataFrame([], "node bigint, links bigint, joined bigint") if out is None else out


def audit(nodes: DataFrame, links: DataFrame, limit: float, total: int) -> float | None:
    """Recall of ``links`` (node, links): over all true links of a sample, or as the mean of its linked nodes if that is less.

    The sample is a hundredth of the nodes or a block of QUERIES, and doubles until AUDIT of its nodes have a
    true link or all nodes are in it. None: no two vectors are linked.
    """
    blocks = -(-total // QUERIES)
    start, size, sums = 0, -(-blocks // 100), np.zeros(4)
    while start < blocks and sums[0] < AUDIT:
        wanted = range(start, min(blocks, start + size))
        true = compared(nodes, limit, blocks, wanted, forest=False).groupBy("node").agg(F.sum("links").alias("true")).where(F.col("true") > 0)
        hit = F.least("true", F.coalesce("links", F.lit(0)))
        found = true.join(links, "node", "left").agg(F.count(F.lit(1)), F.sum(hit / F.col("true")), F.sum("true"), F.sum(hit)).first()
        sums += [x or 0 for x in found]
        start, size = wanted.stop, wanted.stop
    return min(sums[1] / sums[0], sums[3] / sums[2]) if sums[0] else None


def near_vectors(table: DataFrame, limit: float = LIMIT, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept, and the audited recall."""
    sound = sound_vectors(table, id_col, vector_col, label_col)
    rows = settled(sound.withColumn("label", F.concat_ws(":", F.size("v").cast("string"), "label")), "vectors")
    # an id can have several vectors, so nodes are numbered; the numbers hold once they are written
    named = settled(rows.groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    nodes = named.select("label", "v", "node", "n")
    sizes = nodes.groupBy("label").count().agg(F.sum("count").alias("n"), F.sum(F.col("count").cast("double") ** 2).alias("pairs")).first()
    overlap, beam = OVERLAP, BEAM
    for attempt in range(ATTEMPTS):
        dealt = settled(in_shards(nodes, SHARD, overlap).withColumn("shard", F.explode("shards")), "shards")
        lists = dealt.groupBy("label", "shard").applyInArrow(_built, "node bigint, near array<bigint>")
        united = settled(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "lists")
        ready = dealt.join(united, "node")
        found = settled(ready.groupBy("label", "shard").applyInArrow(_searched(limit, beam), "node bigint, links bigint, joined bigint"), "found")
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        recall = audit(nodes, links, limit, sizes.n or 0)
        if recall is None or recall >= MEASURED:
            break
        overlap, beam = 2 * overlap, 2 * beam
        if attempt + 1 == ATTEMPTS or sizes.pairs <= COMPARISONS * overlap * sizes.n:
            blocks = -(-sizes.n // QUERIES)
            found, recall = compared(nodes, limit, blocks, range(blocks)), 1.0
            links = found.groupBy("node").agg(F.sum("links").alias("links"))
            break
    classes = components(found.where("node <> joined"), "node", "joined")
    of_node = settled(named.join(links, "node").join(classes, "node", "left").withColumn("component", F.coalesce("component", "node")), "of-node")
    smallest = of_node.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = join_one(of_node, smallest, "component", F.xxhash64("node")).select("label", "v", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    # copies meet their node: a common vector may hold much of the table
    key = F.xxhash64("label", "v").alias("key")
    wanted = settled(rows.select("vec_id", "label", "v", key), "rows")
    met = join_one(wanted, of_node.select(key, F.col("label").alias("l"), F.col("v").alias("w"), "n_links", "component_id"), "key", F.xxhash64("vec_id")).where("label = l AND v = w")
    # row by row, as an id can occur more than once: each sound row met its own vector, the others link with nothing
    rest = comparable(table, id_col, vector_col, label_col).where("NOT sound").select("vec_id", F.lit(0).alias("n_links"), F.col("vec_id").alias("component_id"))
    out = met.select("vec_id", F.col("n_links").cast("bigint").alias("n_links"), "component_id").unionByName(rest)
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id")).withColumn("audited_recall", F.lit(recall).cast("double"))
