"""Approximate nearest neighbours by a robust-pruned directed graph in each shard of the vectors.

A shard's graph is built in its task: a greedy beam search proposes
neighbours for each vector; pruning keeps an edge unless a kept neighbour is
nearer to the candidate by the factor ``alpha``, so long edges survive; reverse
edges are added and pruned alike. Queries then search every shard by beam
search, in blocks, and the shards' nearest are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from policylens.llm.text import Scratch


@dataclass(frozen=True)
class Graph:
    """shard: vectors of one graph. degree: edges of a vector. beam: candidates kept by a search.
    alpha: pruning's relaxation of distances. block: queries of one search task. k: neighbours wanted."""

    shard: int = 4096
    degree: int = 32
    beam: int = 64
    alpha: float = 1.2
    block: int = 2048
    k: int = 10
    batch: int = 512


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between a (q x d) and b (q x c x d)."""
    diff = b - a[:, None, :]
    return np.einsum("qcd,qcd->qc", diff, diff)


def beam_search(data: np.ndarray, edges: np.ndarray, entry: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of all queries together: the ``beam`` nearest vectors met (ids, squared distances), -1 where fewer.

    Each step expands every query's nearest candidate not expanded yet, until none is left in its beam.
    """
    q, n = len(queries), len(data)
    ids = np.full((q, beam), -1, np.int64)
    dist = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), bool)
    seen = np.zeros((q, n), bool)
    start = entry[:beam]
    ids[:, :len(start)] = start
    dist[:, :len(start)] = squared(queries, np.broadcast_to(data[start], (q, *data[start].shape)))
    done[:, :len(start)] = False
    seen[:, start] = True
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist, done = (np.take_along_axis(x, order, 1) for x in (ids, dist, done))
    live = np.arange(q)
    while len(live):
        open_ = ~done[live]
        has = open_.any(1)
        live, open_ = live[has], open_[has]
        if not len(live):
            break
        at = open_.argmax(1)
        node = ids[live, at]
        done[live, at] = True
        near = edges[node]
        ok = near >= 0
        near = np.where(ok, near, 0)
        ok &= ~seen[live[:, None], near]
        seen[live[:, None], near] |= ok
        gap = np.where(ok, squared(queries[live], data[near]), np.inf).astype(np.float32)
        all_ids = np.concatenate([ids[live], np.where(ok, near, -1)], 1)
        all_dist = np.concatenate([dist[live], gap], 1)
        all_done = np.concatenate([done[live], ~ok], 1)
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[live], dist[live], done[live] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_dist, all_done))
    return ids, dist


def robust_prune(data: np.ndarray, nodes: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node, at most ``degree`` of its candidates (-1: none): the nearest is kept, and candidates are dropped that a kept
    one is nearer to, by the factor alpha, than the node is; again with the next."""
    order = np.sort(cand, 1)
    repeat = np.zeros(cand.shape, bool)
    repeat[:, 1:] = order[:, 1:] == order[:, :-1]
    cand = np.where(repeat, -1, order)
    vectors = data[np.maximum(cand, 0)]
    gap = squared(data[nodes], vectors)
    gap[(cand < 0) | (cand == nodes[:, None])] = np.inf
    order = np.argsort(gap, axis=1, kind="stable")[:, :4 * degree]
    cand, gap = np.take_along_axis(cand, order, 1), np.take_along_axis(gap, order, 1)
    vectors = data[np.maximum(cand, 0)]
    out = np.full((len(nodes), degree), -1, np.int64)
    alive, rows = np.isfinite(gap), np.arange(len(nodes))
    for k in range(degree):
        has = alive.any(1)
        if not has.any():
            break
        at = alive.argmax(1)
        out[has, k] = cand[rows, at][has]
        between = squared(vectors[rows, at], vectors)
        alive &= ~((alpha * alpha * between <= gap) & has[:, None])
        alive[rows, at] = False
    return out


def build(data: np.ndarray, g: Graph) -> tuple[np.ndarray, np.ndarray]:
    """(edges, entry points) of the graph over distinct vectors."""
    n = len(data)
    rng = np.random.default_rng(n)
    middle = int(np.argmin(((data - data.mean(0)) ** 2).sum(1)))
    entry = np.unique(np.append(rng.choice(n, min(n, 8), replace=False), middle))
    edges = np.full((n, g.degree), -1, np.int64)
    half = min(g.degree // 2, max(n - 1, 0))
    if half:
        edges[:, :half] = (np.arange(n)[:, None] + rng.integers(1, n, (n, half))) % n
    order = rng.permutation(n)
    for at in range(0, n, g.batch):
        nodes = order[at:at + g.batch]
        found, _ = beam_search(data, edges, entry, data[nodes], g.beam)
        edges[nodes] = robust_prune(data, nodes, np.concatenate([found, edges[nodes]], 1), g.degree, g.alpha)
        _add_reverse(data, edges, nodes, g)
    _join_up(data, edges, entry)
    return edges, entry


def _add_reverse(data: np.ndarray, edges: np.ndarray, nodes: np.ndarray, g: Graph) -> None:
    to = edges[nodes].ravel()
    source = np.repeat(nodes, g.degree)[to >= 0]
    to = to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    target, first, count = np.unique(to, return_index=True, return_counts=True)
    for a in range(0, len(target), g.batch):
        t, f, c = target[a:a + g.batch], first[a:a + g.batch], count[a:a + g.batch]
        wide = int(c.max())
        extra = np.full((len(t), wide), -1, np.int64)
        for k in range(wide):
            has = c > k
            extra[has, k] = source[f[has] + k]
        edges[t] = robust_prune(data, t, np.concatenate([edges[t], extra], 1), g.degree, g.alpha)


def _join_up(data: np.ndarray, edges: np.ndarray, entry: np.ndarray) -> None:
    """Make every vector reachable from the entry points: an unreachable one takes the last edge of a near reachable one."""
    n = len(data)
    reached = np.zeros(n, bool)
    fixed = np.zeros(n, bool)

    def spread(front: np.ndarray) -> None:
        reached[front] = True
        while len(front):
            front = np.unique(edges[front])
            front = front[(front >= 0)]
            front = front[~reached[front]]
            reached[front] = True

    spread(entry)
    while not reached.all():
        lost = int(np.flatnonzero(~reached)[0])
        free = np.flatnonzero(reached & ~fixed)
        host = int(free[np.argmin(((data[free] - data[lost]) ** 2).sum(1))])
        empty = np.flatnonzero(edges[host] < 0)
        if len(empty):
            edges[host, empty[0]] = lost
        else:
            edges[host, -1] = lost
            fixed[host] = True
        spread(np.array([lost]))


def _distinct(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row of each distinct vector, and each row's number among the distinct ones."""
    plain = np.ascontiguousarray(vectors + np.float32(0))
    _, first, inverse = np.unique(plain.view([("", plain.dtype)] * plain.shape[1]).ravel(), return_index=True, return_inverse=True)
    return first, inverse.ravel()


def _vectors(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(size, -1)


INDEX = "shard int, dim int, vec_id bigint, vector array<float>, number int, edges array<int>, entry boolean"


def _build_shard(g: Graph):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("vec_id").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        vectors = _vectors(table.column("vector"))
        first, number = _distinct(vectors)
        edges, entry = build(vectors[first], g)
        rows = [None] * len(vectors)
        is_entry = np.zeros(len(vectors), bool)
        is_entry[first[entry]] = True
        for k, row in zip(first, edges.astype(np.int32), strict=True):
            rows[k] = row
        return pa.table({"shard": table.column("shard"), "dim": table.column("dim"), "vec_id": table.column("vec_id"), "vector": table.column("vector"),
                         "number": pa.array(number.astype(np.int32)), "edges": pa.array(rows, pa.list_(pa.int32())), "entry": pa.array(is_entry)})
    return run


def _search_shard(g: Graph):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(index) or not len(queries):
            return schema.empty_table()
        ids, number = index.column("vec_id").to_numpy(), index.column("number").to_numpy()
        vectors, holds = _vectors(index.column("vector")), np.flatnonzero(index.column("edges").is_valid().to_numpy(zero_copy_only=False))
        nodes = holds[np.argsort(number[holds])]
        edges = _vectors(index.column("edges").take(pa.array(nodes)))
        entry = number[np.flatnonzero(index.column("entry").to_numpy(zero_copy_only=False))].astype(np.int64)
        order = np.lexsort((ids, number))
        starts = np.searchsorted(number[order], np.arange(len(nodes) + 1))
        asked, wanted = queries.column("query_id").to_numpy(), _vectors(queries.column("vector"))
        out: list[tuple] = []
        for a in range(0, len(asked), g.batch):
            found, _ = beam_search(vectors[nodes], edges, entry, wanted[a:a + g.batch], max(g.beam, 2 * g.k + 2))
            for q, near in enumerate(found, a):
                near = near[near >= 0]
                gap = np.sqrt(((vectors[nodes[near]].astype(np.float64) - wanted[q].astype(np.float64)) ** 2).sum(1))
                best = np.argsort(gap, kind="stable")
                hits, far = [], np.inf
                for j in best:  # equal vectors share a distance; the k smallest ids of each are enough
                    if len(hits) >= g.k and gap[j] > far:
                        break
                    own = ids[order[starts[near[j]]:starts[near[j] + 1]]]
                    hits += [(gap[j], int(v)) for v in own[own != asked[q]][:g.k]]
                    far = gap[j] if len(hits) >= g.k and far == np.inf else far
                hits.sort()
                out += [(int(asked[q]), v, float(d)) for d, v in hits[:g.k]]
        cols = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)
    return run


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or empty, no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, vec_id: Column, vector: Column, is_query: Column, g: Graph = Graph()) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance in double precision) of each query's k nearest found.

    Vectors go to shards by a hash of their id, so a group of equal vectors
    is spread; in a shard equal vectors are one node. Unusable vectors and
    null ids take no part; vectors of different lengths are never compared; rows
    that repeat an id are candidates each, and none is its own id's
    neighbour. A query with fewer candidates gets all. An empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "ann")
    rows = vectors.select(vec_id.cast("long").alias("vec_id"), vector.cast("array<float>").alias("vector"), is_query.alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))
    count, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("is_query"), 1))).first()
    shards, blocks = max(1, -(-count // g.shard)), max(1, -(-asked // g.block))
    index = (rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), "dim", "vec_id", "vector")
             .groupBy("shard", "dim").applyInArrow(_build_shard(g), INDEX))
    index = scratch.put(index, "index")
    queries = rows.where("is_query").select(F.col("vec_id").alias("query_id"), "vector", "dim",
                                            F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")).dropDuplicates(["query_id", "vector"])
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = left.groupBy("shard", "dim", "block").cogroup(right.groupBy("shard", "dim", "block")).applyInArrow(_search_shard(g), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    out = scratch.keep(found.withColumn("rank", rank).where(F.col("rank") <= g.k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
    scratch.drop()
    return out
