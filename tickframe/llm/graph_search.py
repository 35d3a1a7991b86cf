"""Approximate nearest neighbours over robust-pruned directed graphs.

Distinct vectors are dealt by hash to shards of bounded size. In each shard
a directed graph is built in two passes: greedy beam searches from the
shard's medoid propose neighbours for every vector, and pruning keeps an
edge to a candidate only if no kept neighbour is closer to it by the factor
``ALPHA``; reverse edges are added and pruned the same way. Queries, in
blocks, are searched by beam in every shard, and the shards' nearest are
merged. Rows with equal vectors are one node; a node's smallest ids stand
for it, as many as a result can hold.

Measure: Euclidean distance on the original vectors, in double precision.

Cases: rows whose vector is null, zero, empty or holds null or non-finite
components, and rows without an id, take no part; of rows that share an id
the smallest vector counts; vectors of another length are no candidates of a
query; ties go to the smaller id; an empty table gives none; other columns
play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

K = 10
SHARD_ROWS = 4096
DEGREE, BEAM, QUERY_BEAM, ALPHA = 32, 64, 128, 1.2
QUERY_BLOCK = 1024
STEP = 256  # searches that go on at once inside a task


def _distances(points: np.ndarray, to: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``to`` to its own ``ids``."""
    d = points[ids]
    d -= to[:, None, :]
    return np.einsum("bkd,bkd->bk", d, d)


def beam_search(points: np.ndarray, edges: np.ndarray, start: int, to: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of the ``beam`` nearest that a greedy search
    from ``start`` finds for each row of ``to``; -1 where there are fewer."""
    rows = np.arange(len(to))
    ids = np.full((len(to), beam), -1)
    far = np.full((len(to), beam), np.inf, points.dtype)
    ids[:, 0] = start
    far[:, 0] = _distances(points, to, ids[:, :1])[:, 0]
    done = np.ones((len(to), beam), bool)
    done[:, 0] = False
    seen = np.zeros((len(to), len(points)), bool)
    seen[:, start] = True
    while True:
        open_ = np.where(done, np.inf, far)
        at = open_.argmin(1)
        go = np.flatnonzero(np.isfinite(open_[rows, at]))
        if not len(go):
            return ids, far
        done[go, at[go]] = True
        near = edges[ids[go, at[go]]]
        fresh = (near >= 0) & ~seen[go[:, None], near]
        seen[go[:, None], near] |= near >= 0
        d = np.where(fresh, _distances(points, to[go], near), np.inf)
        all_d = np.concatenate([far[go], d], 1)
        best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        take = lambda old, new: np.take_along_axis(np.concatenate([old, new], 1), best, 1)  # noqa: E731,B023
        ids[go], far[go] = take(ids[go], near), np.take_along_axis(all_d, best, 1)
        done[go] = take(done[go], ~fresh)


def robust_prune(points: np.ndarray, owners: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` of each owner's candidates (-1: none), nearest first,
    dropping those that a kept one is ``alpha`` times closer to."""
    same = (candidates == owners[:, None]) | (candidates < 0)
    d = np.where(same, np.inf, _distances(points, points[owners], candidates))
    order = np.argsort(d, axis=1, kind="stable")
    c, d = np.take_along_axis(candidates, order, 1), np.take_along_axis(d, order, 1)
    d[:, 1:][c[:, 1:] == c[:, :-1]] = np.inf  # a candidate named twice
    p = points[c]
    norm = np.einsum("bkd,bkd->bk", p, p)
    apart = norm[:, :, None] + norm[:, None, :] - 2 * (p @ p.transpose(0, 2, 1))
    alive, rows = np.isfinite(d), np.arange(len(owners))
    out = np.full((len(owners), degree), -1)
    for k in range(degree):
        first = alive.argmax(1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = c[rows, first][some]
        alive[rows, first] = False
        alive &= ~some[:, None] | (alpha * alpha * apart[rows, first] > d)
    return out


def build_graph(points: np.ndarray, seed: int = 7) -> tuple[np.ndarray, int]:
    """(edges, medoid) of a shard; edges are rows of ``DEGREE`` ids or -1."""
    n = len(points)
    centre = points.mean(0, keepdims=True)
    medoid = int(_distances(points, centre, np.arange(n)[None])[0].argmin())
    g = np.random.default_rng(seed)
    edges = g.integers(0, n, (n, min(DEGREE, max(n - 1, 1))))
    edges = np.pad(edges, ((0, 0), (0, DEGREE - edges.shape[1])), constant_values=-1)
    for alpha in (1.0, ALPHA):
        fresh = np.empty_like(edges)
        for a in range(0, n, STEP):
            owners = np.arange(a, min(a + STEP, n))
            found, _ = beam_search(points, edges, medoid, points[owners], BEAM)
            fresh[owners] = robust_prune(points, owners, np.concatenate([found, edges[owners]], 1), DEGREE, alpha)
        source, target = np.repeat(np.arange(n), DEGREE), fresh.ravel()
        ok = target >= 0
        a, b = np.concatenate([source[ok], target[ok]]), np.concatenate([target[ok], source[ok]])
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        uniq = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
        a, b = a[uniq], b[uniq]
        count = np.bincount(a, minlength=n)
        slot = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        edges = np.full((n, DEGREE), -1)
        fits = count[a] <= DEGREE
        edges[a[fits], slot[fits]] = b[fits]
        full = np.flatnonzero(count > DEGREE)
        for group in np.array_split(full[np.argsort(count[full])], max(1, len(full) // STEP)):  # of similar size
            if len(group):
                wide = np.full((len(group), int(count[group].max())), -1)
                at = np.full(n, -1)
                at[group] = np.arange(len(group))
                mine = at[a] >= 0
                wide[at[a[mine]], slot[mine]] = b[mine]
                for s in range(0, len(group), max(1, 2_000_000 // wide.shape[1] ** 2)):
                    part = slice(s, s + max(1, 2_000_000 // wide.shape[1] ** 2))
                    edges[group[part]] = robust_prune(points, group[part], wide[part], DEGREE, alpha)
    return edges, medoid


def _usable(vectors: DataFrame) -> DataFrame:
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda x: x != 0)).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def build_index(nodes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each shard: (shard, dim, ids, points, edges, medoid)."""
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select("node", "embedding", F.size("embedding").alias("dim"), F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"))

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("node")
        dim = table["dim"][0].as_py()
        points = table["embedding"].chunk(0).flatten().to_numpy().reshape(-1, dim)
        edges, medoid = build_graph(points.astype(np.float32))
        return pa.table({"shard": table["shard"][:1], "dim": table["dim"][:1], "ids": pa.array([table["node"].to_numpy().tobytes()], pa.binary()), "points": pa.array([points.tobytes()], pa.binary()),
                         "edges": pa.array([edges.astype(np.int32).tobytes()], pa.binary()), "medoid": pa.array([medoid], pa.int32())})

    return dealt.groupBy("dim", "shard").applyInArrow(build, "shard int, dim int, ids binary, points binary, edges binary, medoid int")


def search_index(index: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(query, node, distance): the ``k`` nearest nodes that each shard finds
    for each query of ``blocks`` (dim, queries, vectors)."""

    def tasks(batches):
        for batch in batches:
            for row in batch.to_pylist():
                points = np.frombuffer(row["points"], np.float64).reshape(-1, row["dim"])
                single, ids = points.astype(np.float32), np.frombuffer(row["ids"], np.int64)
                edges = np.frombuffer(row["edges"], np.int32).reshape(-1, DEGREE)
                to, queries = np.array(row["vectors"], np.float64), np.array(row["queries"], np.int64)
                for a in range(0, len(to), STEP):
                    part = to[a:a + STEP]
                    found, _ = beam_search(single, edges, row["medoid"], part.astype(np.float32), QUERY_BEAM)
                    exact = np.where(found >= 0, np.sqrt(_distances(points, part, found)), np.inf)
                    order = np.lexsort((ids[found], exact), axis=1)[:, :k]
                    best, exact = np.take_along_axis(found, order, 1), np.take_along_axis(exact, order, 1)
                    ok = np.isfinite(exact)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(queries[a:a + STEP], ok.sum(1))), pa.array(ids[best[ok]]), pa.array(exact[ok])], ["query", "node", "distance"])

    return index.join(blocks, "dim").mapInArrow(tasks, "query long, node long, distance double")


def nearest(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each
    row that ``is_query(vec_id)`` holds for."""
    rows = stage(_usable(vectors), "vectors")
    equal = Window.partitionBy("embedding").orderBy("vec_id")
    # the smallest ids of each vector; Spark limits the groups before the shuffle
    firsts = rows.withColumn("copy", F.row_number().over(equal)).where(F.col("copy") <= k + 1)
    firsts = stage(firsts.withColumn("node", F.min("vec_id").over(Window.partitionBy("embedding"))), "vector-nodes")
    nodes = firsts.where("copy = 1").select("node", "embedding")
    asked = stage(rows.where(is_query(F.col("vec_id"))).join(nodes, "embedding").select("vec_id", "node"), "vector-queries")
    index = stage(build_index(nodes), "vector-index")
    distinct = nodes.join(asked.select("node").distinct(), "node", "left_semi")
    n_blocks = max(1, -(-distinct.count() // QUERY_BLOCK))
    blocks = (distinct.groupBy(F.size("embedding").alias("dim"), F.pmod(F.xxhash64("node", F.lit(1)), F.lit(n_blocks)).alias("block"))
              .agg(F.collect_list(F.struct("node", "embedding")).alias("q")).select("dim", "q.node", "q.embedding").toDF("dim", "queries", "vectors"))
    found = search_index(index, blocks, k + 1)
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("distance", "node"))).where(F.col("place") <= k + 1)
    best = stage(best.select("query", "node", "distance"), "vector-found")
    each = (asked.withColumnsRenamed({"vec_id": "query_id", "node": "query"}).join(best, "query")
            .join(firsts.select("node", "vec_id"), "node").where(F.col("vec_id") != F.col("query_id")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("distance").alias("score"))
