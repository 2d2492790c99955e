"""Approximate nearest neighbours: one small-world graph per shard.

1. Usable vectors (no null, zero, null or non-finite part, of the table's
   commonest length) are grouped by value: equal vectors are one node that
   keeps its ``k + 1`` least ids, more can never be in an answer.
2. Nodes are dealt to shards of about ``shard_size`` by hash.  Each shard
   builds a hierarchical navigable small-world graph in numpy; per level a
   flat array of neighbours, stored with its vectors in one row.
3. The queries, packed in blocks, visit every shard: a shard's row is sorted
   ahead of its blocks, so a task holds one graph and one block at a time.
4. Shard results are merged by a bounded top-k.

Graphs are built on vectors extended by one part that gives all the same
length, where the nearest is the one of the largest inner product.  Scores
are inner products of the original vectors in double precision.

Defined results: repeated rows of one ``vec_id`` count once (the least
vector, if they differ); an empty table gives no rows; with fewer candidates
than ``k`` all are returned; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import checkpointed

M = 16                      # neighbours kept per node; twice on the lowest level
EF_BUILD = 96
EF_SEARCH = 160
SHARD_SIZE = 16_384
BLOCK = 512                 # queries in one block


def _dots(a: np.ndarray, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.einsum("qkd,qd->qk", a[rows], q, optimize=False)


def beam_search(vectors: np.ndarray, graph: np.ndarray, queries: np.ndarray, entry: np.ndarray,
                ef: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of one level for all queries in step.

    ``graph`` holds flat neighbours (-1: none), ``entry`` (queries, e) start
    nodes.  Returns ids (-1: none) and inner products, best first."""
    n_q = len(queries)
    seen = np.zeros((n_q, len(vectors) + 1), bool)      # the last place stands for -1
    seen[:, -1] = True
    rows = np.arange(n_q)[:, None]
    ids = np.full((n_q, ef), -1, np.int64)
    sims = np.full((n_q, ef), -np.inf, np.float32)
    done = np.ones((n_q, ef), bool)
    e = min(ef, entry.shape[1])
    ids[:, :e] = entry[:, :e]
    sims[:, :e] = np.where(ids[:, :e] >= 0, _dots(vectors, ids[:, :e], queries), -np.inf)
    done[:, :e] = ids[:, :e] < 0
    seen[rows, ids[:, :e]] = True
    active = np.arange(n_q)
    while len(active):
        open_sims = np.where(done[active], -np.inf, sims[active])
        best = open_sims.argmax(axis=1)
        alive = open_sims[np.arange(len(active)), best] > -np.inf
        active, best = active[alive], best[alive]
        if not len(active):
            break
        done[active, best] = True
        near = graph[ids[active, best]].astype(np.int64)
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        s = np.where(fresh, _dots(vectors, np.where(fresh, near, 0), queries[active]), -np.inf)
        all_s = np.concatenate([sims[active], s], axis=1)
        order = np.argsort(-all_s, axis=1, kind="stable")[:, :ef]
        here = np.arange(len(active))[:, None]
        sims[active] = all_s[here, order]
        ids[active] = np.where(sims[active] > -np.inf,
                               np.concatenate([ids[active], near], axis=1)[here, order], -1)
        done[active] = np.concatenate([done[active], ~(s > -np.inf)], axis=1)[here, order]
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def spread(vectors: np.ndarray, cand: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
    """Up to ``m`` of each row's candidates (best first) such that each is
    nearer to the row's node than to one already taken; free places are then
    filled with the nearest left."""
    n, width = cand.shape
    v = vectors[np.where(cand < 0, 0, cand)]
    between = np.einsum("nid,njd->nij", v, v)
    taken = np.zeros((n, width), bool)
    blocked = cand < 0
    count = np.zeros(n, int)
    for i in range(width):
        ok = ~blocked[:, i] & (count < m)
        taken[:, i] = ok
        count += ok
        # later candidates nearer to this one than to the node are passed over
        blocked |= ok[:, None] & (between[:, i] > sims)
    rank = np.where(taken, 0, 1) * width + np.arange(width)
    rank = np.where(cand < 0, 3 * width, rank)
    order = np.argsort(rank, axis=1)[:, :m]
    out = np.take_along_axis(cand, order, 1)
    if out.shape[1] < m:
        out = np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)
    return out


def _sorted(cand: np.ndarray, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sims = np.where(cand < 0, -np.inf, sims)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)


def _link(vectors: np.ndarray, graph: np.ndarray, nodes: np.ndarray, chosen: np.ndarray) -> None:
    """Set the nodes' neighbours and add the links back, spread out where too many."""
    m = graph.shape[1]
    graph[nodes, :chosen.shape[1]] = chosen
    src = np.repeat(nodes, chosen.shape[1])
    dst = chosen.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    targets, first, counts = np.unique(dst, return_index=True, return_counts=True)
    for at in range(0, len(targets), 256):
        t, f, c = targets[at:at + 256], first[at:at + 256], counts[at:at + 256]
        add = np.full((len(t), c.max()), -1, np.int64)
        for k, (a, b) in enumerate(zip(f, c)):
            add[k, :b] = src[a:a + b]
        for lo in range(0, add.shape[1], 64):           # a node may gain very many links at once
            both = np.concatenate([graph[t].astype(np.int64), add[:, lo:lo + 64]], axis=1)
            sims = _dots(vectors, np.where(both < 0, 0, both), vectors[t])
            both, sims = _sorted(both, sims)
            # the same link from both sides stands side by side after sorting by similarity
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            both, sims = _sorted(both, sims)
            full = (both >= 0).sum(axis=1) > m
            graph[t[~full]] = both[~full][:, :m]
            if full.any():
                graph[t[full]] = spread(vectors, both[full], sims[full], m)


def build_level(vectors: np.ndarray, nodes: np.ndarray, m: int, ef: int) -> np.ndarray:
    """Flat neighbours of one level's ``nodes`` (rows of all others stay -1)."""
    graph = np.full((len(vectors), m), -1, np.int32)
    start = nodes[:min(len(nodes), 4 * m)]
    at = 0
    while at < len(nodes):
        batch = nodes[at:at + (len(start) if not at else min(BLOCK, max(at // 2, 16)))]
        inner = vectors[batch] @ vectors[batch].T
        np.fill_diagonal(inner, -np.inf)
        width = min(len(batch) - 1, ef // 2 if at else ef)
        cand = np.empty((len(batch), 0), np.int64)
        sims = np.empty((len(batch), 0), np.float32)
        if width > 0:
            top = np.argsort(-inner, axis=1, kind="stable")[:, :width]
            cand, sims = batch[top], np.take_along_axis(inner, top, 1)
        if at:
            entry = np.broadcast_to(start[:8], (len(batch), min(8, len(start))))
            found, s = beam_search(vectors, graph, vectors[batch], entry, ef)
            cand, sims = np.concatenate([found, cand], axis=1), np.concatenate([s, sims], axis=1)
        if cand.shape[1]:
            cand, sims = _sorted(cand, sims)
            keep = max(ef, m)
            _link(vectors, graph, batch, spread(vectors, cand[:, :keep], sims[:, :keep], max(m // 2, 2)))
        at += len(batch)
    return graph


def build(vectors: np.ndarray, m: int = M, ef: int = EF_BUILD, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the lowest up: (node ids, flat neighbours of these nodes)."""
    rng = np.random.default_rng(seed)
    height = np.floor(-np.log(rng.random(len(vectors)) + 1e-300) / np.log(m)).astype(int)
    levels = []
    for level in range(max(1, height.max(initial=0) + 1)):
        nodes = np.flatnonzero(height >= level)
        nodes = nodes[rng.permutation(len(nodes))]
        if level and len(nodes) < 8:
            break
        graph = build_level(vectors, nodes, 2 * m if level == 0 else m, ef)
        nodes = np.sort(nodes)
        levels.append((nodes, graph[nodes]))
    return levels


def search(vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray,
           ef: int = EF_SEARCH) -> tuple[np.ndarray, np.ndarray]:
    """From the top level down; ids and inner products of the ``ef`` best on the lowest."""
    top = levels[-1][0]
    entry = np.broadcast_to(top[:8], (len(queries), min(8, len(top))))
    for depth in range(len(levels) - 1, -1, -1):
        nodes, near = levels[depth]
        graph = np.full((len(vectors), near.shape[1]), -1, np.int32)
        graph[nodes] = near
        entry, sims = beam_search(vectors, graph, queries, entry, ef if depth == 0 else 16)
        entry = entry[:, :8] if depth else entry
    return entry, sims


def _matrix(raw: bytes, dim: int, kind=np.float32) -> np.ndarray:
    return np.frombuffer(raw, kind).reshape(-1, dim)


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, one row per id."""
    e = F.col("embedding")
    big = F.lit(float("inf"))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
            .where(F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0))
            .where(F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < big), F.lit(False)))
                   & F.exists(e, lambda x: x != 0)))
    sizes = rows.groupBy(F.size(e).alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size(e) == (sizes["d"] if sizes else 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def build_index(vectors: DataFrame, k: int, shard_size: int = SHARD_SIZE, m: int = M,
                ef: int = EF_BUILD) -> tuple[DataFrame, int]:
    """One row per shard with its vectors, ids and flat neighbour arrays; the number of shards."""
    # the k + 1 least ids of each distinct vector; Spark cuts the groups before the shuffle too
    by_value = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = (vectors.withColumn("r", F.row_number().over(by_value)).where(F.col("r") <= k + 1)
             .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    nodes = checkpointed(nodes)
    n = nodes.count()
    shards = max(1, -(-n // shard_size))

    def make(t: pa.Table) -> pa.Table:
        rows = sorted(zip(t.column("ids").to_pylist(), t.column("embedding").to_pylist()))
        v = np.array([e for _, e in rows], np.float32)
        d = v.astype(np.float64)
        square = (d * d).sum(axis=1)
        last = np.sqrt(np.maximum(square.max() - square, 0))
        # scaled so that no product leaves the range of single precision
        x = (np.concatenate([d, last[:, None]], axis=1) / np.sqrt(square.max())).astype(np.float32)
        levels = build(x, m, ef)
        return pa.table({
            "shard": pa.array([t.column("shard")[0].as_py()], pa.int32()),
            "kind": pa.array([0], pa.int32()), "dim": pa.array([v.shape[1]], pa.int32()),
            "vectors": pa.array([v.tobytes()], pa.binary()), "graph_vectors": pa.array([x.tobytes()], pa.binary()),
            "ids": pa.array([[list(i) for i, _ in rows]], pa.list_(pa.list_(pa.int64()))),
            "level_nodes": pa.array([[a.astype(np.int32).tobytes() for a, _ in levels]], pa.list_(pa.binary())),
            "level_near": pa.array([[b.astype(np.int32).tobytes() for _, b in levels]], pa.list_(pa.binary())),
        })

    index = (nodes.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))
             .groupBy("shard").applyInArrow(make, INDEX_SCHEMA))
    return checkpointed(index), shards


INDEX_SCHEMA = ("shard int, kind int, dim int, vectors binary, graph_vectors binary, ids array<array<long>>, "
                "level_nodes array<binary>, level_near array<binary>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = np.asarray(batch.column(0).to_pylist(), np.int64)
        rows = batch.column(1).to_pylist()
        for at in range(0, len(ids), BLOCK):
            v = np.array(rows[at:at + BLOCK], np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([1], pa.int32()), pa.array([v.shape[1]], pa.int32()), pa.array([v.tobytes()], pa.binary()),
                 pa.array([[[int(i)] for i in ids[at:at + BLOCK]]], pa.list_(pa.list_(pa.int64())))],
                ["kind", "dim", "vectors", "ids"])


def _searcher(k: int, ef: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    dim = row["dim"]
                    exact = _matrix(row["vectors"], dim).astype(np.float64)
                    x = _matrix(row["graph_vectors"], dim + 1)
                    near = [np.frombuffer(b, np.int32) for b in row["level_near"]]
                    nodes = [np.frombuffer(b, np.int32).astype(np.int64) for b in row["level_nodes"]]
                    levels = [(a, b.reshape(len(a), -1)) for a, b in zip(nodes, near)]
                    shard, members = row["shard"], row["ids"]
                    continue
                if row["shard"] != shard:
                    continue                    # a shard that got no node
                q = _matrix(row["vectors"], row["dim"])
                scaled = q / np.linalg.norm(q.astype(np.float64), axis=1, keepdims=True)
                found, _ = search(x, levels, np.pad(scaled.astype(np.float32), ((0, 0), (0, 1))), max(ef, k + 1))
                out_q, out_v, out_s = [], [], []
                for i, (own,) in enumerate(row["ids"]):
                    got = found[i][found[i] >= 0]
                    s = exact[got] @ q[i].astype(np.float64)
                    best = sorted((-score, v) for node, score in zip(got, s.tolist())
                                  for v in members[node] if v != own)[:k]
                    out_q += [own] * len(best)
                    out_v += [v for _, v in best]
                    out_s += [-score for score, _ in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_s, pa.float64())],
                    ["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, queries: DataFrame | None = None, k: int = 20, shard_size: int = SHARD_SIZE,
            ef: int = EF_SEARCH) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of each query's ``k`` nearest found.

    ``queries`` (vec_id, embedding) defaults to all vectors."""
    rows = checkpointed(usable(vectors))
    index, shards = build_index(rows, k, shard_size)
    asked = rows if queries is None else rows.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
    blocks = (asked.select("vec_id", "embedding").mapInArrow(
        _blocks, "kind int, dim int, vectors binary, ids array<array<long>>")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    work = (index.unionByName(blocks, allowMissingColumns=True)
            .repartition(max(shards, 1), "shard").sortWithinPartitions("shard", "kind"))
    found = work.mapInArrow(_searcher(k, ef), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
