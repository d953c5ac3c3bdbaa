"""Operator 8: approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Build: rows go to shards by a hash of their id, about ``shard_rows`` each.  A shard starts from a
random directed graph; then, in two rounds over the vectors in random order, a greedy beam search
from the medoid proposes each vector's neighbours (everything it visits), and relaxed pruning
keeps at most ``degree`` of them: nearest first, dropping a candidate whose distance to a kept one
times ``alpha`` is no more than its distance to the vector, so that edges stay diverse.  Reverse
edges are added and pruned likewise.  Searches of a batch of vectors run in step, as array
operations.

Search: blocks of queries visit every shard; a beam search of width ``beam`` returns the shard's
nearest, and the best over all shards is kept per query.  Distances are Euclidean in double
precision on the original vectors.

Equal vectors of a shard are one node that holds their smallest ids, as many as a result can
need, so ties go to the smaller id and copies cannot crowd out the beam.  Every row is indexed; a
task holds one shard and one block of queries.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part, neither do null ids; rows that repeat an id and a vector are one; vectors of another length
than a query's are no candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinemetric.llm.shared import stored, work_dir
from cinemetric.llm.vectors import matrix, usable

INDEX = "dim int, shard long, vectors binary, edges binary, medoid long, ids array<array<long>>"
HITS = "query_id long, vec_id long, score double"


def beam_search(
    data: np.ndarray, squares: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and squared distances of each query's beam, nearest first (node -1: none).

    All queries take a step at a time: each expands its nearest open node.
    """
    n, q = len(data), len(queries)
    q_squares = (queries * queries).sum(axis=1)
    nodes = np.full((q, beam), -1, np.int64)
    dists = np.full((q, beam), np.inf)
    opened = np.ones((q, beam), bool)
    nodes[:, 0] = start
    dists[:, 0] = q_squares + squares[start] - 2.0 * queries @ data[start]
    opened[:, 0] = False
    seen = np.zeros((q, n + 1), bool)  # the last column takes the padding of short edge lists
    seen[:, start] = seen[:, n] = True
    active = np.arange(q)
    while len(active):
        best = np.argmin(np.where(opened[active], np.inf, dists[active]), axis=1)
        done = opened[active, best]
        active, best = active[~done], best[~done]
        if not len(active):
            break
        opened[active, best] = True
        near = edges[nodes[active, best]]
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        safe = np.where(fresh, near, 0)
        d = q_squares[active, None] + squares[safe] - 2.0 * np.einsum("qrd,qd->qr", data[safe], queries[active])
        d = np.where(fresh, d, np.inf)
        all_d = np.concatenate([dists[active], d], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        rows = np.arange(len(active))[:, None]
        dists[active] = all_d[rows, order]
        nodes[active] = np.concatenate([nodes[active], np.where(fresh, near, -1)], axis=1)[rows, order]
        opened[active] = np.concatenate([opened[active], ~fresh], axis=1)[rows, order]
    return nodes, dists


def robust_prune(data: np.ndarray, node: int, proposed: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours out of the proposed ones."""
    proposed = np.unique(proposed)
    proposed = proposed[(proposed >= 0) & (proposed != node)]
    if not len(proposed):
        return proposed
    points = data[proposed]
    to_node = ((points - data[node]) ** 2).sum(axis=1)
    order = np.argsort(to_node, kind="stable")
    proposed, points, to_node = proposed[order], points[order], to_node[order]
    squares = (points * points).sum(axis=1)
    between = squares[:, None] + squares[None, :] - 2.0 * points @ points.T
    covered = between * (alpha * alpha) <= to_node[None, :]
    open_, kept = np.ones(len(proposed), bool), []
    while len(kept) < degree:
        i = int(open_.argmax())
        if not open_[i]:
            break
        kept.append(i)
        open_ &= ~covered[i]
        open_[i] = False
    return proposed[kept]


def build_graph(data: np.ndarray, degree: int, beam: int, alpha: float, seed: int) -> tuple[np.ndarray, int]:
    """Edge lists (padded with ``len(data)``) and the node that searches start from."""
    n = len(data)
    rng = np.random.default_rng(seed)
    edges = np.full((n, degree), n, np.int64)
    count = min(degree, n - 1)
    if count:
        edges[:, :count] = (np.arange(n)[:, None] + 1 + rng.integers(0, n - 1, (n, count))) % n
    squares = (data * data).sum(axis=1)
    middle = data.mean(axis=0)
    medoid = int(np.argmin(squares - 2.0 * data @ middle))
    for relax in (1.0, alpha):
        for part in np.array_split(rng.permutation(n), max(1, -(-n // 256))):
            found, _ = beam_search(data, squares, edges, medoid, data[part], beam)
            for node, hits in zip(part.tolist(), found):
                old = edges[node]
                new = robust_prune(data, node, np.concatenate([hits, old[old < n]]), degree, relax)
                edges[node] = n
                edges[node, : len(new)] = new
                for other in new.tolist():
                    row = edges[other]
                    if (row == node).any():
                        continue
                    free = np.flatnonzero(row == n)
                    if len(free):
                        row[free[0]] = node
                    else:
                        less = robust_prune(data, other, np.append(row, node), degree, relax)
                        row[:] = n
                        row[: len(less)] = less
    return edges, medoid


def build_index(
    rows: DataFrame, shard_rows: int = 4096, degree: int = 24, beam: int = 48, alpha: float = 1.2, keep_ids: int = 11, seed: int = 5
) -> DataFrame:
    """``rows(vec_id, embedding)``, usable and distinct, to one index row per shard."""
    shards = max(1, -(-rows.count() // shard_rows))

    def build(table: pa.Table) -> pa.Table:
        vectors = matrix(table.column("embedding"))
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        data, kind = np.unique(vectors[order], axis=0, return_inverse=True)
        own: list[list[int]] = [[] for _ in range(len(data))]
        for k, i in zip(kind.ravel().tolist(), ids[order].tolist()):
            if len(own[k]) < keep_ids:
                own[k].append(i)
        edges, medoid = build_graph(data, degree, beam, alpha, seed)
        return pa.table(
            {
                "dim": pa.array([data.shape[1]], pa.int32()),
                "shard": table.column("shard").slice(0, 1),
                "vectors": pa.array([data.tobytes()], pa.binary()),
                "edges": pa.array([edges.astype("<u4").tobytes()], pa.binary()),
                "medoid": [medoid],
                "ids": pa.array([own], pa.list_(pa.list_(pa.int64()))),
            }
        )

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards))).withColumn("dim", F.size("embedding"))
    # building takes far more time than its bytes tell: keep a task per shard, do not merge small ones
    return dealt.repartition(shards, "dim", "shard").groupBy("dim", "shard").applyInArrow(build, INDEX)


def search_shard(index: pa.Table, queries: pa.Table, k: int, beam: int) -> pa.Table:
    """The ``k`` nearest of one shard for each query of a block (not the query's own id)."""
    dim = index.column("dim")[0].as_py()
    data = np.frombuffer(index.column("vectors")[0].as_py(), np.float64).reshape(-1, dim)
    edges = np.frombuffer(index.column("edges")[0].as_py(), "<u4").astype(np.int64).reshape(len(data), -1)
    own = index.column("ids")[0].as_py()
    points, query_ids = matrix(queries.column("embedding")), queries.column("vec_id").to_pylist()
    squares = (data * data).sum(axis=1)
    out: list[tuple[int, int, float]] = []
    for at in range(0, len(points), 256):
        part = points[at : at + 256]
        found, _ = beam_search(data, squares, edges, index.column("medoid")[0].as_py(), part, beam)
        for query_id, point, nodes in zip(query_ids[at : at + 256], part, found):
            nodes = nodes[nodes >= 0]
            exact = np.sqrt(((data[nodes] - point) ** 2).sum(axis=1))
            hits = [(float(d), i) for d, node in zip(exact, nodes.tolist()) for i in own[node] if i != query_id]
            out += [(query_id, i, d) for d, i in sorted(hits)[:k]]
    columns = list(zip(*out)) or [(), (), ()]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})


def nearest(
    rows: DataFrame,
    every: int = 100,
    k: int = 10,
    beam: int = 128,
    block: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    **build,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``."""
    folder = work_dir(rows.sparkSession, "graph-search")
    usable_rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")).filter(
        usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    )
    vectors = stored(usable_rows.groupBy("vec_id", "embedding").agg(F.count(F.lit(1)).alias("times")).drop("times"), f"{folder}/vectors")
    index = stored(build_index(vectors, keep_ids=k + 1, **build), f"{folder}/index")
    queries = vectors.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // block))
    shards = rows.sparkSession.read.schema(index.schema).parquet(f"{folder}/index").select("dim", "shard")
    asked = (
        queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)))
        .withColumn("dim", F.size("embedding"))
        .join(shards, "dim")  # the stated query set against every shard, in blocks
    )
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return search_shard(left, right, k, beam)

    by = ["dim", "shard", "block"]
    hits = spread.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(search, HITS)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
