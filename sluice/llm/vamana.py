"""Nearest neighbours by robust-pruned directed graphs, one for each shard of the vectors.

A shard holds about ``SHARD_ROWS`` vectors; equal vectors are one node with several ids. Nodes enter the graph in
batches: a greedy beam search from the medoid proposes neighbours, and pruning walks through them from near to far,
keeps one, and drops those that are closer to it, times ``ALPHA``, than to the node, so that edges point in
different directions. Reverse edges are added and pruned the same way. A second pass over all nodes refines the
first. A query is searched with a beam in every shard, and the shards' answers are ranked by exact distances.

The index is a table with one row for each shard. Queries stream past it, so memory holds one shard and one slice of
queries, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import parts, staged

SHARD_ROWS = 8192
DEGREE = 32
BUILD_BEAM = 64
BEAM = 128
ALPHA = 1.2
BATCH = 512
#: Nodes of the beam that are opened in one step.
OPENED = 4

INDEX = "dim int, shard int, ids binary, starts binary, vectors binary, edges binary, entry int"


def _squared(x: np.ndarray, norms: np.ndarray, nodes: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of each point to its own row of nodes."""
    inner = np.matmul(x[nodes], points[:, :, None])[:, :, 0]
    return np.maximum(norms[nodes] - 2 * inner + np.einsum("ij,ij->i", points, points)[:, None], 0)


def beam_search(x: np.ndarray, norms: np.ndarray, edges: np.ndarray, entry: int, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes that a greedy search finds for each point, nearest first, and their squared distances.

    ``edges`` has a row of neighbours for each node, filled up with the node itself. Places without a node are -1.
    """
    seen = np.zeros((len(points), len(x)), bool)
    ids = np.full((len(points), beam), -1, np.int64)
    far = np.full((len(points), beam), np.inf, x.dtype)
    opened = np.ones((len(points), beam), bool)
    ids[:, 0], opened[:, 0], seen[:, entry] = entry, False, True
    far[:, 0] = _squared(x, norms, ids[:, :1], points)[:, 0]
    while not opened.all():
        busy = np.flatnonzero(~opened.all(axis=1))
        # The nearest nodes that are not yet open; a row with fewer opens one again, which finds nothing new.
        place = np.argsort(opened[busy], axis=1, kind="stable")[:, :OPENED]
        opened[busy[:, None], place] = True
        at = np.maximum(ids[busy[:, None], place], 0)
        new = edges[at].reshape(len(busy), -1)
        new.sort(axis=1)
        again = np.zeros(new.shape, bool)
        again[:, 1:] = new[:, 1:] == new[:, :-1]
        again |= seen[busy[:, None], new]
        seen[busy[:, None], new] = True
        d = _squared(x, norms, new, points[busy])
        d[again] = np.inf
        both = np.concatenate([far[busy], d], axis=1)
        best = np.argsort(both, axis=1, kind="stable")[:, :beam]
        far[busy] = np.take_along_axis(both, best, axis=1)
        ids[busy] = np.take_along_axis(np.concatenate([ids[busy], new], axis=1), best, axis=1)
        opened[busy] = np.take_along_axis(np.concatenate([opened[busy], again], axis=1), best, axis=1) | np.isinf(far[busy])
    ids[np.isinf(far)] = -1
    return ids, far


def robust_prune(x: np.ndarray, norms: np.ndarray, nodes: np.ndarray, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node up to ``degree`` diverse neighbours out of its row of candidates (-1: none), filled up with itself."""
    far = _squared(x, norms, np.maximum(near, 0), x[nodes])
    far[(near < 0) | (near == nodes[:, None])] = np.inf
    order = np.lexsort((near, far), axis=1)
    near, far = np.take_along_axis(near, order, axis=1), np.take_along_axis(far, order, axis=1)
    far[:, 1:][near[:, 1:] == near[:, :-1]] = np.inf
    alive = np.isfinite(far)
    kept = np.repeat(nodes[:, None], degree, axis=1)
    vectors, own = x[np.maximum(near, 0)], norms[np.maximum(near, 0)]
    for k in range(degree):
        rows = np.flatnonzero(alive.any(axis=1))
        if not len(rows):
            break
        first = alive[rows].argmax(axis=1)
        chosen = near[rows, first]
        kept[rows, k] = chosen
        between = own[rows] - 2 * np.matmul(vectors[rows], x[chosen][:, :, None])[:, :, 0] + norms[chosen][:, None]
        alive[rows] &= alpha * alpha * between > far[rows]
        alive[rows, first] = False
    return kept


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, batch: int = BATCH) -> tuple[np.ndarray, int]:
    """The graph's edges, a row for each vector, and the node where searches begin. The vectors are distinct."""
    n = len(x)
    norms = np.einsum("ij,ij->i", x, x)
    middle = x.mean(axis=0)
    entry = int((norms - 2 * x @ middle).argmin())
    if n <= degree + 1:
        return np.tile(np.arange(n), (n, 1)), entry
    random = np.random.default_rng(n)
    edges = random.integers(0, n, (n, degree))
    for relax in (1.0, alpha):
        order = random.permutation(n)
        for start in range(0, n, batch):
            nodes = order[start : start + batch]
            found, _ = beam_search(x, norms, edges, entry, x[nodes], beam)
            edges[nodes] = robust_prune(x, norms, nodes, np.concatenate([found, edges[nodes]], axis=1), degree, relax)
            # Reverse edges, grouped by the node that gets them.
            ends, starts = edges[nodes].ravel(), np.repeat(nodes, degree)
            true = ends != starts
            ends, starts = ends[true], starts[true]
            by = np.argsort(ends, kind="stable")
            ends, starts = ends[by], starts[by]
            at, first, count = np.unique(ends, return_index=True, return_counts=True)
            given = np.full((len(at), count.max()), -1, np.int64)
            given[np.repeat(np.arange(len(at)), count), np.arange(len(ends)) - np.repeat(first, count)] = starts
            for part in range(0, len(at), batch):
                some = slice(part, part + batch)
                edges[at[some]] = robust_prune(x, norms, at[some], np.concatenate([edges[at[some]], given[some]], axis=1), degree, relax)
    return edges, entry


def valid(vector: F.Column) -> F.Column:
    """Vectors with components, all of them there and finite, and one at least not zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def _taken(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    found = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return found.filter(valid(F.col("vector")) & F.col("vec_id").isNotNull()).withColumn("dim", F.size("vector"))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(-1, dim)


def _centred(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """What to subtract from vectors and divide them by before distances are made from norms and inner products.

    Those lose all digits where vectors share an offset much larger than their spread, and overflow where one is huge. The
    middle is the components' median, which a few huge vectors don't move. Distances keep their order.
    """
    middle = np.median(vectors / 2, axis=0) * 2
    with np.errstate(over="ignore"):
        largest = np.abs(vectors / 2 - middle / 2).max(initial=0.0) * 2
    return middle, min(largest, np.finfo(float).max) or 1.0


def _scaled(vectors: np.ndarray, middle: np.ndarray, scale: float) -> np.ndarray:
    return (vectors / 2 - middle / 2) / (scale / 2)


def _index(group: pa.Table) -> pa.Table:
    """A shard's row. Equal vectors are one node; its ids are ``ids[starts[node]:starts[node + 1]]``, smallest first."""
    dim = group.column("dim")[0].as_py()
    ids, x = group.column("vec_id").to_numpy(), _matrix(group.column("vector"), dim) + 0.0
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], np.ascontiguousarray(x[order])
    rows = x.view(np.dtype((np.void, x.dtype.itemsize * dim))).ravel()
    _, first, node = np.unique(rows, return_index=True, return_inverse=True)
    by = np.argsort(node, kind="stable")
    by = by[np.append(True, (node[by][1:] != node[by][:-1]) | (ids[by][1:] != ids[by][:-1]))]  # a repeated row counts once
    starts = np.append(0, np.cumsum(np.bincount(node[by])))
    edges, entry = build(_scaled(x[first], *_centred(x[first])))
    row = {
        "dim": pa.array([dim], pa.int32()), "shard": group.column("shard").slice(0, 1), "ids": [ids[by].tobytes()], "starts": [starts.tobytes()],
        "vectors": [x[first].tobytes()], "edges": [edges.astype(np.int32).tobytes()], "entry": pa.array([entry], pa.int32()),
    }
    return pa.table(row)


def graph_index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """The written index of every valid vector, and the number of shards of each dimension.

    Vectors that are null, empty, zero or hold a null or non-finite component, and rows without an id, take no part.
    Vectors of different dimensions lie in different shards and are never compared. Other columns are ignored.
    """
    found = _taken(vectors, vec_id, vector)
    shards = parts(vectors.count(), shard_rows)
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return staged(dealt.groupBy("dim", "shard").applyInArrow(_index, INDEX)), shards


def search(index: DataFrame, shards: int, queries: DataFrame, k: int = 10, beam: int = BEAM, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each valid query, nearest first, ties to the smaller id.

    ``score`` is the Euclidean distance in double precision. A query's own id is no answer. A query finds all
    candidates if there are no more than ``k``, and none if no vector has its dimension. Of query rows with the same id
    one is searched.
    """
    asked = _taken(queries, vec_id, vector).dropDuplicates(["vec_id"]).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = index.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    met = both.repartition(4 * shards, "dim", "shard").sortWithinPartitions("dim", "shard", "kind", "vec_id")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: dict = {}
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            for start in (0, *(np.flatnonzero(kinds[1:] != kinds[:-1]) + 1).tolist()):
                stop = start + int((np.append(kinds[start:], -1) != kinds[start]).argmax())
                part = batch.slice(start, stop - start)
                if kinds[start] == 0:
                    shard = part.slice(part.num_rows - 1).to_pylist()[0]  # earlier ones have no queries
                    continue
                yield from _answers(shard, part, k, beam)

    found = met.mapInArrow(answer, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")


def _answers(shard: dict, part: pa.RecordBatch, k: int, beam: int) -> Iterator[pa.RecordBatch]:
    """A shard's nearest of each query of its dimension."""
    where = np.array([shard.get("dim") == d and shard.get("shard") == s for d, s in zip(part.column("dim").to_pylist(), part.column("shard").to_pylist())])
    if not where.any():
        return
    part, dim = part.filter(pa.array(where)), shard["dim"]
    exact = np.frombuffer(shard["vectors"]).reshape(-1, dim)
    middle, scale = _centred(exact)
    x = _scaled(exact, middle, scale)
    norms = np.einsum("ij,ij->i", x, x)
    edges = np.frombuffer(shard["edges"], np.int32).reshape(len(x), -1).astype(np.int64)
    ids, starts = np.frombuffer(shard["ids"], np.int64), np.frombuffer(shard["starts"], np.int64)
    for start in range(0, part.num_rows, BATCH):
        some = part.slice(start, BATCH)
        own, points = some.column("vec_id").to_numpy(), _matrix(some.column("vector"), dim)
        nodes, _ = beam_search(x, norms, edges, shard["entry"], np.clip(_scaled(points, middle, scale), -1e150, 1e150), min(max(beam, 2 * k), len(x)))
        out: list[tuple[int, int, float]] = []
        for q, point, row in zip(own.tolist(), points, nodes):
            row = row[row >= 0]
            score = np.sqrt(((exact[row] - point) ** 2).sum(axis=1))
            # A node's first k + 1 ids are enough, as one of them may be the query's own.
            found = [(s, i) for s, node in zip(score.tolist(), row.tolist()) for i in ids[starts[node] : min(starts[node + 1], starts[node] + k + 1)].tolist() if i != q]
            out += [(q, i, s) for s, i in sorted(found)[:k]]
        columns = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` found for each row of ``queries``; see ``search``."""
    index, shards = graph_index(vectors, vec_id, vector)
    return search(index, shards, queries, k, vec_id=vec_id, vector=vector)
