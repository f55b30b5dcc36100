"""Approximate nearest neighbours by robust-pruned directed graphs.

The distinct vectors are dealt to shards by their hash. In each shard a graph is
grown batch by batch: a greedy beam search over the graph so far proposes
neighbours of a new point, and relaxed pruning keeps a diverse few of them: a
candidate goes if a kept neighbour is closer to it, by the factor ``alpha``, than the
point itself. Queries come in blocks; each block is searched in every shard by beam
search, and the shards' nearest are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import written


@dataclass(frozen=True)
class GraphSettings:
    degree: int = 32  # edges of a point, at most
    alpha: float = 1.2  # relaxation of the pruning, on distances
    build_beam: int = 64
    search_beam: int = 160
    shard_rows: int = 8192  # distinct vectors of a shard, about
    batch: int = 256  # points inserted at once, and queries of a block
    expand: int = 4  # beam entries expanded in one step


SETTINGS = GraphSettings()


def squared(points: np.ndarray, ids: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``to`` from its row of candidate ids."""
    gap = points[ids] - to[:, None, :]
    return np.einsum("ijk,ijk->ij", gap, gap)


def beam_search(points, graph, start: int, queries, beam: int, expand: int):
    """Ids and squared distances of the ``beam`` nearest found, nearest first.

    ``graph``: one row of neighbour ids per point, -1 for none. All queries advance
    together; rows with fewer than ``beam`` points end with id -1, distance inf.
    """
    n, rows = len(queries), np.arange(len(queries))[:, None]
    ids = np.full((n, beam), -1, np.int64)
    dist = np.full((n, beam), np.inf)
    ids[:, 0] = start
    dist[:, 0] = squared(points, ids[:, :1], queries)[:, 0]
    open_ = np.zeros((n, beam), bool)
    open_[:, 0] = True
    seen = np.zeros((n, len(points) + 1), bool)  # the last column takes the -1s
    seen[:, start] = True
    seen[:, -1] = True
    while open_.any():
        at = np.argsort(~open_, axis=1, kind="stable")[:, :expand]
        use = np.take_along_axis(open_, at, 1)
        np.put_along_axis(open_, at, False, 1)
        new = graph[np.take_along_axis(ids, at, 1)]
        new[~use] = -1
        new = np.sort(new.reshape(n, -1), axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[seen[rows, new]] = -1
        seen[rows, new] = True
        far = np.where(new >= 0, squared(points, new, queries), np.inf)
        ids, dist = np.c_[ids, new], np.c_[dist, far]
        open_ = np.c_[open_, new >= 0]
        order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        open_ = np.take_along_axis(open_, order, 1)
    return ids, dist


def robust_prune(points, candidates, dist, degree: int, alpha: float) -> np.ndarray:
    """The kept neighbours of each row: nearest first, -1 where there are no more.

    ``candidates`` may repeat ids or hold -1; ``dist`` is squared, inf for -1.
    """
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(candidates, order, 1), np.take_along_axis(dist, order, 1)
    near = points[ids]
    norm = np.einsum("ijk,ijk->ij", near, near)
    between = norm[:, :, None] + norm[:, None, :] - 2 * near @ near.transpose(0, 2, 1)
    alive = np.isfinite(dist)
    kept = np.full((len(ids), degree), -1, np.int64)
    rows = np.arange(len(ids))
    for k in range(degree):
        pick = alive.argmax(axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        kept[some, k] = ids[rows, pick][some]
        alive &= ~((alpha * alpha * between[rows, pick] <= dist) & some[:, None])
        alive &= ids != ids[rows, pick][:, None]
    return kept


def build_graph(points: np.ndarray, settings: GraphSettings = SETTINGS) -> tuple[np.ndarray, int]:
    """Neighbour table and start point of the points, which are all different."""
    n, degree = len(points), settings.degree
    graph = np.full((n, degree), -1, np.int64)
    # Order of insertion: the start point, the one nearest the mean, is first.
    gap = points - points.mean(axis=0)
    start = int(np.einsum("ij,ij->i", gap, gap).argmin())
    order = np.r_[start, np.setdiff1d(np.arange(n), start)]
    done = 1
    while done < n:
        batch = order[done : done + min(settings.batch, max(16, done))]
        found, dist = beam_search(points, graph, start, points[batch], settings.build_beam, settings.expand)
        if done < settings.build_beam:
            # A small graph may not be connected yet: take everything so far, and the batch.
            found = np.tile(order[: done + len(batch)], (len(batch), 1))
            dist = squared(points, found, points[batch])
        dist = np.where((found == batch[:, None]) | (found < 0), np.inf, dist)
        graph[batch] = robust_prune(points, found, dist, degree, settings.alpha)
        link_back(points, graph, batch, settings)
        done += len(batch)
    return graph, start


def link_back(points, graph, batch, settings: GraphSettings) -> None:
    """Adds the edges towards ``batch``; a point with too many prunes them."""
    degree = settings.degree
    source = np.repeat(batch, degree)
    target = graph[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    gap = points[source] - points[target]
    order = np.lexsort((np.einsum("ij,ij->i", gap, gap), target))
    source, target = source[order], target[order]
    first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
    nth = np.arange(len(target)) - np.repeat(first, np.diff(np.r_[first, len(target)]))
    owners = target[first]
    row = np.repeat(np.arange(len(owners)), np.diff(np.r_[first, len(target)]))
    near = nth < degree  # more could not be kept anyway
    fresh = np.full((len(owners), degree), -1, np.int64)
    fresh[row[near], nth[near]] = source[near]
    for at in range(0, len(owners), settings.batch):
        own = owners[at : at + settings.batch]
        both = np.c_[graph[own], fresh[at : at + settings.batch]]
        dist = np.where(both >= 0, squared(points, both, points[own]), np.inf)
        fits = (both >= 0).sum(axis=1) <= degree
        graph[own] = robust_prune(points, both, dist, degree, settings.alpha)
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :degree]
        graph[own[fits]] = packed[fits]


def usable(vector: str) -> Column:
    """Neither null nor zero, and every component a finite number."""
    inf = F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf))
    return F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def build_index(vectors: DataFrame, keep: int, settings: GraphSettings = SETTINGS) -> DataFrame:
    """One row per shard: its points, their graph, and ids of each point.

    Equal vectors are one point, with the ``keep`` smallest of their ids: no more of
    them can be among the nearest ``keep``. They are ranked per vector, with Spark's
    limit per group before the shuffle, so a vector that is very common costs a few
    rows per task. Every point is indexed.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("vector"))
    nth = F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id"))
    points = rows.withColumn("nth", nth).where(F.col("nth") <= keep)
    points = points.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    points = written(points, "points")
    shards = max(1, math.ceil(points.count() / settings.shard_rows))
    dealt = points.select(
        F.size("vector").alias("dims"), F.pmod(F.xxhash64("vector"), F.lit(shards)).alias("shard"), "vector", "ids"
    )

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ids", key=lambda ids: ids.str[0])
        matrix = np.stack(frame["vector"].to_numpy()).astype(np.float64)
        graph, start = build_graph(matrix, settings)
        count = np.array([len(x) for x in frame["ids"]], np.int64)
        return pd.DataFrame(
            {
                "dims": [matrix.shape[1]],
                "shard": [frame["shard"].iloc[0]],
                "start": [start],
                "points": [matrix.tobytes()],
                "graph": [graph.astype(np.int32).tobytes()],
                "ids": [np.concatenate(frame["ids"].to_numpy()).astype(np.int64).tobytes()],
                "n_ids": [count.tobytes()],
            }
        )

    schema = "dims int, shard long, start int, points binary, graph binary, ids binary, n_ids binary"
    # A task to a shard, or nearly: graphs take long to grow.
    dealt = dealt.repartition(2 * shards, "dims", "shard")
    return written(dealt.groupBy("dims", "shard").applyInPandas(grow, schema), "graphs")


class Shard:
    """A shard of the index in a task's memory."""

    def __init__(self, row, settings: GraphSettings):
        self.key = row.dims, row.shard
        self.start = int(row.start)
        self.points = np.frombuffer(row.points).reshape(-1, row.dims)
        self.graph = np.frombuffer(row.graph, np.int32).reshape(-1, settings.degree).astype(np.int64)
        self.ids, self.n_ids = np.frombuffer(row.ids, np.int64), np.frombuffer(row.n_ids, np.int64)
        self.first = np.r_[0, np.cumsum(self.n_ids)]

    def nearest(self, queries, k: int, settings: GraphSettings) -> pd.DataFrame:
        """query_id, vec_id, score of a block: each query's ``k`` nearest, and all as near as the last."""
        wanted = np.array([q["vec_id"] for q in queries], np.int64)
        vectors = np.array([q["vector"] for q in queries], np.float64)
        beam = max(settings.search_beam, 2 * (k + 1))
        found, dist = beam_search(self.points, self.graph, self.start, vectors, beam, settings.expand)
        out = []
        for query, near, far in zip(wanted, found, dist):
            near, far = near[near >= 0], np.sqrt(far[near >= 0])
            # All points as near as the last one wanted may hold a smaller id.
            last = far[min(k, len(far) - 1)]
            near, far = near[far <= last], far[far <= last]
            vec = np.concatenate([self.ids[self.first[p] : self.first[p + 1]] for p in near])
            score = np.repeat(far, self.n_ids[near])
            other = vec != query
            out.append(pd.DataFrame({"query_id": query, "vec_id": vec[other], "score": score[other]}))
        return pd.concat(out)


def search(index: DataFrame, queries: DataFrame, k: int, settings: GraphSettings = SETTINGS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest by Euclidean distance.

    ``queries`` (vec_id, embedding); a query's own id is no answer. The index must keep
    ``k + 1`` ids or more per point. Ties go to the smaller id; where fewer than ``k``
    others exist there are fewer rows. Vectors of another length are not compared. An id
    with several vectors is asked with each and answered with the nearest of all.

    A task reads a shard once and holds it while the blocks of queries pass.
    """
    rows = queries.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("vector")).withColumn("dims", F.size("vector"))
    rows = rows.select("dims", "vec_id", "vector").distinct()
    # Blocks of queries, each one row, by hash: about ``batch`` of them together.
    rows = written(rows, "queries")
    blocks = max(1, math.ceil(rows.count() / settings.batch))
    shards, most = index.agg(F.count("*"), F.max("shard")).first()
    packed = rows.groupBy("dims", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("vec_id", "vector")).alias("queries")
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most or 0).cast("long"))).alias("shard")
    packed = packed.select("dims", every, "block", "queries")
    # The row of a shard, its block -1, comes before all blocks of queries.
    both = index.withColumn("block", F.lit(-1).cast("long")).unionByName(packed, allowMissingColumns=True)
    work = both.repartition(max(1, shards), "dims", "shard").sortWithinPartitions("dims", "shard", "block")

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            for row in frame.itertuples():
                if row.block < 0:
                    held = Shard(row, settings)
                elif held is not None and held.key == (row.dims, row.shard):
                    yield held.nearest(row.queries, k, settings)

    found = work.mapInPandas(look, "query_id long, vec_id long, score double")
    # An id that comes with several vectors counts with its nearest.
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int, settings: GraphSettings = SETTINGS) -> DataFrame:
    """``search`` of ``queries`` over a fresh index of ``vectors``.

    Vectors that are null, zero or hold a null, NaN or infinite component take no part,
    nor do rows without id; an empty table gives no rows. Columns other than vec_id and
    embedding are not read. An id that comes with several vectors counts with its nearest.
    """
    return search(build_index(vectors, k + 1, settings), queries, k, settings)
