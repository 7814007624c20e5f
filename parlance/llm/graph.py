"""Nearest neighbours by robust-pruned directed graphs, one for each shard of the vectors.

Vectors are dealt to shards of about ``SHARD`` by a hash. In a shard a graph is built in rounds over
batches of points: greedy beam searches from the most central point propose neighbours, relaxed
pruning keeps a candidate only if no kept one is closer to it by the factor ``alpha``, and kept edges
are offered in return and pruned where a list is full. Searches run for many points at a time.

A query is a beam search in every shard; queries are dealt out in blocks, so no task holds more than
one shard and one block. Results are exact distances in double precision on the original vectors, and
which rows are found is the only thing the graph decides. Equal vectors are one point; its rows come
back in the order of their ids, so ties are exact.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and rows with a
null vec_id, take no part; vectors of different lengths never meet; repeated rows are one row; fewer
candidates than ``k`` are all returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.cap_filters import usable
from parlance.llm.common import Stored

SHARD = 4096
QUERY_BLOCK = 2048
DEGREE = 32
BUILD_BEAM, SEARCH_BEAM = 48, 160
WIDTH = 4  # points of a beam that one step expands
BATCH = 256
ALPHAS = (1.0, 1.2)


class Graph:
    """A directed graph over points; neighbour lists have ``degree`` places, -1 where free."""

    def __init__(self, points: np.ndarray, neighbours: np.ndarray | None = None, entry: int | None = None, seed: int = 1):
        self.points = np.ascontiguousarray(points, dtype=np.float32)
        self.norms = (self.points**2).sum(1)
        n = len(points)
        center = self.points.mean(0)
        self.entry = int(((self.points - center) ** 2).sum(1).argmin()) if entry is None else entry
        self.neighbours = np.full((n, DEGREE), -1, dtype=np.int32) if neighbours is None else neighbours
        self.rng = np.random.default_rng(seed)

    def distances(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its own row of ids."""
        dots = np.einsum("bd,bcd->bc", queries, self.points[ids], optimize=True)
        return np.maximum(self.norms[ids] - 2 * dots + (queries**2).sum(1)[:, None], 0)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all queries together: ids and squared distances, nearest first, padded by -1."""
        b, n = len(queries), len(self.points)
        beam = min(beam, n)
        row = np.arange(b)[:, None]
        ids = np.full((b, beam), -1, dtype=np.int64)
        dist = np.full((b, beam), np.inf, dtype=np.float32)
        done = np.ones((b, beam), dtype=bool)
        seen = np.zeros((b, n + 1), dtype=bool)  # the last column stands for "no point"
        seen[:, n] = True
        ids[:, 0], done[:, 0] = self.entry, False
        dist[:, 0] = self.distances(queries, ids[:, :1])[:, 0]
        seen[:, self.entry] = True
        while not done.all():
            at = np.argsort(done, axis=1, kind="stable")[:, :WIDTH]
            open_ = ~done[row, at]
            done[row, at] = True
            new = np.where(open_[:, :, None], self.neighbours[np.where(open_, ids[row, at], 0)], -1).reshape(b, -1).astype(np.int64)
            new[new < 0] = n
            new.sort(axis=1)
            fresh = ~seen[row, new]
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            seen[row, new] = True
            d = np.where(fresh, self.distances(queries, np.where(fresh, new, 0)), np.inf).astype(np.float32)
            all_ids, all_dist = np.concatenate([ids, np.where(fresh, new, -1)], 1), np.concatenate([dist, d], 1)
            all_done = np.concatenate([done, ~fresh], 1)
            order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
            ids, dist, done = all_ids[row, order], all_dist[row, order], all_done[row, order]
        return ids, dist

    def prune(self, of: np.ndarray, candidates: np.ndarray, alpha: float) -> np.ndarray:
        """Diverse neighbours of each point in ``of`` from its row of candidates (-1: none)."""
        row = np.arange(len(of))
        candidates = np.sort(candidates, axis=1)
        bad = (candidates < 0) | (candidates == of[:, None])
        bad[:, 1:] |= candidates[:, 1:] == candidates[:, :-1]
        safe = np.where(bad, 0, candidates)
        x = self.points[safe]
        own = np.where(bad, np.inf, self.distances(self.points[of], safe))
        norms = self.norms[safe]
        between = norms[:, :, None] + norms[:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
        out = np.full((len(of), DEGREE), -1, dtype=np.int32)
        left = own.copy()
        for k in range(DEGREE):
            best = left.argmin(1)
            found = np.isfinite(left[row, best])
            if not found.any():
                break
            out[found, k] = safe[row, best][found]
            covered = (alpha * alpha) * np.maximum(between[row, best], 0) <= own
            left[covered & found[:, None]] = np.inf
            left[row, best] = np.inf
        return out

    def _offer(self, sources: np.ndarray, alpha: float) -> None:
        """Give every neighbour of the sources the edge back."""
        pairs = np.stack([self.neighbours[sources].ravel(), np.repeat(sources, DEGREE)], 1)
        pairs = pairs[pairs[:, 0] >= 0]
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        targets, begin, counts = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        for lot in np.array_split(np.argsort(counts, kind="stable"), max(1, len(targets) // 256)):
            if not len(lot):
                continue
            width = int(counts[lot].max())
            at = begin[lot][:, None] + np.arange(width)
            offered = np.where(np.arange(width) < counts[lot][:, None], pairs[np.minimum(at, len(pairs) - 1), 1], -1)
            both = np.concatenate([self.neighbours[targets[lot]], offered], 1)
            self.neighbours[targets[lot]] = self.prune(targets[lot], both, alpha)

    def build(self) -> Graph:
        n = len(self.points)
        if n > 1:
            start = self.rng.integers(0, n, (n, min(DEGREE // 2, n - 1)))
            self.neighbours[:, : start.shape[1]] = np.where(start == np.arange(n)[:, None], -1, start)
            for alpha in ALPHAS:
                order = self.rng.permutation(n)
                for begin in range(0, n, BATCH):
                    batch = order[begin : begin + BATCH]
                    near, _ = self.search(self.points[batch], BUILD_BEAM)
                    self.neighbours[batch] = self.prune(batch, np.concatenate([near, self.neighbours[batch]], 1), alpha)
                    self._offer(batch, alpha)
        return self


def build_index(vectors: DataFrame, shards: int) -> DataFrame:
    """One row for each shard and vector length: size, shard, ids, points, neighbours, entry."""

    def build(table: pa.Table) -> pa.Table:
        x = np.array(table.column("embedding").to_pylist(), dtype=np.float64)
        made = Graph(x, seed=int(table.column("shard")[0].as_py()) + 1).build()
        columns = {
            "size": pa.array([x.shape[1]], pa.int32()),
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
            "ids": pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
            "points": pa.array([x.tobytes()], pa.binary()),
            "neighbours": pa.array([made.neighbours.tobytes()], pa.binary()),
            "entry": pa.array([made.entry], pa.int32()),
        }
        return pa.table(columns)

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    schema = "size int, shard int, ids binary, points binary, neighbours binary, entry int"
    return dealt.select("size", "shard", "id", "embedding").groupBy("size", "shard").applyInArrow(build, schema)


def search_index(index: DataFrame, queries: DataFrame, shards: int, blocks: int, k: int) -> DataFrame:
    """(query, id, score): the nearest points of every shard for each query (id, size, embedding)."""

    def find(graphs: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if graphs.num_rows and asked.num_rows:
            g = {name: graphs.column(name)[0].as_py() for name in ("size", "ids", "points", "neighbours", "entry")}
            ids = np.frombuffer(g["ids"], dtype=np.int64)
            points = np.frombuffer(g["points"], dtype=np.float64).reshape(len(ids), g["size"])
            made = Graph(points, np.frombuffer(g["neighbours"], dtype=np.int32).reshape(len(ids), DEGREE), g["entry"])
            names = asked.column("id").to_numpy()
            x = np.array(asked.column("embedding").to_pylist(), dtype=np.float64)
            for begin in range(0, len(x), BATCH):
                part = x[begin : begin + BATCH]
                near, dist = made.search(part.astype(np.float32), max(SEARCH_BEAM, 2 * k))
                near = near[:, : 2 * k]  # room for what single precision may have put in another order
                row, at = np.nonzero(near >= 0)
                hit = near[row, at]
                score = np.sqrt(((part[row] - points[hit]) ** 2).sum(1))
                out.append((names[begin + row], ids[hit], score))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query": columns[0], "id": columns[1], "score": columns[2]})

    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    asked = queries.select("size", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"), "id", "embedding")
    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["size", "shard", "block"]
    return graphs.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(find, "query bigint, id bigint, score double")


def nearest(embeddings: DataFrame, every: int, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of each row whose id ``every`` divides."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = Stored(rows, "graph-vectors").df
    points = rows.groupBy("embedding").agg(F.min("vec_id").alias("id"))
    points = Stored(points.select("id", F.size("embedding").alias("size"), "embedding"), "graph-points").df
    named = Stored(rows.join(points.select("embedding", "id"), "embedding").select("id", "vec_id").distinct(), "graph-members").df
    asked = Stored(named.where(F.col("vec_id") % every == 0), "graph-queries").df
    n, q = points.count(), asked.select("id").distinct().count()
    shards, blocks = max(1, math.ceil(n / SHARD)), max(1, math.ceil(q / QUERY_BLOCK))
    index = Stored(build_index(points, shards), "graph-index", "uncompressed").df
    queries = points.join(asked.select("id").distinct(), "id")
    found = search_index(index, queries, shards, blocks, k)
    best = Window.partitionBy("query").orderBy("score", "id")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    smallest = Window.partitionBy("id").orderBy("vec_id")
    members = named.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1).select("id", "vec_id")
    pairs = found.select("query", "id", "score").join(members, "id")
    pairs = pairs.join(asked.select(F.col("id").alias("query"), F.col("vec_id").alias("query_id")), "query").where("query_id <> vec_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
