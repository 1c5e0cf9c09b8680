"""Lloyd's clustering in whole numbers with Drake's adaptive bounds.

Every vector keeps an upper bound of the distance to its own centroid, lower
bounds for its several next nearest ones, and one lower bound for all that
remain.  When centroids move, bounds widen by how far they moved.  A vector whose
upper bound stays below all lower ones keeps its centroid without a distance
being worked out; else the own distance is made exact; if it is still not below
the bound of the rest all centroids are scanned, and if it is not below those of
stored neighbours these are worked out.  Bounds are widened by more than their rounding and hold strictly, so
ties are always settled by exact squared distances and the smaller number: the
result is that of plain scans.  How many neighbours are stored adapts: after each
round no more than the round before has needed, and at least ``min_bounds``.

Vectors and bounds travel together as a table in the shared folder, one per
round; rows are never shuffled.  New centroids are sums per cluster, combined
before the shuffle; only the centroids (``k`` rows) reach the driver.

Defined results: vectors that are null, of another length, or hold null, NaN or
infinite components take no part; a row without an id does, but starts no
centroid while rows with ids are left; rows that repeat an id or are equal count
each; with fewer than ``k`` vectors there are as many centroids; an empty table
gives an empty result; further columns are ignored.  Sums and squared distances
are exact while they fit into 64 bits; sums beyond raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackforge.llm.common import written
from trackforge.llm.topk import quantized, usable

STATE = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("v", pa.list_(pa.int64())),
        ("cluster", pa.int32()),
        ("upper", pa.float64()),
        ("near", pa.list_(pa.int32())),
        ("lower", pa.list_(pa.float64())),
        ("rest", pa.float64()),
        ("distance", pa.int64()),
        ("needed", pa.int32()),
        ("worked_out", pa.int32()),
    ]
)
STATE_DDL = "vec_id long, v array<long>, cluster int, upper double, near array<int>, lower array<double>, rest double, distance long, needed int, worked_out int"


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    reach = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)), 1)
    if 4 * x.shape[1] * reach * reach < 1 << 53:  # every sum is a whole number that a double holds
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (a @ c.T)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def squared_to(x: np.ndarray, centroids: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row to the centroids named in its row of ``which``."""
    return np.stack([((x - centroids[which[:, i]]) ** 2).sum(axis=1) for i in range(which.shape[1])], axis=1)


class Bounds:
    """A batch of vectors with their centroids and bounds."""

    def __init__(self, x: np.ndarray, centroids: np.ndarray, n_bounds: int) -> None:
        self.x, self.centroids = x, centroids
        self.n_bounds = min(n_bounds, len(centroids) - 1)
        n = len(x)
        self.own = np.zeros(n, np.int32)
        self.upper, self.rest = np.zeros(n), np.zeros(n)
        self.near, self.lower = np.zeros((n, self.n_bounds), np.int32), np.zeros((n, self.n_bounds))
        self.needed, self.worked_out = np.zeros(n, np.int32), np.zeros(n, np.int32)

    def scan(self, rows: np.ndarray) -> None:
        """All distances of these rows, and from them everything that is stored."""
        if not len(rows):
            return
        found = squared(self.x[rows], self.centroids)
        order = np.argsort(found, axis=1, kind="stable")  # ties: the smaller number
        far = np.sqrt(np.take_along_axis(found, order, axis=1).astype(np.float64))
        b = self.n_bounds
        self.own[rows], self.upper[rows] = order[:, 0], far[:, 0]
        self.near[rows], self.lower[rows] = order[:, 1 : b + 1], far[:, 1 : b + 1]
        self.rest[rows] = far[:, b + 1] if far.shape[1] > b + 1 else np.inf
        self.needed[rows] = b
        self.worked_out[rows] += len(self.centroids)

    def move(self, moved: np.ndarray) -> None:
        """Centroids have moved so far: settle every row, exactly."""
        others = np.repeat(moved[None, :], len(self.x), axis=0)
        np.put_along_axis(others, np.concatenate([self.own[:, None], self.near], axis=1), 0, axis=1)
        self.upper += moved[self.own]
        self.lower -= moved[self.near]
        self.rest -= others.max(axis=1, initial=0)
        slack = 1e-9 * (1 + self.upper)
        least = np.minimum(self.lower.min(axis=1, initial=np.inf), self.rest)
        open_ = np.flatnonzero(self.upper + slack >= least)
        if not len(open_):
            return
        own = squared_to(self.x[open_], self.centroids, self.own[open_][:, None])[:, 0]
        self.upper[open_] = np.sqrt(own.astype(np.float64))
        self.worked_out[open_] += 1
        beyond = self.upper[open_] + slack[open_] >= self.rest[open_]
        self.scan(open_[beyond])  # one that is not stored may be as near
        among = ~beyond & (self.upper[open_] + slack[open_] >= least[open_])  # whichever is nearest is stored
        open_, own = open_[among], own[among]
        if not len(open_) or not self.n_bounds:
            return
        reached = self.lower[open_] <= (self.upper[open_] + slack[open_])[:, None]
        self.needed[open_] = np.where(reached, np.arange(1, self.n_bounds + 1), 0).max(axis=1, initial=0)
        known = np.concatenate([self.own[open_][:, None], self.near[open_]], axis=1)
        found = np.concatenate([own[:, None], squared_to(self.x[open_], self.centroids, self.near[open_])], axis=1)
        self.worked_out[open_] += self.n_bounds
        order = np.lexsort((known, found), axis=1)
        known, far = np.take_along_axis(known, order, axis=1), np.sqrt(np.take_along_axis(found, order, axis=1).astype(np.float64))
        self.own[open_], self.upper[open_] = known[:, 0], far[:, 0]
        self.near[open_], self.lower[open_] = known[:, 1:], far[:, 1:]

    def keep(self, n_bounds: int) -> None:
        """Store only so many neighbours from now on; the others join the rest."""
        if n_bounds < self.n_bounds:
            order = np.argsort(self.lower, axis=1, kind="stable")
            self.near, self.lower = np.take_along_axis(self.near, order, axis=1), np.take_along_axis(self.lower, order, axis=1)
            self.rest = np.minimum(self.rest, self.lower[:, n_bounds:].min(axis=1, initial=np.inf))
            self.near, self.lower, self.n_bounds = self.near[:, :n_bounds], self.lower[:, :n_bounds], n_bounds


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(kind)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(values).reshape(-1), kind))


def _row(state: Bounds, ids: pa.Array, v: pa.Array) -> pa.RecordBatch:
    distance = squared_to(state.x, state.centroids, state.own[:, None])[:, 0]
    columns = [
        ids, v, pa.array(state.own), pa.array(state.upper), _lists(state.near, pa.int32()), _lists(state.lower, pa.float64()),
        pa.array(state.rest), pa.array(distance), pa.array(state.needed), pa.array(state.worked_out),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=STATE)


def first_round(vectors: DataFrame, centroids: np.ndarray, n_bounds: int) -> DataFrame:
    """The state of vec_id, v after a scan of everything."""
    dim = centroids.shape[1]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state = Bounds(_matrix(batch.column("v"), dim, np.int64), centroids, n_bounds)
            state.scan(np.arange(batch.num_rows))
            yield _row(state, batch.column("vec_id"), batch.column("v"))

    return vectors.mapInArrow(work, STATE_DDL)


def next_round(state: DataFrame, before: np.ndarray, after: np.ndarray, stored: int, n_bounds: int) -> DataFrame:
    """The state after the centroids have moved; ``stored`` bounds a row become ``n_bounds``."""
    dim = after.shape[1]
    moved = np.sqrt(np.array([float(sum(int(d) ** 2 for d in row)) for row in after - before])) * (1 + 1e-12)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = Bounds(_matrix(batch.column("v"), dim, np.int64), after, stored)
            at.own, at.upper, at.rest = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("cluster", "upper", "rest"))
            at.near, at.lower = _matrix(batch.column("near"), at.n_bounds, np.int32), _matrix(batch.column("lower"), at.n_bounds, np.float64)
            at.keep(n_bounds)
            at.move(moved)
            yield _row(at, batch.column("vec_id"), batch.column("v"))

    return state.mapInArrow(work, STATE_DDL)


def starts(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select("v", key.alias("key")).orderBy(F.asc_nulls_last("key"), "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in first], np.int64)


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: str = "1", bounds: int = 4, min_bounds: int = 2, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, list[list[int]]]:
    """Vectors with vec_id, v, cluster, distance (squared) and the bounds after ``rounds`` moves of the centroids; the centroids.

    ``worked_out`` says how many distances the last round had to work out.
    """
    x = F.col(vector_col)
    kept = vectors.filter(usable(x) & (F.size(x) == dim)).select(F.col(id_col).cast("long").alias("vec_id"), quantized(x, scale).alias("v"))
    centroids = starts(kept, k, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], STATE_DDL), []
    stored = min(bounds, len(centroids) - 1)
    state = written(first_round(kept, centroids, stored))
    for _ in range(rounds):
        sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dim)]
        found = state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("needed").alias("needed"), *sums).collect()  # k rows
        after = centroids.copy()
        for r in found:
            after[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dim)]
        keep = min(stored, max(min_bounds, max(r["needed"] for r in found)))
        state = written(next_round(state, centroids, after, stored, keep))
        centroids, stored = after, keep
    return state, centroids.tolist()


def report(state: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector."""
    sums = {r["cluster"]: r["s"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    total = sum(sums.values())
    named = [(i, sums.get(i), total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids)]
    per_cluster = state.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance", "worked_out").join(F.broadcast(per_cluster), "cluster")  # k rows
