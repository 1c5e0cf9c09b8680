"""Exact top-k inner product search by no-random-access aggregation.

A block of vectors is turned into its principal axes; each axis is a list sorted
by value.  A query reads every list sequentially from its better end (from the
top where its own component is positive, from the bottom where it is negative),
a part at a time.  What it has read of a vector is its known sum; an unread
component counts as the list's worst value for the lower bound and as the value
that the list has reached for the upper one.  Reading stops as soon as at most
``few`` vectors have upper bounds that reach the k-th best lower bound; their
final scores are then resolved in whole numbers.  The axes only serve the
bounds, which are widened by more than their rounding, so the result is exact,
ties included.

Queries are a stated set against all rows, in blocks: each block of candidates
meets each block of queries once, in a task that holds one of either.  The k
best of each block are ranked again over all blocks.

Defined results: vectors that are null or hold null, NaN or infinite components
take no part, nor do rows without an id; rows that share an id are candidates
each, but none of them for queries of that id, and ask each on its own; equal
rows are worked out once and count each, as candidates and as queries; vectors only meet vectors of their own
length; an empty table gives an empty result; further columns are ignored.
Scores are exact while they fit into 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SCALE = 1024


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, and neither null nor NaN nor infinite in any component."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))


class Lists:
    """A block of vectors as sorted lists along its principal axes."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        exact = x.astype(np.float64)
        scale = max(1.0, float(np.abs(exact).max(initial=0)))
        _, self.axes = np.linalg.eigh((exact / scale).T @ (exact / scale)) if x.size else (None, np.eye(x.shape[1]))
        self.along = exact @ self.axes
        self.order = np.argsort(self.along, axis=0, kind="stable").astype(np.int32)
        self.slack = 1e-9 * float(np.sqrt((exact * exact).sum(axis=1)).max(initial=0))

    def read(self, queries: np.ndarray, allowed: np.ndarray, k: int, few: int) -> Iterator[tuple[int, np.ndarray, int]]:
        """(query, rows among which its k best allowed ones are, how far it read the lists), as queries come to their end.

        Queries read side by side: what has been read of a list is the same for
        all that read it from the same end.
        """
        n, d = self.x.shape
        weights = queries.astype(np.float64) @ self.axes
        slack = self.slack * np.sqrt((weights * weights).sum(axis=1)) + 1e-9
        up, down = np.maximum(weights, 0).T.copy(), np.minimum(weights, 0).T.copy()
        least, most = self.along.min(axis=0, initial=np.inf)[:, None], self.along.max(axis=0, initial=-np.inf)[:, None]
        waiting, known, unread = np.arange(len(queries)), np.zeros((n, len(queries))), np.ones((n, 2 * d))
        depth, part = 0, max(n // 32, 1)
        open_ = allowed.copy()
        while len(waiting):
            done = (open_.sum(axis=0) <= few) | (depth >= n)
            for i in np.flatnonzero(done):
                yield int(waiting[i]), np.flatnonzero(open_[:, i]), depth
            if done.any():
                rest = ~done
                waiting, slack, known, open_, up, down = waiting[rest], slack[rest], known[:, rest], open_[:, rest], up[:, rest], down[:, rest]
                if not len(waiting):
                    return
            end = min(depth + part, n)
            for j in range(d):  # the next rows of each list, from its top and from its bottom
                for rows, w, place in ((self.order[n - end : n - depth, j], up[j], j), (self.order[depth:end, j], down[j], d + j)):
                    known[rows] += np.outer(self.along[rows, j], w)
                    unread[rows, place] = 0
            depth, part = end, part * 2
            places = np.arange(d)
            top, bottom = self.along[self.order[n - depth], places][:, None], self.along[self.order[depth - 1], places][:, None]
            lower = known + unread @ np.concatenate([up * least, down * most]) - slack
            upper = known + unread @ np.concatenate([up * top, down * bottom]) + slack
            lower[~allowed[:, waiting]] = -np.inf
            open_ &= upper >= np.partition(lower, max(n - k, 0), axis=0)[max(n - k, 0)]  # whoever cannot qualify now cannot later


def nra_block(x: np.ndarray, ids: np.ndarray, q: np.ndarray, query_ids: np.ndarray, k: int, few: int = 64, together: int = 128) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(place of the query, rows, scores, depth read) of the k best rows of ``x`` for each row of ``q``, best first, ties to the smaller id."""
    lists = Lists(x)
    for first in range(0, len(q), together):
        part, part_ids = q[first : first + together], query_ids[first : first + together]
        for i, rows, depth in lists.read(part, ids[:, None] != part_ids[None, :], k, few):
            scores = x[rows] @ part[i]
            order = np.lexsort((ids[rows], -scores))[:k]
            yield first + i, rows[order], scores[order], depth


def _matrix(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    column = table.column("v").combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim).astype(np.int64, copy=False), table.column("id").to_numpy()


def nra_topk(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 8192, query_block_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every row that ``is_query`` selects.

    ``block_rows`` and ``query_block_rows`` bound what one task holds; they do
    not change the result.
    """
    rows = vectors.count()
    n_blocks = max(1, -(-rows // block_rows))
    usable_rows = (
        vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
        .select(F.col(id_col).cast("long").alias("id"), is_query.alias("asks"), quantized(F.col(vector_col)).alias("v"))
        .groupBy("id", "v")
        .agg(F.count("*").alias("n"), F.max("asks").alias("asks"))
        .withColumn("dim", F.size("v"))
    )
    asking = usable_rows.filter("asks")
    n_query_blocks = max(1, -(-vectors.filter(is_query).count() // query_block_rows))
    block = F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("id", "v"), F.lit(n_query_blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = usable_rows.select("dim", "id", "n", "v", block.alias("block"), every(n_query_blocks).alias("query_block"))
    right = asking.select("dim", "id", "n", "v", F.xxhash64("v").alias("which"), query_block.alias("query_block"), every(n_blocks).alias("block"))
    out = pa.schema([(c, pa.int64()) for c in ("query_id", "which", "asked", "vec_id", "score", "n")])

    def work(key: tuple, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(candidates) or not len(queries):
            return out.empty_table()
        dim = key[0].as_py()
        (x, ids), (q, query_ids) = _matrix(candidates, dim), _matrix(queries, dim)
        copies, asked, which = candidates.column("n").to_numpy(), queries.column("n").to_numpy(), queries.column("which").to_numpy()
        same = lambda value, at: np.full(len(at), value)
        found = [(same(query_ids[i], at), same(which[i], at), same(asked[i], at), ids[at], scores, copies[at]) for i, at, scores, _ in nra_block(x, ids, q, query_ids, k)]
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)], schema=out)

    keys = ["dim", "query_block", "block"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, "query_id long, which long, asked long, vec_id long, score long, n long")
    each = best.withColumn("n", F.explode(F.array_repeat(F.lit(1), F.least("n", F.lit(k)).cast("int"))))  # equal rows count each
    ranked = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), F.asc("vec_id"))
    answers = each.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return answers.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), "asked"))).select("query_id", "rank", "vec_id", "score")
