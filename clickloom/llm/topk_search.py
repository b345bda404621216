"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into segments of which mean and deviation are kept, at several
resolutions.  For a segment of n components, n (mean difference squared + deviation
difference squared) never exceeds the squared distance of the two pieces; with the norms
known, that lower bound on the distance is an upper bound on the inner product,
n (mean * mean + deviation * deviation).  Candidates are bounded coarse to fine, and only
those that may still reach a query's k-th best score are multiplied out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.scratch import stored

K = 20
SCALE = 64
# Vectors and queries of one task.  The number of tasks grows with their product, and none
# holds more than this.
CANDIDATES = 8192
QUERIES = 1024
RESOLUTIONS = (4, 8, 16)
_AT_ONCE = 128


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as bigint."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & finite


class Segments:
    """Means and deviations of rows of equal length, scaled so that a product of two rows
    of statistics is the bound."""

    def __init__(self, rows: np.ndarray):
        self.levels = [self._statistics(rows, min(n, rows.shape[1])) for n in RESOLUTIONS]

    @staticmethod
    def _statistics(rows: np.ndarray, count: int) -> np.ndarray:
        cuts = np.linspace(0, rows.shape[1], count + 1).astype(int)[:-1]
        sizes = np.diff(np.append(cuts, rows.shape[1]))
        mean = np.add.reduceat(rows, cuts, axis=1) / sizes
        deviation = np.sqrt(np.add.reduceat((rows - np.repeat(mean, sizes, 1)) ** 2, cuts,
                                            axis=1) / sizes)
        return np.concatenate([mean, deviation], 1) * np.sqrt(np.tile(sizes, 2))


def best(queries: np.ndarray, candidates: np.ndarray, ids: np.ndarray, skip: np.ndarray,
         k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, scores) of each query's k best candidates, ties to the smaller id.

    ``queries`` and ``candidates`` are rows of integers; ``skip`` has the position of the
    query among the candidates, or -1.
    """
    if not queries.shape[1]:
        queries, candidates = (np.zeros((len(x), 1), np.int64) for x in (queries, candidates))
    largest = int(np.abs(queries.astype(float)).max(initial=0)
                  * np.abs(candidates.astype(float)).max(initial=0)) * queries.shape[1]
    kind = np.float64 if largest < 2 ** 52 else object
    q, c = queries.astype(kind), candidates.astype(kind)
    coarse_q, coarse_c = (Segments(x.astype(np.float64)) for x in (queries, candidates))
    # What rounding may take from a bound.
    room = 1e-9 * max(1.0, float(largest))
    out = []
    for first in range(0, len(q), _AT_ONCE):
        bounds = coarse_q.levels[0][first:first + _AT_ONCE] @ coarse_c.levels[0].T
        for i, bound in enumerate(bounds, first):
            own = int(skip[i])
            alive = np.ones(len(c), bool)
            if own >= 0:
                alive[own] = False
            floor = None
            if alive.sum() > 4 * k:
                # The k-th score of the most promising is a floor that the others must reach.
                likely = np.argpartition(np.where(alive, -bound, np.inf), 4 * k)[:4 * k]
                floor = np.sort((c[likely] @ q[i]).astype(float))[-k]
            left = np.flatnonzero(alive if floor is None else alive & (bound + room >= floor))
            for query, level in zip(coarse_q.levels[1:], coarse_c.levels[1:]):
                if floor is None or not len(left):
                    break
                left = left[level[left] @ query[i] + room >= floor]
            scores = c[left] @ q[i]
            if kind is object:
                scores = np.array([max(-2 ** 63, min(2 ** 63 - 1, int(s))) for s in scores],
                                  np.int64)
            if len(left) > k:
                least = np.partition(scores, len(left) - k)[len(left) - k]
                left, scores = left[scores >= least], scores[scores >= least]
            order = np.lexsort((ids[left], -scores.astype(np.int64)))[:k]
            out.append((left[order], scores[order].astype(np.int64)))
    return out


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(table.num_rows, dim)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = SCALE, per_task: int = CANDIDATES,
          queries_per_task: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for every query row.

    ``is_query`` is a condition on ``vec_id``.  Vectors that are null or hold a null or
    non-finite component take no part; vectors of different length are not compared.  A
    row is no candidate of itself, but a repeated row is one of its copy.  A null id is a
    candidate (last among ties), never a query.  Scores outside 64 bits are held at its
    ends.  With fewer than k candidates, all are returned; no queries, no result.
    """
    vector = F.col(vector_col)
    rows = stored(vectors.where(usable(vector)).select(
        F.col(id_col).cast("bigint").alias("vec_id"), quantised(vector, scale).alias("v"),
        F.size(vector).alias("dim"), F.monotonically_increasing_id().alias("row")),
        "topk-vectors")
    asked = rows.where(F.coalesce(is_query, F.lit(False)))
    counted = rows.agg(F.count("*"), F.count_if(F.coalesce(is_query, F.lit(False)))).first()
    groups, blocks = (max(1, -(-n // size)) for n, size in
                      zip(counted, (per_task, queries_per_task)))

    # A grid of (candidate group, query block); each cell is one task's work.
    spread = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("b", spread(blocks)).withColumn("g", every(groups))
    right = rows.withColumn("g", spread(groups)).withColumn("b", every(blocks))

    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        names = ["query_row", "query_id", "vec_id", "score"]
        if not queries.num_rows or not candidates.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names)
        dim = queries.column("dim")[0].as_py()
        column = lambda t, c: t.column(c).to_numpy()
        query_row, row = column(queries, "row"), column(candidates, "row")
        ids = candidates.column("vec_id").fill_null(2 ** 63 - 1).to_numpy()
        place = {r: i for i, r in enumerate(row.tolist())}
        skip = np.array([place.get(r, -1) for r in query_row.tolist()])
        found = best(_matrix(queries, dim), _matrix(candidates, dim), ids, skip, k)
        sizes = [len(at) for at, _ in found]
        at = np.concatenate([at for at, _ in found])
        return pa.table([
            pa.array(np.repeat(query_row, sizes)),
            queries.column("vec_id").take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
            candidates.column("vec_id").take(pa.array(at)),
            pa.array(np.concatenate([s for _, s in found]))], names)

    found = (left.groupBy("dim", "g", "b").cogroup(right.groupBy("dim", "g", "b"))
             .applyInArrow(search, "query_row bigint, query_id bigint, vec_id bigint, score bigint"))
    order = W.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
