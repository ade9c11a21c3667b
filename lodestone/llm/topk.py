"""Exact top-k inner products by MaxScore, over shards.

Each dimension is a query term, its posting list in a shard the column of that dimension, and its bounds the least and
the largest contribution that any vector of the shard can make. Terms are ordered by what they can change. The
essential ones are the fewest without which no vector can reach the k-th best score known; their postings are traversed
in full, and the others are probed, a few at a time, only for vectors that are still competitive. The best of each
shard are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import settle

SHARD, QUERIES = 8192, 8192  # vectors and queries of a task, about
SCALE = 256
LIMIT = 1 << 63  # a quantised component must be a long, and so must a score
_PROBE = 8
_LAST = np.iinfo(np.int64).max


def quantised(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, q`` (``floor(256 * x)`` as longs), without vectors that are null or hold null or non-finite components.

    A component that does not fit in a long fails the job.
    """
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    wide = lambda x: F.abs(x.cast("double") * SCALE) >= F.lit(float(LIMIT))
    level = lambda x: F.when(wide(x), F.raise_error(F.lit("a component is too large to quantise")).cast("bigint")).otherwise(F.floor(x.cast("double") * SCALE))
    some = vectors.select("vec_id", F.when(F.coalesce(fine, F.lit(False)), F.transform(vector, level)).alias("q"))
    return some.where("q is not null")


class Shard:
    """Columns of a shard's vectors (``n x d`` integers) with the bounds of each."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.n = len(vectors)
        self.exact = float  # sums below 2**53 are exact in doubles
        self.peak = float(np.abs(vectors.astype(float)).max(initial=1))
        if self.peak**2 * vectors.shape[1] >= 1 << 53:
            self.exact = np.int64
        self.columns = np.ascontiguousarray(vectors.T).astype(self.exact)
        none = np.zeros(vectors.shape[1], dtype=self.exact)
        self.low = self.columns.min(axis=1) if self.n else none
        self.high = self.columns.max(axis=1) if self.n else none

    def best(self, query: np.ndarray, own: int, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best, place ``own`` left out; ties go to the smaller id."""
        reach = float(np.abs(query.astype(float)).sum()) * self.peak
        if reach >= 1 << 62:
            return self._wide(query, own, ids, k)
        q = query.astype(self.exact)
        if self.exact is float and reach >= 1 << 53:
            wide = Shard.__new__(Shard)
            wide.n, wide.exact, wide.peak = self.n, np.int64, self.peak
            wide.columns, wide.low, wide.high = (x.astype(np.int64) for x in (self.columns, self.low, self.high))
            return wide.best(query, own, ids, k)
        least, most = np.minimum(q * self.low, q * self.high), np.maximum(q * self.low, q * self.high)
        order = np.argsort(least - most, kind="stable")
        rest = np.append(np.cumsum(most[order][::-1])[::-1], 0)  # the most that terms from here on can add
        floor = np.append(0, np.cumsum(least[order]))
        threshold = self._threshold(q, order, own, k)
        if threshold is None:
            alive, done = np.arange(self.n), 0
            partial = np.zeros(self.n, dtype=self.exact)
        else:
            done = int(np.argmax(floor + rest < threshold)) if (floor + rest < threshold).any() else len(order)
            partial = q[order[:done]] @ self.columns[order[:done]] if done else np.zeros(self.n, dtype=self.exact)
            alive = np.flatnonzero(partial + rest[done] >= threshold)
            partial = partial[alive]
        while done < len(order):
            terms = order[done : done + _PROBE]
            partial = partial + q[terms] @ self.columns[np.ix_(terms, alive)]
            done += len(terms)
            if threshold is not None:
                kept = partial + rest[min(done, len(order))] >= threshold
                alive, partial = alive[kept], partial[kept]
        if own >= 0:
            other = alive != own
            alive, partial = alive[other], partial[other]
        top = np.lexsort((ids[alive], -partial))[:k]
        return alive[top], partial[top].astype(np.int64)

    def _wide(self, query: np.ndarray, own: int, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``best`` in integers of any size, where a sum could pass a long; a score that does fails the job."""
        q = query.astype(np.int64).tolist()
        scores = [sum(a * b for a, b in zip(q, v, strict=True)) for v in self.columns.astype(np.int64).T.tolist()]
        top = sorted((i for i in range(self.n) if i != own), key=lambda i: (-scores[i], ids[i]))[:k]
        if any(not -LIMIT <= scores[i] < LIMIT for i in top):
            raise OverflowError("a score does not fit in a long")
        return np.array(top, dtype=np.int64), np.array([scores[i] for i in top], dtype=np.int64)

    def _threshold(self, q: np.ndarray, order: np.ndarray, own: int, k: int):
        """The k-th best score of a few vectors that are strong in the strongest term; none if the shard has too few."""
        if self.n <= 4 * k or not len(order):
            return None
        lead = self.columns[order[0]] * q[order[0]]
        some = np.argpartition(-lead, 4 * k - 1)[: 4 * k]
        some = some[some != own]
        scores = q @ self.columns[:, some]
        return np.sort(scores)[-k]


def _matrix(table: pa.Table, name: str, dim: int) -> np.ndarray:
    column = table.column(name).combine_chunks()
    flat = column.flatten() if isinstance(column, pa.ListArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(table), dim)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best other rows of ``vectors`` (``vec_id, embedding``).

    ``is_query`` is worked out on ``vec_id``. The score is the integer inner product of the quantised vectors; ties go to
    the smaller ``vec_id`` (null last). Only vectors of the query's own length are compared with it. Vectors that
    ``quantised`` leaves out take no part. Repeated rows are rows of their own. An empty table gives no rows.

    Each task gets one stretch of vectors and one of queries, both of bounded size, whatever the table's.
    """
    rows = settle(
        quantised(vectors).select("vec_id", "q", F.size("q").alias("dim"), F.monotonically_increasing_id().alias("row")), "vectors"
    ).withColumn("asks", F.coalesce(is_query, F.lit(False)))
    counts = rows.groupBy("dim").agg(
        F.ceil(F.count("*") / SHARD).cast("int").alias("shards"), F.greatest(F.ceil(F.count_if("asks") / QUERIES), F.lit(1)).cast("int").alias("blocks")
    )
    placed = rows.join(counts, "dim")
    held = placed.select(
        "dim", F.pmod(F.xxhash64("row"), F.col("shards")).alias("shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "row", "vec_id", "q"
    )
    asked = placed.where("asks").select(
        F.col("dim").alias("a_dim"), F.explode(F.sequence(F.lit(0).cast("long"), (F.col("shards") - 1).cast("long"))).alias("a_shard"), F.pmod(F.xxhash64("row", F.lit(1)), F.col("blocks")).cast("int").alias("a_block"),
        F.col("row").alias("asker"), F.col("vec_id").alias("query_id"), F.col("q").alias("query"),
    )

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"asker": [], "query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            dim = left.column("dim")[0].as_py()
            numbers = left.column("vec_id").to_pylist()
            ids = np.array([_LAST if x is None else x for x in numbers], dtype=np.int64)
            place = {r: i for i, r in enumerate(left.column("row").to_pylist())}
            shard = Shard(_matrix(left, "q", dim))
            for row, name, query in zip(right.column("asker").to_pylist(), right.column("query_id").to_pylist(), _matrix(right, "query", dim), strict=True):
                at, scores = shard.best(query, place.get(row, -1), ids, k)
                out["asker"] += [row] * len(at)
                out["query_id"] += [name] * len(at)
                out["vec_id"] += [numbers[i] for i in at]
                out["score"] += scores.tolist()
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    parts = held.groupBy("dim", "shard", "block").cogroup(asked.groupBy("a_dim", "a_shard", "a_block")).applyInArrow(work, "asker bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("asker").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
