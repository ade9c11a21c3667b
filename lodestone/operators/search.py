"""Exact nearest neighbours by squared L2 distance.

The index is only ever scanned in place. Each task keeps the best ``k`` of its own rows per query, so what is
shuffled is ``k`` rows per query and task, whatever the index holds.
"""

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..functions.vectors import has_non_zero, squared_l2
from ..sources.scratch import cut_lineage, scratch_path, settle
from .ranking import top_n

MAX_K = 20
QUERY_BYTES = 32 << 20  # of query vectors and running results in a task
_HIT_BYTES = 96  # of a running result
_MAP_BITS = 20  # of the map of wanted ids: 128 KB, however many there are
_TILE = 4 << 20  # distances worked out at a time
_DIGITS = 9  # distances that agree this far are ties, settled by id


def clamp_k(k):
    """Number of hits asked for, kept between 1 and 20; takes a number or a Column."""
    if isinstance(k, Column):
        return F.greatest(F.lit(1), F.least(k, F.lit(MAX_K)))
    return max(1, min(int(k), MAX_K))


def nearest_first() -> list[Column]:
    return [F.round("distance", _DIGITS), F.col("node_id")]


def knn_search(index: DataFrame, query: list[float], k: int = 5) -> DataFrame:
    """The ``k`` rows of the index nearest to one vector: all index columns, ``distance`` and ``rank``."""
    vector = F.lit([float(x) for x in query]).cast("array<double>")
    fits = F.size("embedding") == len(query)
    near = (
        index.withColumn("distance", F.when(fits, squared_l2(F.col("embedding"), vector)))
        .orderBy(F.round("distance", _DIGITS).asc_nulls_last(), "node_id")
        .limit(k)
        .where(F.col("distance").isNotNull())
    )
    # At most k rows are left, so one group is all there is to rank.
    return top_n(near.withColumn("_all", F.lit(0)), ["_all"], nearest_first(), k).drop("_all")


def _objects(values: pa.Array) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values.to_pylist()
    return out


class _Best:
    """Running best ``k`` per query over the batches a task sees."""

    def __init__(self, query_ids: np.ndarray, matrix: np.ndarray, k: int):
        self.query_ids, self.matrix, self.k = query_ids, matrix, k
        self.norms = np.einsum("ij,ij->i", matrix, matrix)
        self.bound = np.full(len(matrix), np.inf)
        self.q = np.empty(0, np.int64)
        self.dist = np.empty(0)
        self.ids = np.empty(0, object)

    def add(self, ids: pa.Array, vectors: np.ndarray) -> None:
        norms = np.einsum("ij,ij->i", vectors, vectors)
        rows = max(1, _TILE // max(1, len(vectors)))
        for lo in range(0, len(self.matrix), rows):
            self._tile(slice(lo, lo + rows), ids, vectors, norms)

    def _tile(self, part: slice, ids, vectors, norms) -> None:
        block = self.matrix[part]
        rough = self.norms[part, None] + norms[None, :] - 2.0 * (block @ vectors.T)
        slack = 1e-9 * (1.0 + self.norms[part] + norms.max(initial=0.0))
        bound = self.bound[part]
        if vectors.shape[0] > self.k:
            bound = np.minimum(bound, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1])
        qs, rows = np.nonzero(rough <= (bound + slack)[:, None])
        if len(qs) == 0:
            return
        exact = np.zeros(len(qs))
        for d in range(vectors.shape[1]):  # added up in dimension order, as the column expression does
            exact += (vectors[rows, d] - block[qs, d]) ** 2
        self.q = np.concatenate([self.q, qs + (part.start or 0)])
        self.dist = np.concatenate([self.dist, exact])
        self.ids = np.concatenate([self.ids, _objects(ids.take(pa.array(rows)))])
        self._trim()

    def _trim(self) -> None:
        order = np.lexsort((self.ids, np.round(self.dist, _DIGITS), self.q))
        q = self.q[order]
        first = np.searchsorted(q, q, side="left")
        keep = np.arange(len(q)) - first < self.k
        order = order[keep]
        self.q, self.dist, self.ids = self.q[order], self.dist[order], self.ids[order]
        last = np.flatnonzero(np.diff(self.q, append=-1))
        full = last[np.bincount(self.q, minlength=len(self.matrix))[self.q[last]] == self.k]
        self.bound[self.q[full]] = self.dist[full] + 10.0**-_DIGITS

    def rows(self) -> dict:
        return {"query_id": self.query_ids[self.q], "node_id": self.ids, "distance": self.dist}


def _arrow_side(ids, vectors, dim: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and vectors of the rows whose vector has the right length.

    Checked here and not by a filter, which would be pushed down and have fresh vectors made twice.
    """
    fits = pc.equal(pc.fill_null(pc.list_value_length(vectors), 0), dim)
    ids, vectors = ids.filter(fits), vectors.filter(fits)
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return ids, flat.astype(np.float64).reshape(len(ids), dim)


def _in_place(index: DataFrame, queries: pa.Table, dim: int, k: int, schema: str) -> tuple[DataFrame, Broadcast]:
    """One stretch of queries goes to every task; the index does not move. The stretch is returned too, to be let go."""
    ids, matrix = _arrow_side(queries.column("query_id"), queries.column("embedding"), dim)
    shipped = index.sparkSession.sparkContext.broadcast((_objects(ids), matrix))
    query_type = queries.schema.field("query_id").type

    def local_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, id_type = _Best(*shipped.value, k), None
        for batch in batches:
            id_type = batch.schema.field("node_id").type
            best.add(*_arrow_side(batch.column("node_id"), batch.column("embedding"), dim))
        if id_type is None:
            return
        rows = best.rows()
        columns = [
            pa.array(rows["query_id"], query_type),
            pa.array(rows["node_id"], id_type),
            pa.array(rows["distance"], pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["query_id", "node_id", "distance"])

    return index.mapInArrow(local_best, schema), shipped


def index_dim(index: DataFrame) -> int:
    """Length of the index's vectors: the most frequent one, the larger of equals, 0 for an empty index."""
    sizes = index.where(F.col("embedding").isNotNull()).groupBy(F.size("embedding").alias("dim")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("dim")).first()
    return first["dim"] if first else 0


def knn_join(index: DataFrame, queries: DataFrame, k: int = 5, query_bytes: int = QUERY_BYTES, dim: int | None = None) -> DataFrame:
    """The ``k`` index rows nearest to each query: ``query_id``, ``node_id``, ``distance``, ``rank``.

    Queries are settled, so their vectors are made once, and go through in stretches whose vectors and running results
    take ``query_bytes`` together. For each stretch the index is scanned where it is; ``k`` rows per query and task are
    shuffled. Where there are several stretches one is in flight at a time: it is read, broadcast, its rows are written to
    the shared folder, and it is let go before the next. ``dim`` is the index's vector length, the most frequent one
    unless given; a query of another length has no hits and leaves the others alone (``search_status`` tells it apart),
    and index rows of another length take no part.
    """
    spark = index.sparkSession
    types = dict(index.dtypes) | {"query_id": dict(queries.dtypes)["query_id"]}
    schema = f"query_id {types['query_id']}, node_id {types['node_id']}, distance double"
    index = index.select("node_id", "embedding")
    dim = index_dim(index) if dim is None else dim
    queries = settle(queries.select("query_id", "embedding"), "queries")
    id_bytes = F.sum(F.octet_length(F.col("query_id").cast("string")))
    size = queries.agg(F.count("*").alias("n"), F.coalesce(id_bytes, F.lit(0)).alias("ids")).first()
    total = size["n"] * (dim * 8 + 64 + k * _HIT_BYTES) + size["ids"]
    stretches = max(1, min(size["n"], math.ceil(total / query_bytes)))
    if stretches == 1:
        return top_n(_in_place(index, queries.toArrow(), dim, k, schema)[0], ["query_id"], nearest_first(), k)
    by_part, found = scratch_path(spark, "stretches"), scratch_path(spark, "near")
    part = F.pmod(F.xxhash64("query_id"), F.lit(stretches)).cast("int")
    queries.withColumn("part", part).repartition("part").write.partitionBy("part").parquet(by_part)
    parts = spark.read.schema(StructType([*queries.schema]).add("part", IntegerType())).parquet(by_part)
    for i in range(stretches):
        asked = parts.where(F.col("part") == i).select("query_id", "embedding").toArrow()
        if len(asked):
            near, shipped = _in_place(index, asked, dim, k, schema)
            near.write.mode("append").parquet(found)
            shipped.destroy()
    return top_n(spark.read.schema(schema).parquet(found), ["query_id"], nearest_first(), k)


def with_payload(hits: DataFrame, index: DataFrame) -> DataFrame:
    """Add text, source and images of each hit. A hit without its row in the index is dropped.

    Vectors are not read. For a saved index ``lookup_payload`` moves less.
    """
    payload = [c for c in index.columns if c not in ("embedding", "node_id", *hits.columns)]
    return hits.join(index.select("node_id", *payload), "node_id")


def _id_place(node_id: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(node_id), 64 - _MAP_BITS)


def on_map_of(ids: DataFrame) -> Column:
    """Condition on ``node_id`` that holds for every id in ``ids`` and for few others, by a bit map of fixed size.

    At most one row for each 64 bits of the map reaches the driver.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(64)).cast("int"))
    places = ids.select(_id_place(F.col("node_id")).alias("place"))
    rows = places.groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).collect()
    words = [0] * (1 << (_MAP_BITS - 6))
    for row in rows:
        words[row["at"]] = row["bits"]
    place = _id_place(F.col("node_id"))
    table = F.from_json(F.lit(json.dumps(words)), "array<bigint>")
    word = F.get(table, F.shiftright(place, 6).cast("int"))
    return F.call_function("shiftright", word, F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def lookup_payload(hits: DataFrame, index: DataFrame) -> DataFrame:
    """``with_payload`` for a saved index: hits are settled, so the search runs once, and of the index only rows that can
    be hits, by a map of their ids, are joined. Many hits fill the map; then more rows move, and the result is the same.
    """
    hits = cut_lineage(hits)
    return with_payload(hits, index.where(on_map_of(hits)))


def project_hits(hits: DataFrame) -> DataFrame:
    """Hits as they are handed out: with the number of images in place of the images."""
    kept = [c for c in hits.columns if c not in ("images", "embedding")]
    return hits.select(*kept, F.size(F.coalesce("images", F.array().cast("array<string>"))).alias("image_count"))


def search_status(queries: DataFrame, hits: DataFrame, given: bool = False, dim: int | None = None) -> DataFrame:
    """One row per query: ``status`` and the number of hits, and the model's ``error`` where ``queries`` has that column.

    ``no_embedding`` if its text gave no vector (with ``given`` any vector is good), ``bad_dim`` if ``dim`` is told and
    its vector has another length, ``no_hits``, else ``ok``.
    """
    vec = F.col("embedding")
    usable = vec.isNotNull() if given else F.coalesce(has_non_zero(vec), F.lit(False))
    odd = F.lit(False) if dim is None else F.coalesce(F.size(vec) != dim, F.lit(False))
    found = hits.groupBy("query_id").agg(F.count("*").alias("n_hits"))
    error = [F.col("error")] if "error" in queries.columns else []
    count = F.when(F.col("_usable"), F.coalesce("n_hits", F.lit(0))).otherwise(0)
    return (
        queries.select("query_id", usable.alias("_usable"), odd.alias("_odd"), *error)
        .join(found, "query_id", "left")
        .select(
            "query_id",
            F.when(~F.col("_usable"), "no_embedding").when(F.col("_odd"), "bad_dim").when(count == 0, "no_hits").otherwise("ok").alias("status"),
            count.cast("bigint").alias("n_hits"),
            *error,
        )
    )


def index_status(index: DataFrame) -> DataFrame:
    """One row: vectors, texts, dimension, whether all vectors have it, and whether there is anything to search."""
    dims = F.size("embedding")
    return index.agg(
        F.count("embedding").alias("vectors"),
        F.count("text").alias("texts"),
        F.max(dims).alias("dimension"),
        F.coalesce((F.min(dims) == F.max(dims)) & (F.count("embedding") == F.count("text")), F.lit(True)).alias("consistent"),
        (F.count("embedding") > 0).alias("ready"),
    )
