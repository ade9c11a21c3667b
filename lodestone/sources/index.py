"""The vector index as Parquet, laid out by hash buckets of ``node_id``.

Rows of a bucket lie in a folder of their own, sorted by id, so a lookup, an append or a merge reads the buckets that its
ids fall in and no others. ``_layout`` beside them holds one row: the number of buckets and the length of the vectors.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.search import index_dim, index_status, on_map_of, with_payload
from ..schema import INDEX
from .scratch import cut_lineage, settle

BUCKETS = 32
FEW_HITS = 200_000  # rows of ids that are broadcast, some 20 MB; more are joined by a shuffle


@dataclass
class Layout:
    buckets: int
    dim: int


def bucket_of(node_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(node_id), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def layout(spark: SparkSession, path: str) -> Layout | None:
    """How the index at a path is laid out; none if there is no index, or one without buckets."""
    row = _read(spark, f"{path}/_layout", "buckets int, dim int")
    found = row.first() if row is not None else None
    return Layout(found["buckets"], found["dim"]) if found else None


def _typed(index: DataFrame) -> DataFrame:
    return index.select(*[F.col(f.name).cast(f.dataType) for f in INDEX.fields])


def _write(rows: DataFrame, path: str, mode: str, buckets: int) -> None:
    dealt = rows.withColumn("bucket", bucket_of(F.col("node_id"), buckets)).repartition(buckets, "bucket")
    dealt.sortWithinPartitions("bucket", "node_id").write.mode(mode).partitionBy("bucket").parquet(path)


def save_index(index: DataFrame, path: str, mode: str = "overwrite", buckets: int = BUCKETS) -> None:
    """Write the index in ``buckets`` folders by id, a file each; a bucket of some 256 MB is a good size.

    ``mode="append"`` keeps the number of buckets that is there and looks for no repeated ids; ``append_index`` does.
    """
    spark = index.sparkSession
    there = layout(spark, path) if mode == "append" else None
    seen = Observation()
    size = F.size("embedding")
    rows = _typed(index).observe(seen, F.min(size).alias("least"), F.max(size).alias("most"))
    _write(rows, path, mode, there.buckets if there else buckets)
    if there is None and mode != "ignore":
        least, most = seen.get["least"], seen.get["most"]
        dim = (most or 0) if least == most else index_dim(load_index(spark, path))
        row = spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(dim).alias("dim"))
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/_layout")


def load_index(spark: SparkSession, path: str) -> DataFrame:
    """A saved index; an empty one if there is none."""
    saved = _read(spark, path, INDEX)
    return spark.createDataFrame([], INDEX) if saved is None else saved.select(*INDEX.fieldNames())


def saved_index_status(spark: SparkSession, path: str) -> DataFrame:
    """Status of the index at a path, and whether there is one at all."""
    exists = _read(spark, path, INDEX) is not None
    return index_status(load_index(spark, path)).withColumn("exists", F.lit(exists))


def in_buckets(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """Rows of the saved index in the buckets that the ``node_id`` of ``ids`` fall in; the scan leaves out the others.

    At most one row per bucket reaches the driver.
    """
    there = layout(spark, path)
    if there is None:
        return load_index(spark, path)
    found = ids.select(bucket_of(F.col("node_id"), there.buckets).alias("b")).distinct().collect()
    saved = _read(spark, path, INDEX)
    return saved.where(F.col("bucket").isin(sorted(r["b"] for r in found))).select(*INDEX.fieldNames())


def lookup(hits: DataFrame, path: str) -> DataFrame:
    """Hits with their text, source and images, read from the saved index at ``path``; one without a row there is dropped.

    Hits are settled, so the search runs once. Only buckets that hold a hit are read. Up to ``FEW_HITS`` hits are
    broadcast, and the index does not move; more meet it in a shuffle join, after a filter by a map of their ids.
    """
    spark = hits.sparkSession
    hits = cut_lineage(hits)
    rows = in_buckets(spark, path, hits)
    if hits.count() <= FEW_HITS:
        return with_payload(F.broadcast(hits), rows)
    return with_payload(hits, rows.where(on_map_of(hits)))


def new_ids(rows: DataFrame, path: str) -> DataFrame:
    """``number`` of the rows (``node_id, number``) that the index at a path lacks, one for each id: the least.

    Only ids move: those of the rows, and of the index those in the same buckets.
    """
    first = rows.groupBy("node_id").agg(F.min("number").alias("number"))
    known = in_buckets(rows.sparkSession, path, rows).select("node_id")
    return first.join(known, "node_id", "left_anti").select("number")


def append_index(rows: DataFrame, path: str) -> None:
    """Add the rows that are new, of repeated ones the first. A second run of the same rows adds nothing, so a failed one
    can be repeated.

    The rows are settled first, which makes their vectors once. Texts and vectors move only when they are written.
    """
    staged = settle(_typed(rows).withColumn("number", F.monotonically_increasing_id()), "append")
    wanted = new_ids(staged.select("node_id", "number"), path)
    save_index(staged.join(wanted, "number", "left_semi").drop("number"), path, mode="append")


def merge_indexes(*indexes: DataFrame) -> DataFrame:
    """All rows of several indexes, each ``node_id`` once: the row of the first index that has it, and there the first row.

    The indexes are settled with a number for each row, the winners found on ids and numbers alone, and only their rows
    read again.
    """
    place = lambda i: F.lit(i).cast("decimal(38,0)") * F.lit(1 << 62).cast("decimal(20,0)") + F.monotonically_increasing_id()
    marked = [df.withColumn("_number", place(i)) for i, df in enumerate(indexes)]
    rows = settle(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked), "merge")
    first = rows.groupBy("node_id").agg(F.min("_number").alias("_number"))
    return rows.join(first.select("_number"), "_number", "left_semi").drop("_number")
