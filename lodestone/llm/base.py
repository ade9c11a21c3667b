"""What the operators of this folder share: settled tables and safe names."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor costs no recomputation, and rows stay as they are."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


BITS = 24  # of a map: 2 MB, however many numbers it stands for


def bit_map(numbers: DataFrame, bits: int = BITS) -> np.ndarray:
    """Which of ``2 ** bits`` places the 64-bit numbers of a one-column table fall on, by their leading bits.

    A filter of fixed size: numbers that are in the table always pass it. At most ``2 ** (bits - 6)`` rows reach the driver.
    """
    place = F.shiftrightunsigned(F.col(numbers.columns[0]), 64 - bits)
    marks = numbers.select(F.shiftright(place, 6).alias("at"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))
    rows = marks.groupBy("at").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("word")).toPandas()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[rows["at"].to_numpy(dtype=np.int64)] = rows["word"].to_numpy(dtype=np.int64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def on_map(table: np.ndarray, numbers: np.ndarray, bits: int = BITS) -> np.ndarray:
    return table[(numbers.astype(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)]


HOT = 4096  # shares of a table: a group of one share or more is hot, and there are no more than so many


def with_group(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` (``total`` of them) with the columns of their row in ``groups``, one per value of ``key``, null included.

    ``size`` counts the rows of a group. Groups that hold a ``HOT``-th of all rows or more are broadcast, ``HOT`` rows at
    most whatever the table's size; the others meet their rows by a shuffle join, where no key is larger than that share.
    """
    named = groups.withColumnRenamed(key, "_group")
    same = F.col(key).eqNullSafe(F.col("_group"))
    hot = F.broadcast(named.where(F.col(size) * HOT >= total))
    cold = named.where(F.col(size) * HOT < total)
    met = rows.join(hot, same)
    rest = rows.join(hot.select("_group"), same, "left_anti").join(cold, same)
    return met.unionByName(rest).drop("_group")


def whole_numbers(vectors: DataFrame, scale: int, *kept: str, vector: str = "embedding") -> DataFrame:
    """The columns ``kept`` and ``q``: ``floor(scale * x)`` of each component, as longs.

    Vectors that are null or hold null or non-finite components are left out. A component that does not fit in a long
    fails the job.
    """
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    wide = lambda x: F.abs(x.cast("double") * scale) >= F.lit(float(1 << 63))
    too_wide = F.raise_error(F.lit("a component is too large for a long")).cast("bigint")
    level = lambda x: F.when(wide(x), too_wide).otherwise(F.floor(x.cast("double") * scale))
    return vectors.select(*kept, F.when(F.coalesce(fine, F.lit(False)), F.transform(vector, level)).alias("q")).where("q is not null")
