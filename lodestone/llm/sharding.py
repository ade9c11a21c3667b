"""Sharding by sampled splitters.

Rows are ordered by a key. A sample that takes rows in proportion to their size gives the quantile boundaries; rows are
range-partitioned at these, ranges that came out overfull are divided again by a denser sample of their own rows, and
running sums inside the ranges place every row. The key ends in a number that no other row has, so a group of equal
keys, however large, is divided like any other stretch.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import settle

_KEY = ("_h", "_d", "_s")
_SPLIT = "array<struct<_h:bigint,_d:bigint,_s:bigint>>"


def _share(rate: float) -> Column:
    """How often a row is drawn: ``rate`` times its size on average, settled by a hash and so the same on every attempt."""
    fraction = F.pmod(F.xxhash64("_s", F.lit(7)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return F.floor(F.col("_size") * F.lit(rate) + fraction)


def _with_range(rows: DataFrame, splitters: list[tuple[int, int, int]]) -> DataFrame:
    """Add ``_range``, the number of splitters at or below the key, by binary search."""
    bounds = F.from_json(F.lit(json.dumps([dict(zip(_KEY, s, strict=True)) for s in splitters])), _SPLIT)
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(max(len(splitters).bit_length(), 1)))))
    key = F.struct(*_KEY)
    found = F.aggregate(steps, F.lit(0), lambda lo, step: F.when(F.get(bounds, lo + step - 1) <= key, lo + step).otherwise(lo))
    return rows.withColumn("_range", found)


def _cut(sample: DataFrame, parts: Column) -> list[tuple[int, int, int]]:
    """The quantile keys of a weighted sample (``_range``, key, ``_w``): ``parts`` stretches of each range."""
    inside = Window.partitionBy("_range")
    upto = F.sum("_w").over(inside.orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    place = lambda at: F.floor(at * F.col("_parts") / F.col("_all"))
    weighed = sample.withColumn("_parts", parts).withColumn("_all", F.sum("_w").over(inside)).withColumn("_upto", upto)
    picked = weighed.where(place(F.col("_upto") - F.col("_w")) < F.least(place(F.col("_upto")), F.col("_parts") - 1))
    return [tuple(r) for r in picked.select(*_KEY).collect()]


def shard(
    df: DataFrame, shards: int, key: list[str], size: str, per_shard: int = 16, oversample: int = 16, rounds: int = 6, range_rows: int = 1 << 20
) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1, sums of ``size`` near equal) and ``slot`` (gapless from 0 in each shard).

    ``key``: a long column to order by, then any columns that settle ties; rows with equal keys stay next to each other
    and part only at a boundary. Sums differ by one row's size at most. There are ``per_shard`` ranges a shard, and more where
    one would hold over ``range_rows`` rows on average. Driver and single tasks see the splitters and a sample of about
    ``oversample`` rows a range, never more. ``size`` must be positive; null counts as 1.
    Rows equal in every column are told apart by a number given when the input is settled. Columns of the input called
    ``shard`` or ``slot`` are replaced, names that begin with an underscore are reserved. An empty input gives no rows.
    """
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    rows = settle(
        df.select(
            *kept,
            F.coalesce(F.col(key[0]), F.lit(0)).cast("long").alias("_h"),
            F.xxhash64(*(key[1:] or key)).alias("_d"),
            F.monotonically_increasing_id().alias("_s"),
            F.coalesce(F.col(size), F.lit(1)).cast("long").alias("_size"),
        ),
        "shard-rows",
    )
    total, n = rows.agg(F.sum("_size"), F.count("*")).first()
    if not n:
        return rows.select(*kept, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = max(shards * per_shard, -(-n // range_rows))
    rate = ranges * oversample / total
    first = rows.select(*_KEY, F.lit(0).alias("_range"), _share(rate).alias("_w")).where("_w > 0")
    splitters = sorted(set(_cut(first, F.lit(ranges))))
    for turn in range(rounds):
        placed = _with_range(rows, splitters)
        held = placed.groupBy("_range").agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_n")).collect()
        over = {r["_range"]: -(-r["_bytes"] * ranges // total) for r in held if r["_n"] > 1 and r["_bytes"] * ranges > 2 * total}
        if not over or turn == rounds - 1:
            break
        denser = placed.where(F.col("_range").isin(list(over))).select(*_KEY, "_range", _share(rate * 4 ** (turn + 1)).alias("_w"))
        parts = F.create_map(*(F.lit(x) for pair in over.items() for x in pair))[F.col("_range")]
        found = set(_cut(denser.where("_w > 0"), parts)) - set(splitters)
        if not found:
            break
        splitters = sorted({*splitters, *found})
    inside_of, before, offsets = {r["_range"]: r for r in held}, (0, 0), []
    for at in range(len(splitters) + 1):
        offsets.append({"b": before[0], "n": before[1]})
        if at in inside_of:
            before = (before[0] + inside_of[at]["_bytes"], before[1] + inside_of[at]["_n"])
    offset = F.get(F.from_json(F.lit(json.dumps(offsets)), "array<struct<b:bigint,n:bigint>>"), F.col("_range"))
    inside = Window.partitionBy("_range").orderBy(*_KEY)
    running = F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    middle = F.col("_offset.b") + F.col("_running") - F.col("_size") / 2
    ordered = (
        placed.withColumn("_running", running)
        .withColumn("_row", F.row_number().over(inside))
        .withColumn("_offset", offset)
        .withColumn("shard", F.least(F.floor(middle / F.lit(float(total)) * shards), F.lit(shards - 1)).cast("int"))
        .withColumn("_rank", F.col("_offset.n") + F.col("_row") - 1)
    )
    firsts = ordered.groupBy(F.col("shard").alias("_shard")).agg(F.min("_rank").alias("_first"))  # one row a shard
    return ordered.join(F.broadcast(firsts), F.col("shard") == F.col("_shard")).select(
        *kept, "shard", (F.col("_rank") - F.col("_first")).cast("long").alias("slot")
    )


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes and eight more), ``text_crc32`` and ``text_hash``; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
