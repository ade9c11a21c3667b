"""Benchmark decontamination: rare word-pair seeds, counted, then Smith-Waterman alignment.

An alignment of M matches and E errors scores 2M - E. Where that is at least a share s of the 2m that the whole item of m
words scores, at most E / 2 <= M - s * m of the M - 1 steps from a match to the next hold two errors or more. So s * m - 1
steps or more join words that are neighbours, or have one word between them, both in the item and in the text: no copy
above the limit has fewer such pairs, however it was edited. (Items too short for a pair to be sure go by single words.)

The pairs of all test items set bits in a map of fixed size. Documents are scanned in place; only stretches where the
pairs of items of about one length lie densely enough leave the scan, as passages. Of an item with P places where a pair begins, a
copy has ``need`` at least, so it has one or more of the P - need + 1 rarest: only the pairs that begin there are joined
with those of the passages. What meets is counted over all pairs, and each passage and item that share enough are
aligned word by word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .base import bit_map, on_map, settle

MATCH, MISMATCH, GAP = 2, -1, -1
SCORE = 0.5  # of what the whole item would score
_BATCH = 1 << 20  # cells of an alignment step


def needed(m: int, score: float) -> tuple[int, bool]:
    """How many of an item's ``m`` words must begin a pair of a copy that reaches ``score``; if none, how many must occur at all."""
    pairs = math.ceil(score * m - 1 - 1e-9)
    return (pairs, True) if pairs > 0 else (max(math.ceil(score * m - 1e-9), 1), False)


def links(h: np.ndarray, step: int) -> np.ndarray:
    """A number for each pair of words ``step`` apart, the same for either step; for each word if ``step`` is 0."""
    first, second = W.salts(2, 3) | np.uint64(1)
    return W.mix(h[: len(h) - step] * first + h[step:] * second)


def of_kind(seeds: np.ndarray, kind: int) -> np.ndarray:
    return W.mix(seeds ^ W.salts(1, 8 + kind))


def items_of(bench: DataFrame, score: float = SCORE) -> DataFrame:
    """Test items (``item_id, text``) as ``item_id, words, kind, need, places, seeds, plain``.

    ``kind`` is the length to within a quarter of a power of two, or 0 where single words are the seeds; ``seeds`` are
    the numbers of the pairs that begin at ``places``, told apart by kind, ``plain`` the same without the kind.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = W.split(batch.column("text"))
            h = w.hashes()
            out: dict[str, list] = {c: [] for c in ("words", "kind", "need", "places", "seeds", "plain")}
            for a, b in zip(w.first[:-1], w.first[1:], strict=True):
                m = int(b - a)
                need, paired = needed(m, score)
                kind = 4 * m.bit_length() + (4 * m >> max(m.bit_length() - 1, 0)) % 4 if paired else 0
                some = [links(h[a:b], step) for step in ((1, 2) if paired else (0,))]
                plain = np.concatenate(some)
                out["words"].append(h[a:b].view(np.int64))
                out["kind"].append(kind)
                out["need"].append(need)
                out["places"].append(np.concatenate([np.arange(len(x), dtype=np.int32) for x in some]))
                out["seeds"].append(of_kind(plain, kind).view(np.int64))
                out["plain"].append(plain.view(np.int64))
            many = {"places": pa.int32(), "words": pa.int64(), "seeds": pa.int64(), "plain": pa.int64()}
            columns = [pa.array(x, pa.list_(many[c]) if c in many else pa.int32()) for c, x in out.items()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), *columns], ["item_id", *out])

    name = bench.schema["item_id"].dataType.simpleString()
    return bench.select("item_id", "text").mapInArrow(
        work, f"item_id {name}, words array<bigint>, kind int, need int, places array<int>, seeds array<bigint>, plain array<bigint>"
    )


def dense(at: np.ndarray, text: np.ndarray, need: int, span: int) -> np.ndarray:
    """Which of the ascending places ``at`` have ``need`` of them, itself among these, within ``span`` words of one text."""
    n = len(at) - need + 1
    if n <= 0:
        return np.zeros(len(at), dtype=bool)
    start = np.flatnonzero((at[need - 1 :] - at[:n] < span) & (text[at[need - 1 :]] == text[at[:n]]))
    step = np.zeros(len(at) + 1, dtype=np.int64)
    step[start] += 1
    step[start + need] -= 1
    return np.cumsum(step)[:-1] > 0


def passages_of(docs: DataFrame, marks: Broadcast, kinds: dict[int, tuple[int, int]]) -> DataFrame:
    """``doc_id, key, passage, at, words, hits``: stretches of ``docs`` (``doc_id, key, text``) where seeds on the map are dense.

    ``kinds``: for each kind of items the least number of seeds of a copy, and the most words that it may reach over.
    ``at`` is the number of the first word, ``hits`` the seeds.
    """
    found = marks

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = found.value
        steps = [0] * (0 in kinds) + [1, 2] * any(kinds)
        for batch in batches:
            texts = batch.column("text")
            for a, b in W.chunks(texts):
                w = W.split(texts.slice(a, b - a))
                h = w.hashes()
                place, seed = {0: [], 1: []}, {0: [], 1: []}
                for step in steps:
                    if len(h) <= step:
                        continue
                    g = links(h, step)
                    at = np.flatnonzero(on_map(table, g))
                    at = at[w.text[at] == w.text[at + step]]
                    place[min(step, 1)].append(at)
                    seed[min(step, 1)].append(g[at])
                rows = []
                for kind, (need, span) in kinds.items():
                    if not place[min(kind, 1)]:
                        continue
                    where, seeds = np.concatenate(place[min(kind, 1)]), of_kind(np.concatenate(seed[min(kind, 1)]), kind)
                    on = on_map(table, seeds)
                    where, seeds = where[on], seeds[on]
                    order = np.argsort(where, kind="stable")
                    where, seeds = where[order], seeds[order]
                    at, back = np.unique(where, return_inverse=True)
                    kept = dense(at, w.text, need, span)[back]
                    where, seeds = where[kept], seeds[kept]
                    if not len(where):
                        continue
                    reach = span - need
                    parts = np.flatnonzero((np.diff(where) > max(2 * reach, span)) | (np.diff(w.text[where]) > 0)) + 1
                    for lo, hi in zip([0, *parts], [*parts, len(where)], strict=True):
                        t = int(w.text[where[lo]])
                        start = max(int(where[lo]) - reach, int(w.first[t]))
                        end = min(int(where[hi - 1]) + 1 + reach, int(w.first[t + 1]))
                        rows.append((a + t, start - int(w.first[t]), h[start:end].view(np.int64), np.unique(seeds[lo:hi]).view(np.int64), kind))
                if not rows:
                    continue
                index = pa.array([r[0] for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(index),
                        batch.column("key").take(index),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                        pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                        pa.array([r[4] for r in rows], pa.int32()),
                    ],
                    ["doc_id", "key", "at", "words", "hits", "kind"],
                )

    name = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "key", "text").mapInArrow(
        work, f"doc_id {name}, key bigint, at bigint, words array<bigint>, hits array<bigint>, kind int"
    )
    return out.withColumn("passage", F.xxhash64("key", "at", "kind"))


def rare_seeds(items: DataFrame, hits: DataFrame) -> DataFrame:
    """``item, seed``: the seeds at each item's P - need + 1 rarest places, one of which any copy must hold.

    A place is as frequent as its seeds are among all ``hits`` (``passage, seed``). Ties go to the earlier place; seeds
    that no passage holds are left out. The group of a window is one item's places.
    """
    heard = hits.groupBy("seed").agg(F.count("*").alias("heard"))
    each = items.select("item", "need", F.explode(F.arrays_zip("seeds", "places")).alias("s"))
    each = each.select("item", "need", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place")).join(heard, "seed", "left")
    place = each.groupBy("item", "need", "place").agg(F.sum(F.coalesce("heard", F.lit(0))).alias("heard"), F.collect_set("seed").alias("seeds"))
    inside = Window.partitionBy("item")
    ranked = place.withColumn("rank", F.row_number().over(inside.orderBy("heard", "place"))).withColumn("all", F.count("*").over(inside))
    return ranked.where("rank <= all - need + 1 AND heard > 0").select("item", F.explode("seeds").alias("seed")).distinct()


def align(passages: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each pair, and the place in the passage just after it (linear gaps, by Smith and Waterman)."""
    n, width, height = len(passages), max(map(len, passages)), max(map(len, items))
    p, q = np.zeros((n, width), dtype=np.int64), np.zeros((n, height), dtype=np.int64)
    in_p, in_q = np.zeros((n, width), dtype=bool), np.zeros((n, height), dtype=bool)
    for i, (x, y) in enumerate(zip(passages, items, strict=True)):
        p[i, : len(x)], in_p[i, : len(x)] = x, True
        q[i, : len(y)], in_q[i, : len(y)] = y, True
    slope = -GAP * np.arange(width + 1, dtype=np.int32)
    row = np.zeros((n, width + 1), dtype=np.int32)
    best, end = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int64)
    for j in range(height):
        same = (p == q[:, j : j + 1]) & in_p & in_q[:, j : j + 1]
        now = np.maximum(row + GAP, 0)
        now[:, 1:] = np.maximum(now[:, 1:], row[:, :-1] + np.where(same, MATCH, MISMATCH))
        row = np.maximum.accumulate(now + slope, axis=1) - slope
        at = row.argmax(axis=1)
        top = row[np.arange(n), at]
        better = top > best
        best, end = np.where(better, top, best), np.where(better, at, end)
    return best, end


def contaminated(docs: DataFrame, bench: DataFrame, score: float = SCORE) -> DataFrame:
    """``doc_id, item_id, score, first_word, end_word``: documents (``doc_id, text``) that hold a copy of a test item.

    ``score`` is the best local alignment of any passage with the item, as a share of what the whole item scores; rows
    below the limit are left out. One row per document and item: the best, the first of equals. Items without words match
    nothing; null texts count as empty, null ids are ids like others; repeated rows give one row; empty tables give none.
    Other columns are not read.
    """
    return _contaminated(docs.select("doc_id", F.lit(0).cast("long").alias("key"), "text").withColumn("key", F.xxhash64("doc_id")), bench, score).drop("key")


def _contaminated(docs: DataFrame, bench: DataFrame, score: float) -> DataFrame:
    spark = docs.sparkSession
    items = settle(items_of(bench, score).where(F.size("words") > 0).withColumn("item", F.monotonically_increasing_id()), "items")
    shapes = items.groupBy("kind").agg(F.min("need").alias("need"), F.max(F.size("words")).alias("longest")).collect()
    kinds = {r["kind"]: (r["need"], max(math.floor((3 - 2 * score) * r["longest"] + 1e-9), r["longest"])) for r in shapes}
    marks = spark.sparkContext.broadcast(bit_map(items.select(F.explode(F.concat("seeds", "plain")))))
    passages = settle(passages_of(docs, marks, kinds), "passages")
    hits = passages.select("passage", F.explode("hits").alias("seed"))
    pairs = hits.join(rare_seeds(items, hits), "seed").select("passage", "item").distinct()
    rows = (
        pairs.join(passages.select("passage", "key", "doc_id", "at", "words", "hits"), "passage")
        .join(items.select("item", "item_id", F.col("words").alias("asked"), "need", "places", "seeds"), "item")
        .select("key", "doc_id", "item", "item_id", "at", "words", "hits", "asked", "need", "places", "seeds")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, seeds, places = ([np.asarray(x.values) for x in batch.column(c)] for c in ("hits", "seeds", "places"))
            enough = [len(np.unique(p[np.isin(s, h)])) >= n for h, s, p, n in zip(hits, seeds, places, batch.column("need").to_pylist(), strict=True)]
            batch = batch.filter(pa.array(enough, pa.bool_()))
            left, right = ([np.asarray(x.values) for x in batch.column(c)] for c in ("words", "asked"))
            size = np.array([len(x) for x in left])
            order = np.argsort(size, kind="stable")
            at = 0
            while at < len(order):
                some = [order[at]]
                while at + len(some) < len(order) and (len(some) + 1) * (size[order[at + len(some)]] + 1) <= _BATCH:
                    some.append(order[at + len(some)])
                at += len(some)
                p, q = [left[i] for i in some], [right[i] for i in some]
                best, end = align(p, q)
                share = best / np.array([MATCH * len(y) for y in q])
                good = np.flatnonzero(share >= score)
                if not len(good):
                    continue
                _, back = align([p[i][: end[i]][::-1] for i in good], [q[i][::-1] for i in good])
                index = pa.array([int(some[i]) for i in good])
                base = batch.column("at").take(index).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(index) for c in ("key", "doc_id", "item", "item_id")),
                        pa.array(share[good]),
                        pa.array(base + end[good] - back),
                        pa.array(base + end[good]),
                    ],
                    ["key", "doc_id", "item", "item_id", "score", "first_word", "end_word"],
                )

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("doc_id", "item_id")}
    scored = rows.mapInArrow(
        work, f"key bigint, doc_id {kinds['doc_id']}, item bigint, item_id {kinds['item_id']}, score double, first_word bigint, end_word bigint"
    )
    best = Window.partitionBy("key", "item").orderBy(F.desc("score"), "first_word", "end_word")
    return scored.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n", "item")


def decontaminated(docs: DataFrame, bench: DataFrame, score: float = SCORE) -> DataFrame:
    """``docs`` without the rows whose text holds a copy of a test item; all columns and other rows stay as they are."""
    key = F.xxhash64("doc_id", "text")
    bad = settle(_contaminated(docs.select("doc_id", key.alias("key"), "text"), bench, score).select("key").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))  # in a struct, so that no name of theirs clashes
    return rows.join(bad, "key", "left_anti").select("row.*")
