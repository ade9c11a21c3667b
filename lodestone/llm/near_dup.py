"""MinHash near-duplicates by fast similarity sketching.

A sketch of ``COORDINATES`` numbers is filled in rounds: in each round every shingle is thrown into one bin by a fresh
hash, and a bin keeps the smallest value of the first round that reaches it. The first rounds throw at random; from
round ``COORDINATES`` on, all shingles go into the bin of the round's number, so every bin fills in the end, and the
share of equal bins of two sketches estimates the Jaccard similarity with the concentration of full MinHash. The work
per document is about its shingles plus ``t ln t``, so many coordinates are cheap, and ``ROWS`` of them make a band: two
documents of similarity 0.8 miss all 64 bands of 8 once in 130,000 times, two of 0.3 meet in one once in 240.

Documents with equal sets collapse into classes. Classes that share a band are neighbours; connected neighbours form a
cluster, which no two similar classes are split over. Inside a cluster every pair is verified on the full sets, in
blocks of bounded size whose rows are copied once per block of the cluster; a task hands on a spanning forest of the
links that it finds, never all of them. The components of these links are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import bit_map, on_map, settle
from .components import components

COORDINATES, ROWS = 512, 8
BANDS = COORDINATES // ROWS
PERCENT = 80
BLOCK = 100_000  # shingles in a block of a cluster, about
_ROUND = W.salts(2 * COORDINATES, 3)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingles of ``width`` words; with fewer words the whole sequence is one."""
    w = W.split(texts)
    h = w.hashes()
    g = W.grams(h, width)
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= width:
            yield np.unique(g[a : b - width + 1])
        elif b > a:
            yield W.mix(W.grams(h[a:b], int(b - a)) + np.uint64(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """One row of ``coordinates`` numbers per set. Empty sets give rows that mean nothing."""
    t = coordinates
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(sets), t), empty, dtype=np.uint64)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    live = np.flatnonzero(size)
    for turn in range(2 * t):
        if not len(live):
            break
        items = np.concatenate([sets[i] for i in live])
        owner = np.repeat(np.arange(len(live)), size[live])
        h = W.mix(items ^ _ROUND[turn])
        place = (h >> np.uint64(40)) % np.uint64(t) if turn < t else np.full(len(h), turn - t, dtype=np.uint64)
        value = (h & np.uint64((1 << 40) - 1)) | np.uint64(turn << 40)
        target = owner * t + place.astype(np.int64)
        part = out[live].ravel()
        np.minimum.at(part, target, value)
        out[live] = part.reshape(len(live), t)
        live = live[(out[live] == empty).any(axis=1)]
    return out


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One number per band, the band's own number worked in."""
    n, t = sketch.shape
    parts = sketch.reshape(n, t // rows, rows)
    out = np.zeros((n, t // rows), dtype=np.uint64)
    for i, salt in enumerate(W.salts(rows, 4) | np.uint64(1)):
        out += W.mix(parts[:, :, i]) * salt
    return W.mix(out ^ W.salts(t // rows, 5)[None, :])


def set_names(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit number that stands for each whole set."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.zeros(len(sets), dtype=np.uint64)
    live = np.flatnonzero(size)
    if len(live):
        items = W.mix(np.concatenate([sets[i] for i in live]) ^ _ROUND[0])
        out[live] = W.mix(np.add.reduceat(items, (np.cumsum(size[live]) - size[live])) + size[live].astype(np.uint64))
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), _signed(x.ravel()))


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, name, bands`` of documents (``doc_id, text``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in W.chunks(texts):
                sets = list(shingle_sets(texts.slice(a, b - a), width))
                columns = [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _signed(set_names(sets)),
                    _lists(bands(sketches(sets))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "name", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_shingles bigint, name bigint, bands array<bigint>")


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``key, name, items`` (the whole set) of the documents whose ``key`` is on the map of the wanted ones, and maybe of others."""
    marks = docs.sparkSession.sparkContext.broadcast(bit_map(wanted.select("key")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(on_map(marks.value, batch.column("key").to_numpy())))
            texts = some.column("text")
            for a, b in W.chunks(texts):
                sets = list(shingle_sets(texts.slice(a, b - a), width))
                items = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column("key").slice(a, b - a), _signed(set_names(sets)), items], ["key", "name", "items"])

    return docs.select(F.xxhash64("doc_id").alias("key"), "text").mapInArrow(work, "key bigint, name bigint, items binary")


def common(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every one on the right, by products of incidence blocks."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    where_a, where_b = np.searchsorted(both, a), np.searchsorted(both, b)
    in_a, in_b = np.isin(a, both), np.isin(b, both)
    row_a = np.repeat(np.arange(len(left)), [len(s) for s in left])[in_a]
    row_b = np.repeat(np.arange(len(right)), [len(s) for s in right])[in_b]
    col_a, col_b = where_a[in_a], where_b[in_b]
    order_a, order_b = np.argsort(col_a, kind="stable"), np.argsort(col_b, kind="stable")
    row_a, col_a, row_b, col_b = row_a[order_a], col_a[order_a], row_b[order_b], col_b[order_b]
    for at in range(0, len(both), width):
        part = []
        for rows, cols, n in ((row_a, col_a, len(left)), (row_b, col_b, len(right))):
            lo, hi = np.searchsorted(cols, [at, at + width])
            block = np.zeros((n, min(width, len(both) - at)), dtype=np.float32)
            block[rows[lo:hi], cols[lo:hi] - at] = 1
            part.append(block)
        out += part[0] @ part[1].T
    return out


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric boolean matrix, as (parent, child)."""
    left, out = np.ones(len(near), dtype=bool), []
    for root in range(len(near)):
        if not left[root]:
            continue
        left[root], queue = False, [root]
        while queue:
            at = queue.pop()
            found = np.flatnonzero(near[at] & left)
            left[found] = False
            out += [(at, int(x)) for x in found]
            queue += found.tolist()
    return out


def block_links(names: np.ndarray, sets: list[np.ndarray], block: np.ndarray, i: int, j: int, percent: int) -> list[tuple[int, int]]:
    """Links between classes of block ``i`` and ``j`` of one cluster that span all links there."""
    _, first = np.unique(names, return_index=True)  # a class may come several times
    left, right = [k for k in first if block[k] == i], [k for k in first if block[k] == j]
    if not left or not right or i == j and len(left) < 2:
        return []
    shared = common([sets[k] for k in left], [sets[k] for k in right])
    size = np.array([len(s) for s in sets], dtype=np.float64)
    near = 100 * shared >= percent * (size[left][:, None] + size[right][None, :] - shared)
    if i == j:
        np.fill_diagonal(near, False)
        return [(int(names[left[a]]), int(names[left[b]])) for a, b in forest(near)]
    whole = np.zeros((len(left) + len(right),) * 2, dtype=bool)
    whole[: len(left), len(left) :] = near
    whole[len(left) :, : len(left)] = near.T
    every = left + right
    return [(int(names[every[a]]), int(names[every[b]])) for a, b in forest(whole)]


def _verified(sets: DataFrame, percent: int) -> DataFrame:
    """Spanning links ``a, b`` of rows ``cluster, block, blocks, name, items``."""
    bins = sets.sparkSession.conf.get("spark.sql.shuffle.partitions")
    spread = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        # Clusters of one block go several to a group, so that a group is worth a call.
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(4 * int(bins)))).otherwise(F.col("cluster")).alias("at"),
        (F.col("blocks") > 1).alias("large"),
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "cluster",
        "block",
        "name",
        "items",
    )

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("cluster")
        cluster, names, block = (table.column(c).to_numpy() for c in ("cluster", "name", "block"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        items = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for c in table.column("items").chunks for x in c]
        edges = np.flatnonzero(np.diff(cluster)) + 1
        links: list[tuple[int, int]] = []
        for a, b in zip([0, *edges], [*edges, len(cluster)], strict=True):
            links += block_links(names[a:b], items[a:b], block[a:b], i, j, percent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return spread.groupBy("at", "large", "i", "j").applyInArrow(work, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (``doc_id, text``; other columns are not read).

    Two documents are linked if ``100 * intersection >= percent * union`` of their sets of distinct shingles of ``width``
    words; a component is everything reachable, named by its smallest ``doc_id``. ``kept``: the row bears that name. A
    text without words, or null, has an empty set, is linked with nothing and is kept. Rows with equal texts are one
    class however many they are; repeated rows each give a row. A null ``doc_id`` never names a component that has another
    and counts as kept only where it has none. An empty table gives no rows.
    """
    slim = settle(sketched(docs, width), "sketches")
    some = slim.where("n_shingles > 0")
    classes = settle(
        some.groupBy("name").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes"
    )
    banded = classes.select("name", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("name").alias("least"), F.count("*").alias("members")).where("members > 1")
    touching = banded.join(least, "band").where("name <> least").select(F.col("name").alias("a"), F.col("least").alias("b"))
    cluster = components(touching).select(F.col("node").alias("name"), F.col("component").alias("cluster"))
    members = settle(classes.select("name", "rep", "n").join(cluster, "name"), "clusters")
    blocks = members.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    wanted = members.join(blocks, "cluster").select(
        F.xxhash64("rep").alias("key"), "name", "cluster", "blocks", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int").alias("block")
    )
    links = _verified(_sets_of(docs, wanted, width).join(wanted, ["key", "name"]), percent)
    groups = components(links).select(F.col("node").alias("name"), F.col("component").alias("group"))
    named = classes.select("name", "rep").join(groups, "name", "left").withColumn("group", F.coalesce("group", "name"))
    best = named.groupBy("group").agg(F.min("rep").alias("component_id"))
    known = named.join(best, "group").select("name", "component_id")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    out = some.select("doc_id", "n_shingles", "name").join(known, "name").select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
    return out.unionByName(
        slim.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    )


def deduplicated(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest ``doc_id``. All columns stay.

    Rows that agree in ``doc_id`` and text are one; texts without words are kept. Columns whose names clash do not matter.
    Ids that give up a row or come more than once go on a map of fixed size; rows that are not on it stay where they are,
    and only the others are joined.
    """
    found = settle(near_duplicates(docs, width, percent), "near-duplicates")
    key = F.xxhash64("doc_id")
    ids = found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.bool_and("kept").alias("whole"), F.bool_or("kept").alias("kept"))
    marks = docs.sparkSession.sparkContext.broadcast(bit_map(ids.where("rows > 1 OR NOT whole").select(key.alias("key"))))

    @F.arrow_udf("boolean")
    def listed(keys: pa.Array) -> pa.Array:
        return pa.array(on_map(marks.value, keys.to_numpy(zero_copy_only=False)))

    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text"), listed(key).alias("_listed"))
    kept = ids.where("kept").select(F.col("doc_id").alias("_id"))
    joined = rows.where("_listed").join(kept, F.col("_doc").eqNullSafe(F.col("_id")), "left_semi").dropDuplicates(["_doc", "_text"])
    return rows.where("NOT _listed").select("_row.*").unionByName(joined.select("_row.*"))
