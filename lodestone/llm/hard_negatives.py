"""Hard negatives by cover trees over norm-augmented vectors.

A candidate gets one more component that brings every vector of its shard to the same length; the anchor's is zero.
Inner products then fall as distances grow, and a ball of the tree, a centre and the covering radius of all it holds,
bounds the inner product of everything inside from both sides. Each shard's tree is built once and kept as a row. The
anchors, in blocks, descend every tree best first: a node whose bounds lie outside all of the anchor's windows, or below
the scores these hold already, is left out with all below it; leaves are verified in exact integers.

Positives come first, the window open on both sides; each positive's score then sets the window for its negatives.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import settle, whole_numbers

SCALE = 256
SHARD, ANCHORS = 4096, 1024  # vectors of a tree and anchors of a block, about
LEAF = 48  # a node that holds so few is verified as it is
CHUNK = 128  # vectors that are verified first, about; twice as many each time after
CROWD = 4  # vectors of a ball, on average at least; a split into smaller ones saves nothing
BASE = 1.3  # covering radii shrink by this from level to level
_SLACK = 1e-9  # of the largest square involved: far above rounding, far below any radius
_EXACT = float(1 << 53)
_LONG = 1 << 63
_LAST = np.iinfo(np.int64).max


class Tree:
    """A cover tree as flat arrays. Node ``i`` covers the vectors ``order[start[i]:stop[i]]``; its children are the nodes
    ``first[i]`` up to ``last[i]``, none for a leaf. ``center[i]`` is a vector's place, ``radius[i]`` the largest
    distance from it to anything that the node covers."""

    def __init__(self, order, start, stop, first, last, center, radius) -> None:
        self.order, self.start, self.stop, self.first, self.last, self.center, self.radius = order, start, stop, first, last, center, radius


def augmented(vectors: np.ndarray) -> np.ndarray:
    """Vectors with a last component that makes all of them as long as the longest."""
    v = vectors.astype(float)
    squares = np.einsum("ij,ij->i", v, v)
    return np.column_stack([v, np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))])


def build(points: np.ndarray) -> Tree:
    """Level by level: the vectors under a node are covered by balls of its radius over ``BASE``, whose centres lie
    farther apart than that; each vector goes to its nearest centre. Where that makes nearly as many balls as there are
    vectors, as it does where all are about equally far apart, the node stays a leaf."""
    squares = np.einsum("ij,ij->i", points, points)
    tiny = _SLACK * float(squares.max(initial=0))
    order = np.arange(len(points))
    start, stop, first, last, center, radius = [0], [len(points)], [0], [0], [0], [0.0]
    if len(points):
        radius[0] = float(np.sqrt(((points - points[0]) ** 2).sum(axis=1)).max())
    at = 0
    while at < len(start):
        lo, hi = start[at], stop[at]
        if hi - lo > LEAF and radius[at] ** 2 > tiny:
            held = order[lo:hi].copy()
            here, norms = points[held], squares[held]

            def apart(i: int, here=here, norms=norms) -> np.ndarray:
                return norms + norms[i] - 2 * (here @ here[i])

            reach = (radius[at] / BASE) ** 2
            centers = [int(np.flatnonzero(held == center[at])[0])]
            best, owner = apart(centers[0]), np.zeros(len(held), dtype=np.int64)
            while best[far := int(best.argmax())] > reach and len(centers) * CROWD <= len(held):
                d = apart(far)
                nearer = d < best
                best[nearer], owner[nearer] = d[nearer], len(centers)
                best[far] = 0
                centers.append(far)
            if len(centers) * CROWD <= len(held):
                own = np.sqrt(((here - here[np.array(centers)[owner]]) ** 2).sum(axis=1))
                order[lo:hi] = held[np.argsort(owner, kind="stable")]
                ends = lo + np.cumsum(np.bincount(owner, minlength=len(centers)))
                radii = np.zeros(len(centers))
                np.maximum.at(radii, owner, own)
                first[at], last[at] = len(start), len(start) + len(centers)
                start += [lo, *ends[:-1].tolist()]
                stop += ends.tolist()
                first += [0] * len(centers)
                last += [0] * len(centers)
                center += held[centers].tolist()
                radius += radii.tolist()
        at += 1
    ints = [np.array(x, dtype=np.int64) for x in (start, stop, first, last, center)]
    return Tree(order, *ints, np.array(radius))


class Shard:
    """A tree with the numbers of its vectors, ready to be searched."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: list[str], tree: Tree) -> None:
        self.vectors, self.ids, self.rows, self.tree = vectors, ids, rows, tree
        self.codes = {label: i for i, label in enumerate(dict.fromkeys(labels))}
        self.labels = np.array([self.codes[label] for label in labels], dtype=np.int64)
        self.is_leaf = tree.first == tree.last
        points = augmented(vectors)
        self.square = float(np.einsum("ij,ij->i", points, points).max(initial=0))
        self.centers = vectors[tree.center].astype(float) if len(points) else points
        self.peak = float(np.abs(vectors.astype(float)).max(initial=0))
        self.floats = vectors.astype(float)

    def scores(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Exact inner products: in doubles where these are exact, else in Python's integers."""
        if self.peak * float(np.abs(query.astype(float)).max(initial=0)) * max(len(query), 1) < _EXACT:
            return self.floats[places] @ query.astype(float)
        return self.vectors[places].astype(object) @ query.astype(object)

    def search(self, query: np.ndarray, own: int, label: str, same: bool, windows: list[tuple], k: int) -> list[list[tuple]]:
        """For each window, both ends inside, the ``k`` best ``(score, place)`` with the same label or with another one.

        ``own`` is the number of the anchor's row, which is left out. Ties go to the smaller id.
        """
        tree, q = self.tree, query.astype(float)
        both = float(q @ q) + self.square
        tiny = _SLACK * both + 1e-6
        least, most = (np.array(x, dtype=float) for x in zip(*windows, strict=True))
        wanted = self.codes.get(label, -1)
        found: list[list[tuple]] = [[] for _ in windows]
        worst = np.full(len(windows), -np.inf)  # the last score that a full window holds
        heap: list[tuple] = []
        chunk, ticket = CHUNK, itertools.count()  # a ticket settles equal values

        def push(begin: int, end: int) -> None:
            """Put the children that an open window could take something from on the heap: inner nodes one by one, leaves
            as one run, best first."""
            d2 = both - 2 * (self.centers[begin:end] @ q)
            r = tree.radius[begin:end]
            near = np.maximum(np.sqrt(np.maximum(d2 - tiny, 0)) - r, 0)
            far = np.sqrt(np.maximum(d2, 0) + tiny) + r
            low, high = (both - far * far) / 2 - tiny, (both - near * near) / 2 + tiny
            taken = np.minimum(high[:, None], most + tiny)
            fits = (low[:, None] <= most) & (high[:, None] >= least) & (taken >= worst)
            value = np.where(fits, taken, -np.inf).max(axis=1)
            open_ = value > -np.inf
            leaf = self.is_leaf[begin:end]
            for i in np.flatnonzero(open_ & ~leaf).tolist():
                heapq.heappush(heap, (-value[i], next(ticket), begin + i, None))
            run = np.flatnonzero(open_ & leaf)
            if len(run):
                run = run[np.argsort(-value[run], kind="stable")]
                heapq.heappush(heap, (-value[run[0]], next(ticket), begin, (begin + run, value[run])))

        if len(self.ids):
            push(0, 1)
        while heap and -heap[0][0] >= worst.min():
            _, _, node, run = heapq.heappop(heap)
            if run is None:
                push(tree.first[node], tree.last[node])
                continue
            leaves, value = run
            sizes = tree.stop[leaves] - tree.start[leaves]
            n = int(np.searchsorted(np.cumsum(sizes), chunk)) + 1
            if len(leaves) > n:
                heapq.heappush(heap, (-value[n], next(ticket), node, (leaves[n:], value[n:])))
            begin, sizes = tree.start[leaves[:n]], sizes[:n]
            skipped = begin - np.append(0, np.cumsum(sizes)[:-1])
            self._verify(query, tree.order[np.arange(sizes.sum()) + np.repeat(skipped, sizes)], own, wanted, same, windows, k, found)
            worst = np.array([held[-1][0] if len(held) == k else -np.inf for held in found], dtype=float)
            chunk *= 2
        return found

    def _verify(self, query, places, own, wanted, same, windows, k, found) -> None:
        """The vectors at ``places`` by their exact scores."""
        alike = self.labels[places] == wanted
        places = places[(alike if same else ~alike) & (self.rows[places] != own)]
        scores = self.scores(query, places)
        limits = [max(least, held[-1][0]) if len(held) == k else least for (least, _), held in zip(windows, found, strict=True)]
        some = np.flatnonzero((scores >= min(limits)) & (scores <= max(most for _, most in windows)))
        places, scores = places[some], scores[some]
        for i, (limit, (_, most)) in enumerate(zip(limits, windows, strict=True)):
            inside = np.flatnonzero((scores >= limit) & (scores <= most))
            if len(inside) > k:
                inside = inside[np.lexsort((self.ids[places[inside]], -scores[inside]))[:k]]
            if len(inside):
                more = [(int(scores[j]), int(places[j])) for j in inside]
                found[i] = sorted(found[i] + more, key=lambda x: (-x[0], self.ids[x[1]]))[:k]


_TREE = "dim int, shard long, ids array<long>, rows array<long>, labels array<string>, flat array<long>, tree array<array<long>>, radius array<double>"


def _trees(rows: DataFrame) -> DataFrame:
    """A row per shard: its vectors and their tree."""

    def work(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        vectors = np.array(table.column("q").to_pylist(), dtype=np.int64).reshape(len(table), dim)
        tree = build(augmented(vectors))
        parts = [tree.order, tree.start, tree.stop, tree.first, tree.last, tree.center]
        lists = [table.column("vec_id").to_pylist(), table.column("row").to_pylist()]
        out = [pa.array([dim], pa.int32()), pa.array([table.column("shard")[0].as_py()], pa.int64()), *[pa.array([x], pa.list_(pa.int64())) for x in lists]]
        out += [pa.array([table.column("label").to_pylist()], pa.list_(pa.string())), pa.array([vectors.ravel()], pa.list_(pa.int64()))]
        out += [pa.array([[x.tolist() for x in parts]], pa.list_(pa.list_(pa.int64()))), pa.array([tree.radius], pa.list_(pa.float64()))]
        return pa.Table.from_arrays(out, names=[c.split()[0] for c in _TREE.split(", ")])

    return settle(rows.groupBy("dim", "shard").applyInArrow(work, _TREE), "trees")


def _shard(pair: pa.RecordBatch) -> Shard:
    """The tree of a one-row batch."""
    one = lambda name: pair.column(name).flatten()
    longs = lambda name: one(name).to_numpy(zero_copy_only=False)
    rows = longs("rows")
    vectors = longs("flat").reshape(len(rows), pair.column("dim")[0].as_py())
    ids = pc.fill_null(one("ids"), _LAST).to_numpy(zero_copy_only=False)
    tree = Tree(*(np.array(x.as_py(), dtype=np.int64) for x in one("tree")), longs("radius"))
    return Shard(vectors, ids, rows, one("labels").to_pylist(), tree)


def _search(trees: DataFrame, asked: DataFrame, shape: dict[int, tuple[int, int]], same: bool, k: int) -> DataFrame:
    """``row, window, vec_id, score``: the best ``k`` of each tree for each window of each anchor.

    ``asked`` is ``row, dim, q, label, windows(number, least, most)``. Blocks of anchors meet each tree; a pair of
    a block and a tree is one row, of bounded size on both sides.
    """
    blocks = F.element_at(F.create_map(*[F.lit(x) for d, (_, b) in shape.items() for x in (d, b)]), F.col("dim"))
    shards = F.element_at(F.create_map(*[F.lit(x) for d, (s, _) in shape.items() for x in (d, s)]), F.col("dim"))
    one = asked.select("dim", F.pmod(F.xxhash64("row"), blocks).cast("int").alias("block"), F.struct("row", "q", "label", "windows").alias("anchor"))
    packed = one.groupBy("dim", "block").agg(F.collect_list("anchor").alias("anchors"))
    tasks = min(max(sum(s * b for s, b in shape.values()), 1), 100_000)
    left = trees.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).repartition(tasks, "dim", "shard", "block")
    right = packed.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), shards.cast("long") - 1))).repartition(tasks, "dim", "shard", "block")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                pair = batch.slice(i, 1)
                shard, ids = _shard(pair), pair.column("ids").flatten()
                out: list[tuple] = []
                for anchor in pair.column("anchors")[0].as_py():
                    windows = [(w["least"], w["most"]) for w in anchor["windows"]]
                    query = np.array(anchor["q"], dtype=np.int64)
                    for w, held in zip(anchor["windows"], shard.search(query, anchor["row"], anchor["label"], same, windows, k), strict=True):
                        for score, place in held:
                            if not -_LONG <= score < _LONG:
                                raise OverflowError("a score does not fit in a long")
                            out.append((anchor["row"], w["number"], ids[place].as_py(), score))
                columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4
                yield pa.RecordBatch.from_arrays(columns, ["row", "window", "vec_id", "score"])

    return left.join(right, ["dim", "shard", "block"]).mapInArrow(work, "row long, window long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``vectors(vec_id, embedding, label)``.

    ``is_anchor`` is worked out on ``vec_id``. Scores are integer inner products of ``floor(256 * x)``; higher ones come
    first, ties by the smaller ``vec_id`` (null last). An anchor's positives are its first other rows of the same
    label. For each of them the first rows of other labels are returned whose score lies between ``least_percent`` of
    the positive's and the positive's own; a positive below zero has none. Rows with a null label or vector, or a null
    or non-finite component, take no part. Only vectors of the anchor's own length are compared with it. Repeated rows
    are rows of their own, so a repeated anchor returns its rows twice. Labels are compared as strings. A score that
    does not fit in a long fails the job. An empty table gives no rows.
    """
    rows = whole_numbers(vectors.where("label is not null"), SCALE, "vec_id", F.col("label").cast("string").alias("label"))
    rows = settle(rows.select("vec_id", "label", "q", F.size("q").alias("dim"), F.monotonically_increasing_id().alias("row")), "vectors")
    rows = rows.withColumn("asks", F.coalesce(is_anchor, F.lit(False)))
    counts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asks").alias("a")).collect()  # a row per length
    shape = {r["dim"]: (math.ceil(r["n"] / SHARD), math.ceil(r["a"] / ANCHORS)) for r in counts if r["a"]}
    if not shape:
        empty = rows.where(F.lit(False)).select(F.col("vec_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.lit(1).alias("rank"))
        return empty.select("*", *[F.lit(None).cast("long").alias(c) for c in ("negative_id", "positive_score", "negative_score")])
    rows = rows.where(F.col("dim").isin(list(shape)))
    shards = F.element_at(F.create_map(*[F.lit(x) for d, (s, _) in shape.items() for x in (d, s)]), F.col("dim"))
    trees = _trees(rows.withColumn("shard", F.pmod(F.xxhash64("row"), shards.cast("long"))).select("dim", "shard", "vec_id", "label", "row", "q"))
    anchors = rows.where("asks")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("number"), F.lit(-_LONG).alias("least"), F.lit(_LONG - 1).alias("most")))
    first = _search(trees, anchors.select("row", "dim", "q", "label", whole.alias("windows")), shape, True, positives)
    near = settle(_best(first, positives).select("row", F.col("rank").cast("long").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    share = (F.col("positive_score").cast("decimal(38,0)") * least_percent / 100)
    window = F.struct(F.col("window").alias("number"), F.ceil(share).cast("long").alias("least"), F.col("positive_score").alias("most"))
    asked = near.where("positive_score >= 0").groupBy("row").agg(F.collect_list(window).alias("windows"))  # ``positives`` of them
    second = _search(trees, anchors.select("row", "dim", "q", "label").join(asked, "row"), shape, False, negatives)
    best = _best(second, negatives).withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score")
    named = best.join(near, ["row", "window"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
