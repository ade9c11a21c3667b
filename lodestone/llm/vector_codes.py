"""Vector code compression: product codes by exact integer rounds over Hilbert-sorted flat blocks.

A vector of integers is cut into parts, and each part position has a codebook. Per position the parts are sorted along
a Hilbert curve and laid in flat blocks with the least and the largest value of each component (a box) and the sum of
their vectors. In a round, an entry whose least distance from a block's box is more than some other entry's largest can
be nearest to nothing in the block; what is left is the block's shortlist. One entry left: it takes the whole block, by
its stored sum. More: a small integer kernel measures the block's vectors against the shortlist only.

Blocks are written once and read in place by every round; what moves in a round is a sum and a count per entry and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import settle, whole_numbers, with_group

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
BLOCK = 256  # vectors of a block
_EXACT = float(1 << 53)  # sums below are exact in doubles
_LONG = float(1 << 62)

Books = dict[tuple[int, int], np.ndarray]  # by length of the vectors and part position


def bounds(dim: int, parts: int = PARTS) -> list[int]:
    """Where parts begin and end: equal ones where ``parts`` divides ``dim``."""
    return [dim * p // parts for p in range(parts + 1)]


def hilbert(levels: np.ndarray, bits: int) -> np.ndarray:
    """Place on a Hilbert curve of rows of ``bits``-bit numbers, as one number of ``bits * d`` bits, 63 at most.

    Skilling's transform: from the highest bit down, an axis whose bit is set flips the first axis below that bit, and
    one whose bit is not set trades those bits with the first; Gray decoding follows.
    """
    x = levels.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            is_set = (x[i] & q) != 0
            traded = np.where(is_set, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(is_set, x[0] ^ low, x[0] ^ traded)
            x[i] ^= traded
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    place = np.zeros(x.shape[1], dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            place = (place << 1) | ((x[i] >> bit) & 1)
    return place


def _keys(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Order along the curve inside the box ``low .. high``. Of long parts the first 63 components count."""
    d = min(values.shape[1], 63)
    if d == 0:
        return np.zeros(len(values), dtype=np.int64)
    bits = max(1, min(8, 63 // d))
    span = np.maximum(high[:d].astype(float) - low[:d], 1)
    share = (values[:, :d].astype(float) - low[:d]) / span
    return hilbert(np.clip((share * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1), bits)


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries that can be nearest to some vector of the box, ties included."""
    c, low, high = book.astype(float), low.astype(float), high.astype(float)
    out = np.maximum(np.maximum(low - c, c - high), 0)
    far = np.maximum(np.abs(c - low), np.abs(high - c))
    least, most = np.einsum("ij,ij->i", out, out), np.einsum("ij,ij->i", far, far)
    return np.flatnonzero(least <= most.min() * (1 + 1e-9))


def nearest(values: np.ndarray, book: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of the entries ``some`` (ascending) to each row, ties to the lower, with the squared distance, in exact
    integers: by doubles, longs or Python's, as the largest sum allows."""
    entries = book[some]
    peak = max(float(np.abs(values.astype(float)).max(initial=0)), float(np.abs(entries.astype(float)).max(initial=0)))
    reach = 4 * peak * peak * max(values.shape[1], 1)
    kind = float if reach < _EXACT else np.int64 if reach < _LONG else object
    v, e = values.astype(kind), entries.astype(kind)
    if kind is float:
        d = (v * v).sum(axis=1)[:, None] - 2 * (v @ e.T) + (e * e).sum(axis=1)[None, :]
    else:
        d = np.stack([((v - row) ** 2).sum(axis=1) for row in e], axis=1)
    at = d.argmin(axis=1)
    return some[at], d[np.arange(len(v)), at]


def _array(values: pa.Array | pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    return np.array(values.to_pylist(), dtype=kind).reshape(len(values), width)


def _reach(low: np.ndarray, high: np.ndarray, n: int) -> float:
    """No sum of ``n`` components of a box is larger."""
    return n * max(float(np.abs(low.astype(float)).max(initial=0)), float(np.abs(high.astype(float)).max(initial=0)))


def _blocks(rows: DataFrame, parts: int, ranges: dict[int, tuple[list[int], list[int]]]) -> DataFrame:
    """``dim, part, rows, flat, low, high, total``: blocks of up to ``BLOCK`` neighbours on the curve."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                values = _array(some.column("q"), np.int64, int(dim))
                low, high = (np.array(x, dtype=np.int64) for x in ranges[int(dim)])
                cut = bounds(int(dim), parts)
                for part in range(parts):
                    s = slice(cut[part], cut[part + 1])
                    columns = [some.column("dim"), pa.array(np.full(len(some), part, np.int32)), pa.array(_keys(values[:, s], low[s], high[s]))]
                    columns += [some.column("row"), pa.array(list(values[:, s]), pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, ["dim", "part", "place", "row", "v"])

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], None  # parts of the block at hand
        for batch in batches:
            for dim, part, row, v in zip(*(batch.column(c).to_pylist() for c in ("dim", "part", "row", "v")), strict=True):
                if held and ((dim, part) != name or len(held) == BLOCK):
                    yield block(name, held)
                    held = []
                name = (dim, part)
                held.append((row, v))
        if held:
            yield block(name, held)

    def block(name: tuple[int, int], held: list) -> pa.RecordBatch:
        values = np.array([v for _, v in held], dtype=np.int64).reshape(len(held), -1)
        low, high = values.min(axis=0), values.max(axis=0)
        if _reach(low, high, len(held)) >= _LONG:
            raise OverflowError("a sum of components does not fit in a long")
        lists = [pa.array([x], pa.list_(pa.int64())) for x in ([r for r, _ in held], values.ravel(), low, high, values.sum(axis=0))]
        columns = [pa.array([name[0]], pa.int32()), pa.array([name[1]], pa.int32()), *lists]
        return pa.RecordBatch.from_arrays(columns, ["dim", "part", "rows", "flat", "low", "high", "total"])

    placed = rows.select("dim", "row", "q").mapInArrow(place, "dim int, part int, place long, row long, v array<long>")
    sorted_ = placed.repartitionByRange("dim", "part", "place", "row").sortWithinPartitions("dim", "part", "place", "row")
    schema = "dim int, part int, rows array<long>, flat array<long>, low array<long>, high array<long>, total array<long>"
    return settle(sorted_.mapInArrow(lay, schema), "blocks")


def _lists(values: pa.Array) -> list[np.ndarray]:
    """Each list of a column of longs."""
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(values.value_lengths().to_numpy(zero_copy_only=False))[:-1]) if len(values) else []


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Part, row numbers, vectors, box and sum of each block."""
    for batch in batches:
        names = zip(batch.column("dim").to_pylist(), batch.column("part").to_pylist(), strict=True)
        for name, rows, flat, low, high, total in zip(names, *(_lists(batch.column(c)) for c in ("rows", "flat", "low", "high", "total")), strict=True):
            yield name, rows, flat.reshape(len(rows), len(low)), low, high, total


def _round(blocks: DataFrame, books: Books) -> Books:
    """The codebooks after one round: each entry the mean of its parts, rounded down; unused ones as they are."""
    shipped = blocks.sparkSession.sparkContext.broadcast(books)

    def rows_of(held: dict) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (dim, part), (n, s) in held.items():
            for entry in np.flatnonzero(n):
                for column, x in zip(columns, (dim, part, entry, n[entry], s[entry].tolist()), strict=True):
                    column.append(x)
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["dim", "part", "entry", "n", "s"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, reach = {}, 0.0
        for name, rows, values, low, high, total in _each(batches):
            reach += _reach(low, high, len(rows))
            if reach >= _LONG:  # the sums at hand could pass a long
                yield rows_of(held)
                held, reach = {}, _reach(low, high, len(rows))
            book = shipped.value[name]
            n, s = held.setdefault(name, (np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)))
            some = shortlist(low, high, book)
            if len(some) == 1:
                n[some[0]] += len(rows)
                s[some[0]] += total
            else:
                at = nearest(values, book, some)[0]
                np.add.at(n, at, 1)
                np.add.at(s, at, values)
        yield rows_of(held)

    found = blocks.mapInArrow(work, "dim int, part int, entry int, n long, s array<long>")
    width = max((b.shape[1] for b in books.values()), default=0)
    each = [F.sum(F.get("s", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    new = {name: book.copy() for name, book in books.items()}
    for r in found.groupBy("dim", "part", "entry").agg(F.sum("n").alias("n"), *each).collect():  # a row per entry
        book = new[r["dim"], r["part"]]
        book[r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(book.shape[1])]
    shipped.unpersist()
    return new


def _assigned(blocks: DataFrame, books: Books) -> DataFrame:
    """``row, part, entry, distance`` of every part."""
    shipped = blocks.sparkSession.sparkContext.broadcast(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows, values, low, high, _ in _each(batches):
            book = shipped.value[name]
            at, d = nearest(values, book, shortlist(low, high, book))
            if len(d) and max(d) >= 1 << 63:
                raise OverflowError("a distance does not fit in a long")
            columns = [pa.array(rows), pa.array(np.full(len(rows), name[1], np.int32)), pa.array(at.astype(np.int32)), pa.array(d.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "part", "entry", "distance"])

    return blocks.mapInArrow(work, "row long, part int, entry int, distance long")


def fingerprint(books: Books, dim: int, parts: int = PARTS) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(str(x) for p in range(parts) for x in books[dim, p].ravel().tolist()).encode()).hexdigest()


def codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Books]:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every vector, and the codebooks.

    Vectors that are null or hold null or non-finite components are left out. Codebooks start as the parts of the
    ``entries`` smallest ``vec_id`` (null last; of repeated ids, by their numbers), fewer if there are fewer vectors.
    ``code`` has two hex digits a part. Vectors of different lengths have codebooks of their own; where ``parts`` does
    not divide a length, parts differ by one component. Repeated rows are rows of their own. A sum or a distance that
    does not fit in a long fails the job. An empty table gives no rows. The driver holds the codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    some = vectors.select("vec_id", "label", "embedding", F.monotonically_increasing_id().alias("row"))
    rows = settle(whole_numbers(some, scale, "vec_id", "label", "row").withColumn("dim", F.size("q")), "vectors")
    books: Books = {}
    ranges: dict[int, tuple[list[int], list[int]]] = {}
    sizes = rows.groupBy("dim").count().collect()
    for dim, n in sizes:
        mine = rows.where(F.col("dim") == dim)
        ends = [f(F.get("q", F.lit(i))).alias(f"{name}{i}") for i in range(dim) for name, f in (("low", F.min), ("high", F.max))]
        if ends:
            r = mine.agg(*ends).first()
            ranges[dim] = ([r[f"low{i}"] for i in range(dim)], [r[f"high{i}"] for i in range(dim)])
        else:
            ranges[dim] = ([], [])
        first = mine.orderBy(F.asc_nulls_last("vec_id"), "q").select("q").limit(entries).collect()
        start = np.array([r["q"] for r in first], dtype=np.int64).reshape(len(first), dim)
        cut = bounds(dim, parts)
        for p in range(parts):
            books[dim, p] = start[:, cut[p] : cut[p + 1]].copy()
    blocks = _blocks(rows, parts, ranges)
    for _ in range(rounds):
        books = _round(blocks, books)
    digits = [F.max(F.when(F.col("part") == p, F.col("entry"))).alias(f"p{p}") for p in range(parts)]
    per_row = _assigned(blocks, books).groupBy("row").agg(*digits, F.sum("distance").alias("error"))
    code = F.concat(*[F.lpad(F.lower(F.hex(f"p{p}")), 2, "0") for p in range(parts)])
    whole = settle(rows.select("row", "vec_id", "label", "dim").join(per_row.select("row", code.alias("code"), "error"), "row"), "codes")
    labels = settle(whole.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("size")), "labels")
    marks = {dim: fingerprint(books, dim, parts) for dim, _ in sizes}
    mark = F.element_at(F.create_map(*[F.lit(x) for pair in marks.items() for x in pair]), F.col("dim")) if marks else F.lit(None).cast("string")
    met = with_group(whole, labels, "label", "size", sum(n for _, n in sizes))
    return met.select("vec_id", "label", "code", "error", "label_error", mark.alias("codebooks_sha256")), books
