"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are cut where a space follows another character (no piece reaches over such a place), and the
distinct chunks are written one after another. A suffix array over that text, sorted as deep as the longest piece, finds
all occurrences of every piece of the vocabulary by binary search. Each occurrence is an edge from its start to its end;
edges are sorted by position and relaxed from left to right. The models at hand are BPE models, so an edge is relaxed
not by a sum of scores but if its piece may follow the last piece of the prefix before it, that is, if merging their
characters by score gives just these two. One edge into each position passes, and the path is the library's encoding.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from . import words as W

SPACE = "▁"
BATCH = 1 << 19  # bytes of text indexed at a time
IDS = 1 << 19  # ids turned to text at a time
LONG = 64  # characters; a longer chunk is relaxed by itself, since the others wait for no one
_NONE, _START = -3, -1
_SLOTS = 21


class Model:
    """A SentencePiece BPE model's vocabulary in the order of its merges.

    Tokens are numbered with single characters first, then pieces by score. ``left`` and ``right`` are the two tokens
    that merge into a token; ``ids[t]`` are the ids it stands for (a character without a piece stands for its bytes).
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            model = pb.ModelProto.FromString(f.read())
        norm, kind = model.normalizer_spec, model.trainer_spec
        if kind.model_type != kind.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("a BPE model that keeps its text as it is is needed")
        self.prefix = norm.add_dummy_prefix
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == p.UNKNOWN)
        self.byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == p.BYTE}
        self.out = [b"" if p.type == p.CONTROL else b" \xe2\x81\x87 " if p.type == p.UNKNOWN else bytes([int(p.piece[1:-1], 16)]) if p.type == p.BYTE else p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        if any(p.type == p.USER_DEFINED for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        normal = {p.piece: (-p.score, i) for i, p in enumerate(model.pieces) if p.type == p.NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("pieces with a space inside are not supported")
        self.score = {p: s for p, (s, _) in normal.items()}
        self.id = {p: i for p, (_, i) in normal.items()}
        chars = sorted({c for p in normal for c in p})
        merged = sorted((p for p in normal if len(p) > 1 and p.strip(SPACE)), key=lambda p: normal[p])
        self.text = [*chars, *merged]
        self.base = len(chars)
        self.token = {p: t for t, p in enumerate(self.text)}
        self.ids = [self.single(c) for c in chars] + [[normal[p][1]] for p in merged]
        self.left, self.right, self.pair = list(range(len(self.text))), list(range(len(self.text))), {}
        live = np.zeros(len(self.text), dtype=bool)
        live[: self.base] = True
        for t in range(self.base, len(self.text)):
            piece = self.text[t]
            for i in range(1, len(piece)):
                a, b = self.token.get(piece[:i]), self.token.get(piece[i:])
                if a is not None and b is not None and a < t and b < t and live[a] and live[b] and self.follows(a, b):
                    self.left[t], self.right[t], self.pair[(a, b)], live[t] = a, b, t, True
                    break
        self.n = len(self.text)
        keys = np.array([a * self.n + b for a, b in self.pair], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_key, self.pair_token = keys[order], np.array(list(self.pair.values()), dtype=np.int64)[order]
        self.lefts, self.rights = np.array(self.left, dtype=np.int64), np.array(self.right, dtype=np.int64)
        self.known, self.fits = np.full(1 << _SLOTS, -1, dtype=np.int64), np.zeros(1 << _SLOTS, dtype=bool)
        code = {c: i + 1 for i, c in enumerate(chars)}
        self.codes = np.zeros(0x110000, dtype=np.uint16)
        self.codes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.tokens = np.flatnonzero(live)
        self.size = np.array([len(self.text[t]) for t in self.tokens], dtype=np.int64)
        self.depth = -(-int(self.size.max()) // 4)
        self.packed = np.zeros((len(self.tokens), self.depth), dtype=np.uint64)
        self.mask = np.zeros_like(self.packed)
        for row, t in enumerate(self.tokens):
            for i, c in enumerate(self.text[t]):
                shift = np.uint64(48 - 16 * (i % 4))
                self.packed[row, i // 4] |= np.uint64(code[c]) << shift
                self.mask[row, i // 4] |= np.uint64(0xFFFF) << shift
        self.flat_ids = np.array([i for x in self.ids for i in x], dtype=np.int32)
        self.n_ids = np.array([len(x) for x in self.ids], dtype=np.int64)
        self.first_id = np.cumsum(self.n_ids) - self.n_ids
        self.out_bytes = np.frombuffer(b"".join(self.out), dtype=np.uint8)
        self.out_size = np.array([len(x) for x in self.out], dtype=np.int64)
        self.out_first = np.cumsum(self.out_size) - self.out_size

    def single(self, char: str) -> list[int]:
        return [self.id[char]] if char in self.id else [self.byte.get(b, self.unknown) for b in char.encode()] if self.byte else [self.unknown]

    def follows(self, a: int, b: int) -> bool:
        """Whether merging by score leaves ``a`` and ``b`` apart: undo their merges, latest first, and look for an earlier one across."""
        limit = len(self.text)
        while True:
            if self.pair.get((a, b), limit) < limit:
                return False
            if a > b:
                if (c := self.right[a]) != a:
                    limit, a = a, c
                elif (c := self.left[b]) != b:
                    limit, b = b + 1, c
                else:
                    return True
            elif (c := self.left[b]) != b:
                limit, b = b + 1, c
            elif (c := self.right[a]) != a:
                limit, a = a, c
            else:
                return True

    def follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``follows`` for many pairs."""
        out = np.zeros(len(a), dtype=bool)
        at, limit = np.arange(len(a)), np.full(len(a), self.n, dtype=np.int64)
        a, b = a.copy(), b.copy()
        while len(at):
            key = a * self.n + b
            place = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            crossed = (self.pair_key[place] == key) & (self.pair_token[place] < limit)
            split_a, split_b = self.rights[a], self.lefts[b]
            can_a, can_b = split_a != a, split_b != b
            use_a = can_a & ((a > b) | ~can_b)
            ended = crossed | ~(can_a | can_b)
            out[at[ended & ~crossed]] = True
            limit = np.where(use_a, a, b + 1)
            a, b = np.where(use_a, split_a, a), np.where(use_a, b, split_b)
            at, a, b, limit = at[~ended], a[~ended], b[~ended], limit[~ended]
        return out

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``follow`` with a memory of fixed size: a pair has one slot there, and the last pair worked out keeps it."""
        key = a * self.n + b
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)).astype(np.int64)
        out = self.fits[slot]
        new = np.flatnonzero(self.known[slot] != key)
        if len(new):
            pairs, where = np.unique(key[new], return_inverse=True)
            fits = self.follow(pairs // self.n, pairs % self.n)
            out[new] = fits[where]
            self.known[slot[new]], self.fits[slot[new]] = key[new], out[new]
        return out

    @lru_cache(maxsize=1024)  # noqa: B019  a model lives as long as its worker
    def run(self, n: int) -> list[int]:
        """Ids of ``n`` spaces in a row, whose pieces share one score: the leftmost merge comes first."""
        return self.by_merging(SPACE * n)

    def by_merging(self, text: str) -> list[int]:
        """Ids by merging the best pair again and again, the leftmost of equals first."""
        sym, after, before = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(sym) and (p := sym[i] + sym[after[i]]) in self.score:
                heapq.heappush(heap, (self.score[p], i, p))

        for i in range(len(sym)):
            offer(i)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = after[i]
            if j >= len(sym) or not sym[i] or sym[i] + sym[j] != p:
                continue
            sym[i], sym[j], after[i] = p, "", after[j]
            if after[j] < len(sym):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for s in sym if s for x in ([self.id[s]] if s in self.id else self.single(s))]


def suffixes(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of the ``4 * depth`` characters that follow, and the characters packed by fours."""
    n = len(codes)
    packed = np.zeros(n + 4 * depth, dtype=np.uint64)
    wide = np.zeros(n + 3, dtype=np.uint64)
    wide[:n] = codes
    for i in range(4):
        packed[:n] |= wide[i : n + i] << np.uint64(48 - 16 * i)
    del wide
    order = np.argsort(packed[:n])
    key, reach = packed[:n], 4
    while reach < 4 * depth:
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        later = np.zeros(n, dtype=np.int64)
        later[: n - reach] = rank[reach:] if reach < n else 0
        key = rank * (n + 2) + later
        order = np.argsort(key)
        reach *= 2
    return order, packed


def occurrences(model: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All edges of ``codes``: start, length and token, by binary search of every piece among the suffixes."""
    order, packed = suffixes(codes, model.depth)

    # The first four characters give a piece's range; a longer piece is looked for inside.
    ordered = packed[order]
    lowest, above = np.searchsorted(ordered, model.packed[:, 0]), np.searchsorted(ordered, model.packed[:, 0] | ~model.mask[:, 0], side="right")
    del ordered
    longer = model.mask[:, 1:].any(axis=1)

    def bound(upper: bool) -> np.ndarray:
        lo, hi = lowest.copy(), above.copy()
        lo[~longer] = hi[~longer] = (above if upper else lowest)[~longer]
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            at, less, same = order[mid], np.zeros(len(open_), dtype=bool), np.ones(len(open_), dtype=bool)
            for k in range(1, model.depth):
                here = packed[at + 4 * k] & model.mask[open_, k]
                less |= same & (here < model.packed[open_, k])
                same &= here == model.packed[open_, k]
            below = less | same if upper else less
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)

    lo, hi = bound(False), bound(True)
    count = hi - lo
    begin = np.cumsum(count) - count
    order = order.astype(np.int32)
    del packed
    place = np.repeat((lo - begin).astype(np.int32), count)
    place += np.arange(len(place), dtype=np.int32)
    return order[place], np.repeat(model.size.astype(np.int32), count), np.repeat(model.tokens.astype(np.int32), count)


def relax(model: Model, codes: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and token of every piece of the encodings of all chunks; token -2 is a character that no piece has."""
    n = len(codes)
    start, size, token = occurrences(model, codes)
    bare = np.flatnonzero(codes == 0)
    ends = np.zeros(n, dtype=bool)
    ends[end] = True
    bare = bare[~ends[bare]]  # separators stand at the ends
    if len(bare):
        start = np.concatenate([start, bare.astype(np.int32)])
        size = np.concatenate([size, np.ones(len(bare), dtype=np.int32)])
        token = np.concatenate([token, np.full(len(bare), -2, dtype=np.int32)])
    owner = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, n)))
    inside = np.arange(n, dtype=np.int32) - first.astype(np.int32)[owner]
    last, step = np.full(n + 1, _NONE, dtype=np.int32), np.zeros(n + 1, dtype=np.int32)
    last[first] = _START
    long = (end - first > LONG)[owner[start]]
    wave = inside[start] + size
    del inside
    for group, stretch in ((np.flatnonzero(~long).astype(np.int32), None), (np.flatnonzero(long), owner)):
        if stretch is None:
            group = group[np.argsort(wave[group].astype(np.uint8), kind="stable")]  # a radix sort
            cuts = np.flatnonzero(np.diff(wave[group])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(group)], strict=True):
                e = group[a:b]
                prior = last[start[e]]
                good = prior != _NONE
                test = np.flatnonzero((prior >= 0) & (token[e] >= 0))
                if len(test):
                    good[test] = model.fit(prior[test].astype(np.int64), token[e][test].astype(np.int64))
                e = e[good]
                last[start[e] + size[e]], step[start[e] + size[e]] = token[e], size[e]
        else:
            # Edges of long chunks: the tests for all neighbours that may come up would be too many, so one by one.
            for e in group[np.lexsort((size[group], start[group] + size[group]))].tolist():
                s, t = int(start[e]), int(token[e])
                prior = int(last[s])
                if prior != _NONE and (prior < 0 or t < 0 or model.follows(prior, t)):
                    last[s + size[e]], step[s + size[e]] = t, size[e]
    places, tokens = [], []
    live = np.flatnonzero(end > first)
    at = end[live]
    while len(at):
        tokens.append(last[at])
        at = at - step[at]
        places.append(at)
        more = at > first[live]
        at, live = at[more], live[more]
    places, tokens = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (places, tokens))
    order = np.argsort(places)
    return places[order], tokens[order]


def encode(model: Model, texts: pa.Array) -> pa.Array:
    """Ids of each text (null: none) as ``list<int32>``."""
    texts = texts.cast(pa.large_string()).fill_null("")
    texts = pc.replace_substring(texts, SPACE, " ")
    if model.prefix:
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
    data, offsets = W.flat(texts)
    if not len(data):
        return pa.ListArray.from_arrays(np.zeros(len(texts) + 1, dtype=np.int32), pa.array([], pa.int32()))
    gap = data == 32
    cut = gap.copy()
    cut[1:] &= ~gap[:-1]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.append(np.flatnonzero(cut), len(data))
    pieces = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)).dictionary_encode()
    chunk_of, distinct = pieces.indices.to_numpy(), pieces.dictionary
    flat, count = encode_chunks(model, distinct)
    first = np.cumsum(count) - count
    sizes = count[chunk_of]
    begin = np.cumsum(sizes) - sizes
    at = np.repeat(first[chunk_of] - begin, sizes)
    at += np.arange(len(at))
    ids = flat[at]
    bounds = np.append(begin, len(ids))[np.searchsorted(starts[:-1], offsets)]
    return pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(ids))


def encode_chunks(model: Model, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and their number for each distinct chunk (spaces, then no space). All spaces but the last are a run by themselves."""
    bare = pc.utf8_ltrim(chunks, " ")
    lead = pc.subtract(pc.utf8_length(chunks), pc.utf8_length(bare)).to_numpy().astype(np.int64)
    one = pc.binary_join_element_wise(pc.if_else(pa.array(lead > 0), SPACE, ""), bare.cast(pa.string()), "")
    length = pc.utf8_length(one).to_numpy().astype(np.int64)
    points = np.frombuffer("\0".join(one.to_pylist()).encode("utf-32-le") + b"\0\0\0\0", dtype=np.uint32)
    codes = model.codes[points]
    first = np.cumsum(length + 1) - (length + 1)
    end = first + length
    codes[end] = 0
    place, token = relax(model, codes, first, end)
    owner = np.searchsorted(first, place, side="right") - 1
    # Each token's ids: the vocabulary's, then those of the characters here that no piece has.
    bare_at = np.flatnonzero(token == -2)
    odd, which = np.unique(points[place[bare_at]], return_inverse=True)
    parts = [model.single(chr(x)) for x in odd.tolist()]
    token = token.astype(np.int64)
    token[bare_at] = model.n + which
    sizes = np.concatenate([model.n_ids, np.array([len(x) for x in parts], dtype=np.int64)])
    flat = np.concatenate([model.flat_ids, np.array([i for x in parts for i in x], dtype=np.int32)])
    firsts = np.cumsum(sizes) - sizes
    n = sizes[token]
    at = np.repeat(firsts[token] - (np.cumsum(n) - n), n)
    at += np.arange(len(at))
    ids = flat[at]
    count = np.bincount(owner, weights=n, minlength=len(one)).astype(np.int64)
    runs = np.flatnonzero(lead > 1)
    if not len(runs):
        return ids, count
    # Runs of spaces: the last space of a run belongs to the word after it, if they merge; the others are a run.
    begin = np.cumsum(count) - count
    alone = (length[runs] > 0) & (token[np.searchsorted(place, first[runs])] == model.token.get(SPACE, -9))
    out, at = [], 0
    for c, single in zip(runs.tolist(), alone.tolist()):
        run = model.run(int(lead[c]) - (not single))
        out += [ids[at : begin[c]], np.array(run, dtype=np.int32)]
        at = int(begin[c]) + int(single)
        count[c] += len(run) - int(single)
    return np.concatenate([*out, ids[at:]]).astype(np.int32), count


def decode(model: Model, ids: pa.Array) -> pa.Array:
    """Texts of lists of ids; bytes that are no UTF-8 become U+FFFD."""
    ids = ids.cast(pa.list_(pa.int32()))
    null = ids.is_null().to_numpy(zero_copy_only=False)
    bounds = ids.offsets.to_numpy()
    flat = ids.values.to_numpy(zero_copy_only=False)
    texts, at = [], 0
    while at < len(ids):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + IDS, side="right")) - 1)
        some = flat[bounds[at] : bounds[end]]
        size = model.out_size[some]
        begin = np.append(np.cumsum(size) - size, size.sum())
        data = model.out_bytes[np.arange(begin[-1]) + np.repeat(model.out_first[some] - begin[:-1], size)]
        raw, edge = data.tobytes(), begin[bounds[at : end + 1] - bounds[at]].tolist()
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            led = model.prefix and a < b and raw[a] == 32  # the space put before each text
            texts.append(raw[a + led : b].decode("utf-8", "replace"))
        at = end
    return pa.array(texts, pa.string(), mask=null)


@lru_cache(maxsize=2)
def model_at(path: str) -> Model:
    return Model(path)


def encoded(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add ``ids``: the SentencePiece ids of each whole text, as the library gives them, without begin or end.

    With ``decoded`` a column of that name says what the ids stand for, made in the same pass. A null text counts as
    empty: no ids, decoded to an empty text. Rows stay in place, with all columns; columns of these names are replaced.
    ``model`` is the path of a model file that every node has. Rows come back in small batches, so neither side holds more
    than a stretch of texts beside what it was handed.
    """
    kept = [f for f in docs.schema.fields if f.name not in (ids, decoded)]
    names = [f.name for f in kept]
    schema = StructType([*kept, StructField(ids, ArrayType(IntegerType()))] + ([StructField(decoded, StringType())] if decoded else []))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_at(model)
        for batch in batches:
            texts = batch.column(text)
            for a, b in W.chunks(texts, BATCH):
                found = encode(m, texts.slice(a, b - a))
                part = batch.slice(a, b - a)
                more = [found, decode(m, found)] if decoded else [found]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + more, schema.names)

    return docs.select(*names).mapInArrow(work, schema)


def decoded(docs: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: what lists of ids stand for. Null lists give null; a column of that name is replaced."""

    @F.arrow_udf("string")
    def work(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model_at(model)
        for batch in lists:
            yield decode(m, batch)

    return docs.withColumn(text, work(F.col(ids)))
