"""LM scoring with a gated recurrent network, all in NumPy inside Spark tasks.

Word counts come from all training documents. The most frequent words and, for all others, a bucket by their first byte
are the network's vocabulary; it is dealt into classes, and a word's probability is that of its class times that inside
the class (times, for the words of a bucket, their share by count, with room for a word never seen). The output biases
start as these frequencies, so training starts from the unigram model.

Each partition trains a copy on all its training documents by backpropagation through windows of ``WINDOW`` words; the
copies are averaged by the words they saw. Documents run side by side in lanes, one after another in each; the state is
carried from window to window and starts anew with each document, so scores are of whole documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import settle, text_of

VOCABULARY, BUCKETS, CLASSES, HIDDEN = 1024, 64, 32, 16
LOCAL = 1 << 19  # words whose counts go to every task: at most 8 MB; the rest are joined
WINDOW, LANES, RATE = 16, 512, 0.1
SEGMENT = 1024  # tokens after which training starts anew inside a text; scoring never does
BATCH = 4 << 20
END = np.uint64(0x656E642D6F66)  # stands for the end of a text
PART = 4096  # weights in a row while copies are averaged
_TIER = 8  # steps of counts to a power of two
_TRIES = 16  # words looked at one by one before a search


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of each text with ``END`` after each text, first byte of each, and first token of each text."""
    w = W.split(texts)
    n = len(w.offsets) - 1
    first = w.first + np.arange(n + 1)
    out, lead = np.empty(int(first[-1]), dtype=np.uint64), np.zeros(int(first[-1]), dtype=np.int64)
    at = np.ones(len(out), dtype=bool)
    at[first[1:] - 1] = False
    out[at], out[~at] = w.hashes(), END
    if len(w.start):
        byte = w.data[w.start].astype(np.int64)
        lead[at] = np.where((byte >= 65) & (byte <= 90), byte + 32, byte) % BUCKETS
    return out, lead, first


def counted(train: DataFrame) -> DataFrame:
    """``word, bucket, c`` of all tokens of training documents (``text``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tokens(batch.column("text").slice(a, b - a))[:2] for a, b in W.chunks(batch.column("text"), 4 * W.CHUNK)]
            if not found:
                continue
            for h, lead in found:
                names, count = np.unique(h, return_counts=True)
                bucket = np.empty(len(names), dtype=np.int16)
                bucket[Places(names).find(h)] = lead
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(bucket), pa.array(count)], ["word", "bucket", "c"])

    rows = train.select("text").mapInArrow(work, "word bigint, bucket smallint, c bigint")
    return rows.groupBy("word").agg(F.max("bucket").alias("bucket"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Words known to every task, sorted by hash: ``net`` with their network ids, and all others that are local, with counts.

    ``bucket_ids`` and ``end`` are network ids too. Ids run class by class: class ``k`` has the ids from ``edges[k]`` to
    ``edges[k + 1]``. ``share[b]`` is the base-10 logarithm of what the shares of the words of bucket ``b`` are divided by.
    """

    net: np.ndarray
    net_counts: np.ndarray
    net_ids: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    bucket_ids: np.ndarray
    end: int
    edges: np.ndarray
    frequency: np.ndarray
    share: np.ndarray
    total: int
    distinct: int

    @cached_property
    def places(self) -> tuple[Places, Places]:
        return Places(self.net), Places(self.words)

    def ids(self, h: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Network id of each token, and its place among ``net`` (-1: it goes by its bucket)."""
        place = self.places[0].find(h)
        return np.where(place >= 0, self.net_ids[place], self.bucket_ids[lead]), place

    def look(self, h: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each token, and whether it is known here. ``place`` as ``ids`` gives it."""
        c, known = self.net_counts[place], place >= 0
        other = np.flatnonzero(~known)
        at = self.places[1].find(h[other])
        c[other] = np.where(at >= 0, self.counts[at] if len(self.counts) else 0, 0)
        known[other] = at >= 0
        return c, known


class Places:
    """Places of tokens in sorted ``words``: their leading bits tell where to look, since hashes are spread evenly."""

    def __init__(self, words: np.ndarray) -> None:
        bits = max(1, int(len(words)).bit_length() + 1)
        self.words, self.shift = words, np.uint64(64 - bits)
        held = np.bincount((words >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.minimum(np.cumsum(held) - held, max(len(words) - 1, 0)).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each token, -1 if it is not there."""
        if not len(self.words):
            return np.full(len(h), -1)
        place = self.first[(h >> self.shift).view(np.int64)].astype(np.int64)
        found = self.words[place]
        behind = np.flatnonzero(found < h)
        for _ in range(_TRIES):
            behind = behind[place[behind] < len(self.words) - 1]
            if not len(behind):
                break
            place[behind] += 1
            found[behind] = now = self.words[place[behind]]
            behind = behind[now < h[behind]]
        else:
            # Words crowded on the same bits.
            place[behind] = np.minimum(np.searchsorted(self.words, h[behind]), len(self.words) - 1)
            found[behind] = self.words[place[behind]]
        place[found != h] = -1
        return place


def vocabulary(counts: DataFrame, size: int = VOCABULARY, classes: int = CLASSES, local: int = LOCAL) -> Vocabulary:
    """From ``counted``. The driver sees at most ``local`` words and ``BUCKETS`` sums."""
    tier = F.floor(F.log2("c") * _TIER).cast("int")
    tiers = sorted(((r["tier"], r["n"]) for r in counts.groupBy(tier.alias("tier")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, held = None, 0
    for t, n in tiers:
        if held + n > local:
            break
        least, held = t, held + n
    some = counts.where(tier >= least).toPandas() if least is not None else counts.limit(0).toPandas()
    whole = counts.groupBy("bucket").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    end = np.uint64(END).view(np.int64)
    words, c, bucket = some["word"].to_numpy(dtype=np.int64), some["c"].to_numpy(dtype=np.int64), some["bucket"].to_numpy(dtype=np.int64)
    best = np.lexsort((words, -c))
    best = best[words[best] != end][:size]
    n_b, v_b = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in whole:
        n_b[r["bucket"]], v_b[r["bucket"]] = r["c"], r["v"]
    total, distinct = int(n_b.sum()), int(v_b.sum())
    ended = counts.where(F.col("word") == int(end)).select("c").first()
    ends = ended["c"] if ended else 0
    n_b[0], v_b[0] = n_b[0] - ends, v_b[0] - (ends > 0)
    np.subtract.at(n_b, bucket[best], c[best])
    np.subtract.at(v_b, bucket[best], 1)
    # Frequencies of the network's vocabulary: words, buckets, end; dealt into classes of like mass of square roots.
    mass = np.concatenate([c[best], np.maximum(n_b, 0), [ends]]).astype(float) + 1
    order = np.argsort(-mass, kind="stable")
    level = np.cumsum(np.sqrt(mass[order]))
    group = np.minimum((level / level[-1] * classes).astype(np.int64), classes - 1)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(order)]])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    # The end is a word of the network like the others.
    net = np.append(words[best], end).view(np.uint64)
    by_hash = np.argsort(net)
    rest = np.setdiff1d(np.flatnonzero(words != end), best)
    rest = rest[np.argsort(words[rest].view(np.uint64))]
    return Vocabulary(
        net[by_hash], np.append(c[best], ends)[by_hash], np.append(number[: len(best)], number[-1])[by_hash],
        words[rest].view(np.uint64), c[rest], number[len(best) : len(best) + BUCKETS], int(number[-1]), edges,
        mass[order], np.log10(np.maximum(n_b, 0) + np.maximum(v_b, 0) + 1), total, distinct,
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In the place of ``x``."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _started(h: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """``h`` with nothing in the lanes that start anew."""
    anew = np.flatnonzero(fresh)
    if len(anew):
        h = h.copy()
        h[anew] = 0
    return h


def _sums(s: np.ndarray) -> np.ndarray:
    """Sums of columns, added in the order in which NumPy adds up a row, pair by pair: the same to the last bit."""
    n = len(s)
    if n > 128:
        half = n // 2 - n // 2 % 8
        return _sums(s[:half]) + _sums(s[half:])
    if n < 8:
        return s.sum(axis=0)
    part = s[: n - n % 8].reshape(-1, 8, s.shape[1]).sum(axis=0)
    for _ in range(3):
        part = part[::2] + part[1::2]
    total = part[0]
    for row in s[n - n % 8 :]:
        total = total + row
    return total


def _small(n: int) -> type:
    """A type for numbers below ``n``; stable sorts of short integers go by digits."""
    return np.uint16 if n <= 1 << 16 else np.int64


class Gru:
    """Weights: ``x`` gate inputs of each word, ``u`` recurrent, ``b`` gate biases, ``wc``/``bc`` classes, ``wo``/``bo`` words."""

    def __init__(self, edges: np.ndarray, frequency: np.ndarray, hidden: int = HIDDEN, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        v, k, self.edges = len(frequency), len(edges) - 1, edges
        part = np.add.reduceat(frequency, edges[:-1])
        shapes = {"x": (v, 3 * hidden), "u": (hidden, 3 * hidden), "wc": (hidden, k), "wo": (v, hidden)}
        self.w = {n: rng.normal(0, 0.1, s).astype(np.float32) for n, s in shapes.items()}
        self.w["wo"] *= 0
        self.w["wc"] *= 0
        self.w["b"] = np.zeros(3 * hidden, dtype=np.float32)
        self.w["bc"] = np.log(part / part.sum()).astype(np.float32)
        self.w["bo"] = np.log(frequency / np.repeat(part, np.diff(edges))).astype(np.float32)
        self.of = np.repeat(np.arange(k), np.diff(edges)).astype(_small(k))
        self.square = {n: np.full_like(a, 1e-3) for n, a in self.w.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[n].ravel() for n in sorted(self.w)])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for n in sorted(self.w):
            size = self.w[n].size
            self.w[n] = flat[at : at + size].reshape(self.w[n].shape).astype(np.float32)
            at += size

    def states(self, h: np.ndarray, inputs: np.ndarray, fresh: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States after each step (``steps x lanes x hidden``); ``fresh`` lanes start from nothing at that step."""
        d, u, b = len(self.w["u"]), self.w["u"], self.w["b"]
        out, trail = np.empty((*inputs.shape, d), dtype=u.dtype), []
        gates = (self.w["x"] + b).take(inputs, axis=0)
        for t in range(len(inputs)):
            h = _started(h, fresh[t])
            a = h @ u
            gate = gates[t]
            # Each gate in an array of its own: what follows then runs over whole arrays, not 16 numbers at a time.
            r = _sigmoid(gate[:, :d] + a[:, :d])
            z = _sigmoid(gate[:, d : 2 * d] + a[:, d : 2 * d])
            an = a[:, 2 * d :].copy()
            n = r * an
            n += gate[:, 2 * d :]
            np.tanh(n, out=n)
            if keep:
                trail.append((h, r, z, n, an))
            new = np.subtract(1, z)
            new *= n
            h = np.add(new, z * h, out=out[t])
        return out, trail

    def _by_class(self, k: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
        """The order that sorts classes ``k``, and for each class to be told apart: its stretch there, and its words."""
        cuts = np.append(0, np.cumsum(np.bincount(k, minlength=len(self.edges) - 1)))
        found = zip(cuts[:-1], cuts[1:], self.edges[:-1], self.edges[1:], strict=True)
        return np.argsort(k, kind="stable"), [(a, b, lo, hi) for a, b, lo, hi in found if a < b and hi - lo > 1]

    def output(self, h: np.ndarray, y: np.ndarray, grad: bool = False):
        """Natural log probability of each ``y`` after state ``h``; with ``grad`` also what the weights and ``h`` get."""
        w, k = self.w, self.of[y]
        columns, at = np.ascontiguousarray(h.T), np.arange(len(y))

        def chosen(s: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
            # A column for each of ``y``: largest values and sums then run along whole rows.
            s -= s.max(axis=0)
            log = s[row, at[: len(row)]]
            e = np.exp(s, out=s)
            total = _sums(e)
            log -= np.log(total)
            if not grad:
                return log, None
            e /= total
            e[row, at[: len(row)]] -= 1
            return log, np.ascontiguousarray(e.T)

        g, dh = {}, None
        log, dc = chosen(w["wc"].T @ columns + w["bc"][:, None], k)
        if grad:
            g["wc"], g["bc"], dh = h.T @ dc, dc.sum(axis=0), dc @ w["wc"].T
            g["wo"], g["bo"] = np.zeros_like(w["wo"]), np.zeros_like(w["bo"])
        # Sorted by class once, so that each class is a stretch.
        order = np.argsort(k, kind="stable")
        cuts = np.append(0, np.cumsum(np.bincount(k, minlength=len(self.edges) - 1)))
        columns, inside, log_word = columns.take(order, axis=1), y[order], np.zeros_like(log)
        states = h.take(order, axis=0) if grad else None
        dh_word = np.zeros_like(states) if grad else None
        for a, b, lo, hi in zip(cuts[:-1], cuts[1:], self.edges[:-1], self.edges[1:], strict=True):
            if a == b or hi - lo == 1:
                continue
            wo = w["wo"][lo:hi]
            log_word[a:b], e = chosen(wo @ columns[:, a:b] + w["bo"][lo:hi, None], inside[a:b] - lo)
            if grad:
                g["wo"][lo:hi], g["bo"][lo:hi] = e.T @ states[a:b], e.sum(axis=0)
                dh_word[a:b] = e @ wo
        log[order] += log_word
        if grad:
            dh[order] += dh_word
        return (log, g, dh) if grad else log

    def gradient(self, h: np.ndarray, inputs: np.ndarray, fresh: np.ndarray, y: np.ndarray, valid: np.ndarray):
        """Loss (sum of -log p over ``valid`` steps), its gradients through this window, and the last state."""
        d, u = len(self.w["u"]), self.w["u"]
        out, trail = self.states(h, inputs, fresh, keep=True)
        some = np.flatnonzero(valid.ravel())
        log, g, part = self.output(out.reshape(-1, d).take(some, axis=0), y.ravel()[some], grad=True)
        dh_out = np.zeros((inputs.size, d), dtype=np.float32)
        dh_out[some] = part
        dh_out = dh_out.reshape(out.shape)
        dg = np.empty((*inputs.shape, 3 * d), dtype=np.float32)
        g["u"], dh = np.zeros_like(u), np.zeros_like(h)
        for t in reversed(range(len(inputs))):
            before, r, z, n, an = trail[t]
            dh = dh + dh_out[t]
            rest = 1 - z
            dn = dh * rest
            dn *= 1 - n * n
            dz = before - n
            dz *= dh
            dz *= z
            dz *= rest
            dr = dn * an
            dr *= r
            dr *= 1 - r
            of, da = dg[t], np.empty((len(dh), 3 * d), dtype=dg.dtype)
            of[:, :d], of[:, d : 2 * d], of[:, 2 * d :] = dr, dz, dn
            da[:, : 2 * d] = of[:, : 2 * d]
            da[:, 2 * d :] = dn * r
            g["u"] += before.T @ da
            dh *= z
            dh += da @ u.T
            dh = _started(dh, fresh[t])
        flat, ids = dg.reshape(-1, 3 * d), inputs.ravel()
        g["b"] = flat.sum(axis=0)
        ids = ids.astype(_small(len(self.w["x"])))
        order = np.argsort(ids, kind="stable")
        sorted_ids = ids[order]
        first = np.flatnonzero(np.append(True, sorted_ids[1:] != sorted_ids[:-1]))
        g["x"] = np.zeros_like(self.w["x"])
        g["x"][sorted_ids[first]] = np.add.reduceat(flat.take(order, axis=0), first)
        return -float(log.sum()), g, out[-1]

    def step(self, g: dict[str, np.ndarray], n: int, rate: float) -> None:
        """Adagrad on the mean gradient, its length held to 1."""
        scale = 1 / max(n, 1)
        length = np.sqrt(sum(float((x * scale).ravel() @ (x * scale).ravel()) for x in g.values()))
        scale /= max(1.0, length)
        for k, x in g.items():
            x = x * np.float32(scale)
            self.square[k] += x * x
            self.w[k] -= np.float32(rate) * x / np.sqrt(self.square[k])


def segments(first: np.ndarray, longest: int = SEGMENT) -> np.ndarray:
    """Offsets of texts with those of over ``longest`` tokens cut up, for even lanes in training."""
    return np.append(np.concatenate([np.arange(a, b, longest) for a, b in zip(first[:-1], first[1:], strict=True)]), first[-1])


def windows(ids: np.ndarray, first: np.ndarray, end: int, lanes: int = LANES, width: int = WINDOW) -> Iterator[tuple]:
    """Texts dealt to lanes, window by window: (lanes still running, inputs, fresh, targets, valid, place of each target).

    The state that comes with a window is for its first ``lanes still running``. Lanes are in the order of their length, longest first, so the running ones are always the leading ones.
    """
    size = np.diff(first)
    n = max(1, min(lanes, len(size), int(size.sum()) // (4 * width)))
    # Long texts first, in turn and back: lanes of like length, without a search.
    order = np.argsort(-size, kind="stable")
    turn, at = np.divmod(np.arange(len(order)), n)
    lane = np.where(turn % 2 == 0, at, n - 1 - at)
    length = np.bincount(lane, weights=size[order], minlength=n).astype(np.int64)
    by_length = np.argsort(-length, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[by_length] = np.arange(n)
    texts = order[np.argsort(rank[lane], kind="stable")]
    sizes = size[texts]
    begin = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(begin, sizes) + np.repeat(first[texts], sizes)
    stream, fresh = ids[place], np.zeros(len(place), dtype=bool)
    fresh[begin] = True
    inputs = np.append(end, stream[:-1])
    inputs[begin] = end
    length = length[by_length]
    start = np.cumsum(length) - length
    t, whole = 0, n * width
    while len(length) and t < length[0]:
        live = int(np.searchsorted(-length, -t))
        # As few lanes are left, windows grow, so that each holds about as many words.
        steps = np.arange(t, min(t + min(max(width, whole // live), 16 * width), int(length[0])))
        t += len(steps)
        where = start[None, :live] + steps[:, None]
        valid = steps[:, None] < length[None, :live]
        where = np.where(valid, where, start[None, :live])
        yield live, np.where(valid, inputs[where], end), fresh[where] & valid, stream[where], valid, place[where]


def train(docs: DataFrame, vocab: Vocabulary, hidden: int = HIDDEN) -> Gru:
    """The average of the partitions' copies, each trained once over its documents (``text``)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocab)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        net, seen = Gru(v.edges, v.frequency, hidden), 0
        for batch in batches:
            texts = batch.column("text")
            for a, b in W.chunks(texts, BATCH):
                h, lead, first = tokens(texts.slice(a, b - a))
                ids, _ = v.ids(h, lead)
                state = np.zeros((LANES, hidden), dtype=np.float32)
                most = 0
                for live, inputs, fresh, y, valid, _ in windows(ids, segments(first), v.end):
                    _, g, last = net.gradient(state[:live], inputs, fresh, y, valid)
                    most = max(most, int(valid.sum()))  # small windows at the end count for less
                    net.step(g, most, RATE)
                    state[:live] = last
                seen += len(h)
        if seen:
            flat = net.flat()
            parts = [flat[i : i + PART] for i in range(0, len(flat), PART)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(parts))), pa.array([int(flat[:64].view(np.int32).sum()) % 64] * len(parts)), pa.array([float(seen)] * len(parts)), pa.array(parts, pa.list_(pa.float32()))],
                ["part", "branch", "seen", "weights"],
            )

    def mean(table: pa.Table) -> pa.Table:
        seen = table.column("seen").to_numpy()
        total = sum(s * np.asarray(x.values, dtype=np.float64) for s, x in zip(seen, table.column("weights"), strict=True))
        row = {"part": table.column("part")[:1], "seen": [float(seen.sum())], "weights": pa.array([(total / seen.sum()).astype(np.float32)], pa.list_(pa.float32()))}
        return pa.table(row)

    # In two rounds, so that a task gets a 64th of the copies of a part at a time.
    copies = docs.select("text").mapInArrow(work, "part bigint, branch bigint, seen double, weights array<float>")
    kind = "part bigint, seen double, weights array<float>"
    some = copies.groupBy("part", "branch").applyInArrow(mean, kind)
    rows = sorted(some.groupBy("part").applyInArrow(mean, kind).collect(), key=lambda r: r["part"])
    net = Gru(vocab.edges, vocab.frequency, hidden)
    if rows:
        net.load(np.concatenate([np.array(r["weights"], dtype=np.float32) for r in rows]))
    return net


def scores(docs: DataFrame, hidden: int = HIDDEN) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs`` (``doc_id, text``).

    Learns from the rows that are not held out. ``base_score`` is the add-one unigram score, ``score`` the network's, both
    base-10 logarithms of the probability of the whole text. A null text counts as empty and is one end token; a null id
    counts as an empty one; repeated rows each give a row; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_of().alias("text"), held_out().alias("held_out"), F.monotonically_increasing_id().alias("row"))
    training = rows.where(~F.col("held_out"))
    counts = settle(counted(training), "word-counts")
    vocab = vocabulary(counts)
    net = train(training, vocab, hidden)
    shared = spark.sparkContext.broadcast((vocab, net.flat()))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, flat = shared.value
        model = Gru(v.edges, v.frequency, hidden)
        model.load(flat)
        base = np.log10(v.total + v.distinct + 1)
        for batch in batches:
            texts = batch.column("text")
            for a, b in W.chunks(texts, BATCH):
                h, lead, first = tokens(texts.slice(a, b - a))
                ids, place = v.ids(h, lead)
                c, known = v.look(h, place)
                word = np.log10(c + 1.0)
                inside = np.where(place >= 0, 0.0, word - v.share[lead])
                log = np.zeros(len(h))
                state = np.zeros((LANES, hidden), dtype=np.float32)
                for live, inputs, fresh, y, valid, at in windows(ids, first, v.end):
                    out, _ = model.states(state[:live], inputs, fresh)
                    some = np.flatnonzero(valid.ravel())
                    log[at.ravel()[some]] = model.output(out.reshape(-1, hidden).take(some, axis=0), y.ravel()[some])
                    state[:live] = out[-1]
                rare_at = np.flatnonzero(~known)
                text = np.repeat(np.arange(b - a), np.diff(first))
                edges = np.searchsorted(rare_at, first).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(x).slice(a, b - a) for x in ("row", "doc_id", "held_out")),
                        pa.array(np.diff(first)),
                        pa.array(np.bincount(text, weights=c > 0, minlength=b - a).astype(np.int64)),
                        pa.array(np.bincount(text, weights=word - base, minlength=b - a)),
                        pa.array(np.bincount(text, weights=log / np.log(10) + inside, minlength=b - a)),
                        pa.ListArray.from_arrays(edges, pa.array(h[rare_at].view(np.int64))),
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"],
                )

    whole = rows.mapInArrow(
        work, f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, rare array<bigint>"
    )
    whole = settle(whole, "lm-scores")
    # Words that no task knows the count of: what they add is the same for both scores.
    rare = whole.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("n"))
    known = rare.join(counts.select("word", "c"), "word")
    added = known.groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("gain"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return whole.drop("rare").join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + zero("more")).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + zero("gain")).alias("base_score"),
        (F.col("score") + zero("gain")).alias("score"),
    )
