"""Quality by weak labels: heuristic labellers, an EM model of their accuracies, and a hashed linear scorer.

Each labeller says good, bad or nothing about a document. Expectation-maximisation over the counts of all vote patterns
(there are at most 3 to the number of labellers, however many documents) estimates how often each labeller says what
about good and bad documents, without any labels. The posteriors train a logistic scorer on hashed byte trigrams and
hashed steps of the document's statistics; the scorer decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import settle, text_of

TRAIN_ROWS = 4096  # distinct texts that the scorer is fitted on, about; chosen by hash among all
BUCKETS = 1 << 12
STEPS = 10  # of each statistic between 0 and 1
NOTHING, BAD, GOOD = 0, 1, 2

#: Statistic, at most this for good, more than this for bad, fewest words to say anything. In between nothing is said.
LABELLERS = (
    ("symbol_words", 0.01, 0.1, 3),
    ("capitals", 0.15, 0.4, 8),
    ("repeats", 0.05, 0.2, 8),
    ("bare_marks", 0.02, 0.1, 3),
    ("same_words", 0.5, 0.65, 30),
    ("top_word", 0.15, 0.25, 30),
    ("marks", 0.08, 0.15, 3),
    ("open_lines", 0.5, 0.8, 8),
)
STATISTICS = tuple(x[0] for x in LABELLERS)

_UPPER, _ALPHA, _MARK, _SIGN, _STOP = (np.zeros(256, dtype=bool) for _ in range(5))
_UPPER[65:91] = True
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
_SIGN[[ord(c) for c in "!#$%&*+<=>@[\\]^_`{|}~"]] = True
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_STOP[[ord(c) for c in ".!?:;\"')"]] = True


def _running(x: np.ndarray, kind: type | None = None) -> np.ndarray:
    """Sums of all stretches that begin with the first: one more than there are items, added up in one array."""
    out = np.zeros(len(x) + 1, dtype=kind or x.dtype)
    np.cumsum(x, out=out[1:])
    return out


def _counted(flag: np.ndarray) -> np.ndarray:
    return _running(flag, np.int32 if len(flag) < 1 << 31 else np.int64)


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shares from 0 to 1 (a row a text, in the order of ``STATISTICS``), and the number of words."""
    w = W.split(texts)
    n = len(w.offsets) - 1
    words = np.diff(w.first)
    some = np.maximum(words, 1)
    out = np.zeros((n, len(STATISTICS)))
    if not len(w.start):
        return out, words

    def sums(flag: np.ndarray) -> np.ndarray:
        run = _counted(flag)
        return run[w.offsets[1:]] - run[w.offsets[:-1]]

    def per_word(flag: np.ndarray) -> np.ndarray:
        run = _counted(flag)
        return run[w.end] - run[w.start]

    def share(flag: np.ndarray) -> np.ndarray:
        return np.bincount(w.text[flag], minlength=n) / some

    h = w.hashes()
    alnum = per_word(~_MARK[w.data])
    out[:, 0] = share(per_word(_SIGN[w.data]) >= 2)
    letters = sums(_ALPHA[w.data] & (w.data < 128))
    out[:, 1] = sums(_UPPER[w.data]) / np.maximum(letters, 1)
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (w.text[1:] == w.text[:-1])
    out[:, 2] = share(again)
    out[:, 3] = share(alnum == 0)
    for t in range(n):
        a, b = w.first[t], w.first[t + 1]
        if b > a:
            counts = np.unique(h[a:b], return_counts=True)[1]
            out[t, 4], out[t, 5] = 1 - len(counts) / (b - a), counts.max() / (b - a)
    out[:, 6] = sums(_MARK[w.data]) / np.maximum(sums(np.ones(len(w.data), dtype=bool)), 1)
    # Lines that end in no closing mark: the last word before a line break or the end of the text.
    line = _counted(w.data == 10)[1:][w.start]
    last = np.ones(len(h), dtype=bool)
    last[:-1] = (line[1:] != line[:-1]) | (w.text[1:] != w.text[:-1])
    open_ = last & ~_STOP[w.data[w.end - 1]]
    out[:, 7] = np.bincount(w.text[open_], minlength=n) / np.maximum(np.bincount(w.text[last], minlength=n), 1)
    return out, words


def votes(shares: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Each labeller's ``NOTHING``, ``BAD`` or ``GOOD``."""
    out = np.zeros(shares.shape, dtype=np.int64)
    for k, (_, good, bad, least) in enumerate(LABELLERS):
        out[:, k] = np.where(words < least, NOTHING, np.where(shares[:, k] > bad, BAD, np.where(shares[:, k] <= good, GOOD, NOTHING)))
    return out


def pattern(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


def unpacked(patterns: np.ndarray, labellers: int = len(LABELLERS)) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(labellers)[None, :] % 3


@dataclass
class LabelModel:
    """``says[k, c, v]``: how often labeller ``k`` says ``v`` of class ``c`` (0 bad, 1 good) when it says anything; ``prior`` of good.

    Saying nothing goes with short texts, not with bad ones, so it counts 1 for both classes.
    """

    prior: float
    says: np.ndarray

    def good(self, v: np.ndarray) -> np.ndarray:
        """Posterior probability of good."""
        log = np.log([1 - self.prior, self.prior])[None, :] + sum(np.log(self.says[k][:, v[:, k]]).T for k in range(v.shape[1]))
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -700, 700)))


def em(v: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Fit by expectation-maximisation, from majority votes on; one made-up vote of each kind keeps shares above 0."""
    good = 0.5 + 0.4 * np.sign((v == GOOD).sum(axis=1) - 3 * (v == BAD).sum(axis=1))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        says = np.stack([[np.bincount(v[:, k], weights=weight[c], minlength=3) + 1 for c in (0, 1)] for k in range(v.shape[1])])
        says /= says[:, :, BAD:].sum(axis=2, keepdims=True)
        says[:, :, NOTHING] = 1
        model = LabelModel(float(prior), says)
        now = model.good(v)
        if np.abs(now - good).max() < 1e-6:
            break
        good = now
    return model


def _hash_steps(shares: np.ndarray) -> np.ndarray:
    step = np.minimum(np.ceil(shares * STEPS), STEPS).astype(np.uint64)
    return (W.mix(step + (np.arange(shares.shape[1], dtype=np.uint64) << np.uint64(8))) % np.uint64(BUCKETS)).astype(np.int64)


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each byte trigram, and offsets of each text's stretch of them."""
    data, offsets = W.flat(texts)
    size = np.maximum(np.diff(offsets) - 2, 0)
    first = np.append(0, np.cumsum(size))
    if not first[-1]:
        return np.zeros(0, dtype=np.uint16), first
    wide = data.astype(np.uint32)
    h = (wide[:-2] * np.uint32(0x9E3779B1)) ^ (wide[1:-1] * np.uint32(0x85EBCA77)) ^ (wide[2:] * np.uint32(0xC2B2AE3D))
    h = ((h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 12)).astype(np.uint16)
    inside = np.ones(len(h), dtype=bool)
    for edge in (1, 2):
        at = offsets[1:-1] - edge
        inside[at[(at >= 0) & (at < len(h))]] = False
    short = np.flatnonzero(np.diff(offsets) < 2)  # their neighbours' trigrams would reach over them
    for t in short:
        lo = max(int(offsets[t]) - 2, 0)
        inside[lo : int(offsets[t + 1])] = False
    return h[inside], first


def features(texts: pa.Array) -> np.ndarray:
    """Dense rows of ``BUCKETS``: shares of the trigrams' buckets, scaled up, and one for each statistic's step."""
    h, first = _trigrams(texts)
    n = len(first) - 1
    size = np.diff(first)
    x = np.bincount(np.repeat(np.arange(n), size) * BUCKETS + h, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)
    x *= (_SCALE / np.maximum(size, 1)).astype(np.float32)[:, None]
    np.add.at(x, (np.arange(n)[:, None], _hash_steps(statistics(texts)[0])), np.float32(1))
    return x


_SCALE = 10.0


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def good(self, texts: pa.Array, shares: np.ndarray) -> np.ndarray:
        h, first = _trigrams(texts)
        size = np.diff(first)
        run = _running(self.weights[h])
        z = self.bias + _SCALE * (run[first[1:]] - run[first[:-1]]) / np.maximum(size, 1) + self.weights[_hash_steps(shares)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 0.5, shrink: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels by gradient descent with momentum; both classes weigh the same."""
    weight = np.where(y >= 0.5, 0.5 / max(float((y >= 0.5).sum()), 1), 0.5 / max(float((y < 0.5).sum()), 1)).astype(np.float32)
    w, b, vw, vb = np.zeros(x.shape[1], dtype=np.float32), 0.0, np.zeros(x.shape[1], dtype=np.float32), 0.0
    for _ in range(rounds):
        gap = weight * (1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50))) - y)
        vw, vb = 0.9 * vw - rate * (x.T @ gap + shrink * w), 0.9 * vb - rate * float(gap.sum())
        w, b = w + vw, b + vb
    return Scorer(w.astype(np.float64), b)


@dataclass
class Quality:
    labels: LabelModel
    scorer: Scorer


def train(docs: DataFrame, text: str = "text", rows: int = TRAIN_ROWS) -> Quality | None:
    """Fit on ``docs``: the label model on the votes of all rows, the scorer on about ``rows`` distinct texts. None without words."""
    name = F.xxhash64(text_of(text))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in W.chunks(texts):
                shares, words = statistics(texts.slice(a, b - a))
                kind = np.where(words > 0, pattern(votes(shares, words)), -1)
                yield pa.RecordBatch.from_arrays([batch.column("name").slice(a, b - a), pa.array(kind)], ["name", "votes"])

    seen = settle(docs.select(name.alias("name"), text_of(text).alias("text")).mapInArrow(look, "name bigint, votes bigint"), "votes").where("votes >= 0")
    counts = seen.groupBy("votes").count().toPandas()  # at most 3 ** labellers rows
    if counts.empty:
        return None
    labels = em(unpacked(counts["votes"].to_numpy()), counts["count"].to_numpy(dtype=float))
    distinct = seen.select("name").distinct().count()
    chosen = F.pmod(F.xxhash64("name", F.lit(4)), F.lit(1 << 30)) < int(min(1.0, rows / distinct) * (1 << 30))
    sample = docs.select(name.alias("name"), text_of(text).alias("text")).where(chosen).groupBy("name").agg(F.first("text").alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in W.chunks(texts):
                part = texts.slice(a, b - a)
                shares, words = statistics(part)
                x = features(part)
                at = [np.flatnonzero(row) for row in x]
                columns = [
                    pa.array(labels.good(votes(shares, words))),
                    pa.array(words),
                    pa.array([i.astype(np.int16) for i in at], pa.list_(pa.int16())),
                    pa.array([row[i] for row, i in zip(x, at, strict=True)], pa.list_(pa.float32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["good", "words", "at", "value"])

    def learn(table: pa.Table) -> pa.Table:
        table = table.filter(pc.greater(table.column("words"), 0))
        x = np.zeros((len(table), BUCKETS), dtype=np.float32)
        for row, (at, value) in enumerate(zip(table.column("at"), table.column("value"), strict=True)):
            x[row, np.asarray(at.values)] = np.asarray(value.values)
        scorer = fit(x, table.column("good").to_numpy().astype(np.float32))
        return pa.table({"weights": pa.array([scorer.weights]), "bias": pa.array([scorer.bias])})

    rows_ = sample.mapInArrow(vectors, "good double, words bigint, at array<smallint>, value array<float>")
    found = rows_.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(learn, "weights array<double>, bias double").first()
    return Quality(labels, Scorer(np.array(found["weights"]), found["bias"]))


def scored(docs: DataFrame, model: Quality | None, text: str = "text") -> DataFrame:
    """Add ``weak_label`` (posterior of good by the labellers), ``score`` (by the scorer) and ``good`` (score of 0.5 or more).

    A text without words, or null, gets 0 and is not good. Rows stay in place with all their columns; columns of these
    names are replaced. Texts are read whole.
    """

    @F.arrow_udf("struct<weak_label: double, score: double>")
    def work(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            weak, score = [np.zeros(0)], [np.zeros(0)]
            for a, b in W.chunks(batch):
                part = batch.slice(a, b - a)
                shares, words = statistics(part)
                some = words > 0
                weak.append(np.where(some, model.labels.good(votes(shares, words)), 0.0) if model else np.zeros(b - a))
                score.append(np.where(some, model.scorer.good(part, shares), 0.0) if model else np.zeros(b - a))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(weak)), pa.array(np.concatenate(score))], ["weak_label", "score"])

    kept = [c for c in docs.columns if c not in ("weak_label", "score", "good")]
    out = docs.select(F.struct(*kept).alias("row"), work(F.col(text)).alias("made"))  # in structs, so that no name clashes
    return out.select("row.*", "made.weak_label", "made.score", (F.col("made.score") >= 0.5).alias("good"))
