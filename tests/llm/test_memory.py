"""What a Python worker of the pipeline holds at once."""

import tracemalloc

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from lodestone.llm import pieces, quality
from lodestone.llm import words as W

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def texts(n, seed=1):
    """Texts of some 2 KB, of words that are mostly new."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("etaoinshrdlucmfw"))
    return pa.array([" ".join("".join(letters[rng.integers(0, 16, size)]) for size in rng.integers(2, 10, 300)) for _ in range(n)])


def most(work):
    tracemalloc.start()
    work()
    found = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return found / 2**20


def test_a_worker_indexes_short_stretches_of_text():
    model, given = pieces.Model(MODEL), texts(1200)
    assert size_of(given) > 2 << 20

    def work():
        for a, b in W.chunks(given, pieces.BATCH):
            pieces.encode(model, given.slice(a, b - a))

    assert most(work) < 96  # MB; 232 with stretches of 2 MB, 50 now


def size_of(given):
    return int(W.flat(given)[1][-1])


def test_quality_scores_hold_few_numbers_a_byte():
    given, scorer = texts(1200), quality.Scorer(np.zeros(quality.BUCKETS), 0.0)
    a, b = next(W.chunks(given))
    part = given.slice(a, b - a)
    assert most(lambda: scorer.good(part, quality.statistics(part)[0])) < 21 * size_of(part) / 2**20  # 24 with wider numbers, 18 now


@pytest.mark.parametrize("chars", ["ab", "é漢字☃\0▁", "    x"])
def test_pieces_of_odd_letters_are_the_librarys(chars):
    """Pieces of one to four characters, longer ones, and characters that no piece has, by the range of their first four."""
    rng = np.random.default_rng(5)
    model, library = pieces.Model(MODEL), SentencePieceProcessor(model_file=MODEL)
    letters = list(chars + "the ing ")
    given = ["".join(letters[i] for i in rng.integers(0, len(letters), n)) for n in [0, 1, 2, 3, 4, 5, 9, 60, 500] * 3]
    given = [x.replace("\0", "") for x in given]
    assert pieces.encode(model, pa.array(given)).to_pylist() == library.encode(given)


@pytest.mark.parametrize(("before", "after"), [("10000", "2048"), ("0", "2048"), ("100", "100")])
def test_the_pipeline_sends_batches_of_bounded_rows(spark, before, after):
    was = spark.conf.get(corpus_pipeline.BATCH_ROWS)
    try:
        spark.conf.set(corpus_pipeline.BATCH_ROWS, before)
        docs = spark.range(0, 5000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words of text number "), "id").alias("text"))
        corpus_pipeline.piece_stage(spark, docs, "")
        assert spark.conf.get(corpus_pipeline.BATCH_ROWS) == after
        sizes = docs.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [len(b)]}) for b in bs), "n bigint").collect()
        assert sum(r["n"] for r in sizes) == 5000 and max(r["n"] for r in sizes) <= int(after)
    finally:
        spark.conf.set(corpus_pipeline.BATCH_ROWS, was)
