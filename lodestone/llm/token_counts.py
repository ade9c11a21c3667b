"""Token counts through a digest cache.

The cache is a Parquet table of ``tokenizer, digest, n_tokens``. ``digest`` is the SHA-256 of the normalised content,
``tokenizer`` that of the tokenizer's file, library and version. Only contents whose digest the cache does not hold for
this tokenizer are encoded, each once however often it occurs, and their counts are appended. Normalising makes null
empty and changes nothing else, since white space and case count for these tokenizers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from importlib.metadata import version

import pyarrow as pa
import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import settle, text_of

CACHE = "tokenizer string, digest binary, n_tokens bigint"
LIMIT = 4096


def tokenizer_digest(name: str) -> str:
    """Names the file's bytes, the library that reads it, and that library's version."""
    library = "sentencepiece" if name.endswith(".model") else "tokenizers"
    with open(public_tokenizers.path(name), "rb") as f:
        return hashlib.sha256(f"{library} {version(library)} ".encode() + f.read()).hexdigest()


@lru_cache(maxsize=4)
def _counter(name: str):
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def encoded_counts(texts: DataFrame, name: str) -> DataFrame:
    """``digest, n_tokens`` of ``digest, text``, in place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(name)
        for batch in batches:
            body = batch.column("text")
            for a, b in W.chunks(body):
                found = count(body.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("digest").slice(a, b - a), pa.array(found, pa.int64())], ["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(work, "digest binary, n_tokens bigint")


def stored(docs: DataFrame, cache: str, tokenizer: str) -> DataFrame:
    """``digest, n_tokens`` that the cache holds for this tokenizer; a cache that is not there yet holds nothing."""
    spark = docs.sparkSession
    try:
        table = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], CACHE)
    # Two runs at once may both append a content; they append the same count.
    return table.where(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, name: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs`` (``doc_id, text``), as the tokenizer's library counts.

    No begin, end or other special token is added; special strings in texts are handled as the library does by default.
    A null text counts as empty and has no tokens. Repeated rows and ids each give a row, other columns are not read, an
    empty table gives no rows. Copies of a text collapse before the shuffle, so a text that a third of the rows share
    travels once per task.
    """
    tokenizer = tokenizer_digest(name)
    digest = F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("digest")
    slim = settle(docs.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"), digest), "digests")
    missing = settle(slim.select("digest").distinct().join(stored(docs, cache, tokenizer), "digest", "left_anti"), "missing")
    if not missing.isEmpty():
        texts = docs.select(digest, text_of().alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
        counts = encoded_counts(texts.join(missing, "digest", "left_semi"), name)
        counts.select(F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    return slim.join(stored(docs, cache, tokenizer), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
