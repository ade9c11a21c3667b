"""The corpus pipeline: each stage takes what its predecessor kept, written as Parquet and read again.

Rejected by the quality scorer: dropped. Of near-duplicates the row of the smallest ``doc_id`` stays. Documents with a
copy of a test item: dropped. Secrets: replaced by a mask, and ``n_chars``, where there is one, counts what is left. The last stage adds the
SentencePiece ids of each text. All stages keep extra columns, and take null texts, repeated rows and empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontamination, near_dup, pieces, quality, secret_scan
from lodestone.llm.base import read, settle

TOKENIZER = "piece_bpe_32k.model"
SHINGLE = 5
ROWS = 2048  # in a batch that goes to Python, at most
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded(spark: SparkSession) -> None:
    """Lower the session's batches to ``ROWS`` rows: a batch of whole texts is held several times over by the executor and its workers.

    The setting stays, since what a stage returns runs later; a lower one is left as it is. Rows do not depend on it; quality
    scores are sums that go on through a batch, so it may show in their last digits.
    """
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= ROWS:
        spark.conf.set(BATCH_ROWS, str(ROWS))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    slim = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("text"))
    return quality.scored(slim, quality.train(docs)).where("good").select("_row.*")


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return near_dup.deduplicated(docs, width=SHINGLE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_scan.redacted(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    encoded = pieces.encoded(docs, public_tokenizers.path(TOKENIZER))
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("SentencePiece encoding and decoding", piece_stage),
]

ORACLE_SQL = None  # tokenizers, trained models and tests of randomness have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs, "stage")
    return docs
