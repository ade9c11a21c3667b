"""Exact duplicates: 128-bit content hashes, the bytes compared inside each group.

Texts are compared without white space. Rows are grouped by the MD5 of that text, and the bytes are compared by
grouping on hash and text together: copies collapse in the task that reads them, so a text moves once per task that
holds it, however many copies there are. A hash that stands for more than one text is a collision; its rows are grouped
by the text itself. Everything after that works on slim rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import settle, text_of, with_group

BLANKS = " \t\n\x0b\f\r"


def normalised(text: str = "text") -> Column:
    """The text without blanks; null counts as empty."""
    return F.translate(text_of(text), BLANKS, "")


def collisions(docs: DataFrame, digest: Callable[[Column], Column] = F.md5) -> DataFrame:
    """``hash`` of every digest that stands for two or more different texts."""
    texts = docs.select(digest(normalised()).alias("hash"), normalised().alias("norm")).distinct()
    return texts.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")


def _slim(docs: DataFrame, number: Column, digest: Callable[[Column], Column], mixed: DataFrame) -> DataFrame:
    """``doc_id, number, key, chars, text_sha256`` of every row; equal keys are equal texts."""
    hashed = docs.select("doc_id", number.alias("number"), text_of().alias("text"), normalised().alias("norm"), digest(normalised()).alias("hash"))
    key = F.col("hash")
    if not mixed.isEmpty():
        hashed = hashed.join(mixed.withColumn("shared", F.lit(True)), "hash", "left")
        key = F.when(F.col("shared"), F.concat("hash", F.lit(":"), "norm")).otherwise(key)
    return hashed.select("doc_id", "number", key.alias("key"), F.length("text").cast("long").alias("chars"), F.sha2("norm", 256).alias("text_sha256"))


def _groups(docs: DataFrame, number: Column, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """All rows, slim, and a row per group: its size and the row of it that stays."""
    rows = settle(_slim(docs, number, digest, settle(collisions(docs, digest), "collisions")), "texts")
    first = F.min(F.struct(-F.col("chars"), F.col("doc_id").isNull(), "doc_id", "number")).alias("first")
    return rows, settle(rows.groupBy("key").agg(F.count("*").alias("group_size"), first), "groups")


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = F.md5) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs(doc_id, text)``.

    Texts are equal if they are identical once all white space is deleted; null counts as empty, and so does a text of
    white space only. Of equal texts the row with the most code points stays, then the smallest ``doc_id`` (null last);
    of rows alike in both, one. Other columns are not read. An empty table gives no rows.
    """
    rows, groups = _groups(docs, F.monotonically_increasing_id(), digest)
    met = with_group(rows, groups, "key", "group_size", rows.count())
    kept = F.col("number") == F.col("first.number")
    return met.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, digest: Callable[[Column], Column] = F.md5) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows are settled first, so that each has one number."""
    numbered = settle(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("number")), "documents")
    texts = numbered.select("doc.doc_id", "doc.text", "number")
    _, groups = _groups(texts, F.col("number"), digest)
    return numbered.join(groups.select(F.col("first.number").alias("number")), "number", "left_semi").select("doc.*")
