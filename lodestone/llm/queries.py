"""The operators of this folder as registered queries, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from . import (
    decontamination,
    exact_dedup,
    hard_negatives,
    license_scan,
    lm,
    near_dup,
    pieces,
    quality,
    secret_scan,
    sharding,
    token_counts,
    topk,
    vector_codes,
)
from .base import read

SHARDS = 24
TOKENIZER = "piece_bpe_32k.model"


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(TOKENIZER)
    both = pieces.encoded(read(spark, sf_dir).select("doc_id", "text"), model, decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(sharding.sized(read(spark, sf_dir)), SHARDS, ["text_hash", "doc_id"], "size")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir), TOKENIZER, scratch_path(spark, "token-cache"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir)
    return quality.scored(docs, quality.train(docs)).select("doc_id", "weak_label", "score", "good")


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(read(spark, sf_dir))


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir), width=4)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(read(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read(spark, sf_dir), read(spark, sf_dir, "benchmark"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secrets(read(spark, sf_dir).select("doc_id", "text")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(read(spark, sf_dir, "embeddings"))[0].drop("label")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pieces": op1_pieces,
        "op2_sharding": op2_sharding,
        "op3_token_counts": op3_token_counts,
        "op4_quality": op4_quality,
        "op5_lm_scores": op5_lm_scores,
        "op6_near_dup": op6_near_dup,
        "op7_topk": op7_topk,
        "op8_license_scan": op8_license_scan,
        "op9_decontamination": op9_decontamination,
        "op10_secret_scan": op10_secret_scan,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_vector_codes": op13_vector_codes,
    }


OP7_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
        CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole a, whole b
    WHERE a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id AND len(a.q) = len(b.q)
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


OP6_SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM split
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS d, doc_id AS r FROM sets UNION SELECT reach.d, links.b FROM reach JOIN links ON reach.r = links.a
), least AS (
    SELECT d, min(r) AS component_id FROM reach GROUP BY d
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least ON d = doc_id
"""


OP11_SQL = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS alike,
        CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole a, whole b
    WHERE a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id AND len(a.q) = len(b.q)
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives JOIN pairs n USING (anchor_id)
WHERE NOT n.alike AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
QUALIFY rank <= 5
"""


OP12_SQL = r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, CAST(count(*) OVER (PARTITION BY norm) AS BIGINT) AS group_size,
    row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM texts
WINDOW best AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
"""


def op13_sql(rounds: int = 4) -> str:
    """Rounds written out one after another; an assignment is the least of ``distance * 256 + entry``."""
    steps = [
        """
WITH whole AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (
    SELECT vec_id, label, p, q[p * len(q) // 4 + 1 : (p + 1) * len(q) // 4] AS v FROM whole, range(4) AS r(p)
), book0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v AS c FROM part QUALIFY e < 256
)"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
    SELECT vec_id, label, p, v, min(CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 256 + e) AS least
    FROM part JOIN book{i} USING (p) GROUP BY vec_id, label, p, v
)""")
        if i < rounds:
            steps.append(f"""sums{i} AS (
    SELECT p, e, place, sum(x) AS s, count(*) AS n FROM (SELECT p, least % 256 AS e, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM near{i}) GROUP BY p, e, place
), means{i} AS (
    SELECT p, e, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY place) AS c FROM sums{i} GROUP BY p, e
), book{i + 1} AS MATERIALIZED (
    SELECT o.p, o.e, coalesce(m.c, o.c) AS c FROM book{i} o LEFT JOIN means{i} m ON m.p = o.p AND m.e = o.e
)""")
    steps.append(f"""codes AS (
    SELECT vec_id, any_value(label) AS label, string_agg(lower(printf('%02x', least % 256)), '' ORDER BY p) AS code, CAST(sum(least // 256) AS BIGINT) AS error
    FROM near{rounds} GROUP BY vec_id
), mark AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes, mark
""")
    return ", ".join(steps)


def oracle_sql() -> dict[str, str]:
    return {"op6_near_dup": OP6_SQL, "op7_topk": OP7_SQL, "op11_hard_negatives": OP11_SQL, "op12_exact_dedup": OP12_SQL, "op13_vector_codes": op13_sql()}
