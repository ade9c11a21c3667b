"""Nulls, empty and very long texts, repeats, clashing names and empty tables: a defined result, no crash."""

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lodestone.llm import decontamination, license_scan, lm, near_dup, pieces, quality, secret_scan, sharding, token_counts, topk
from lodestone.sources.scratch import scratch_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def bench(spark):
    rows = [(1, "says something about nothing at all"), (1, "says something about nothing at all"), (2, None), (None, ""), (3, "one")]
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumn("words", F.lit(1)).withColumn("doc_id", F.lit(2))


OPERATORS = {
    "pieces": lambda s, d: pieces.decoded(pieces.encoded(d, MODEL, decoded="found"), MODEL),
    "sharding": lambda s, d: sharding.shard(sharding.sized(d), 4, ["text_hash", "doc_id"], "size"),
    "token_counts": lambda s, d: token_counts.token_counts(d, "piece_bpe_32k.model", scratch_path(s, "cache")),
    "quality": lambda s, d: quality.scored(d, quality.train(d)),
    "lm": lambda s, d: lm.scores(d),
    "near_dup": lambda s, d: near_dup.near_duplicates(d),
    "secrets": lambda s, d: secret_scan.secrets(d),
    "redacted": lambda s, d: secret_scan.redacted(d),
}
PARTIAL = {
    "license_scan": lambda s, d: license_scan.license_scan(d),
    "contaminated": lambda s, d: decontamination.contaminated(d, bench(s)),
    "decontaminated": lambda s, d: decontamination.decontaminated(d, bench(s)),
    "deduplicated": lambda s, d: near_dup.deduplicated(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(spark, odd, name):
    assert OPERATORS[name](spark, odd).count() == odd.count()


@pytest.mark.parametrize("name", [*OPERATORS, *PARTIAL])
def test_an_empty_table_gives_no_rows(spark, odd, name):
    assert (OPERATORS | PARTIAL)[name](spark, odd.limit(0)).count() == 0


def test_values_on_odd_rows(spark, odd):
    ids = {(r.doc_id, r.text): r.ids for r in pieces.encoded(odd, MODEL).collect()}
    assert ids[(4, None)] == ids[(3, "")] == []
    counts = {r.doc_id: r for r in OPERATORS["token_counts"](spark, odd).collect()}
    assert (counts[4].n_bytes, counts[4].n_tokens, counts[4].over_limit) == (0, 0, False) and counts[7].over_limit
    good = {(r.doc_id, r.good) for r in quality.scored(odd, quality.train(odd)).collect()}
    assert {(3, False), (4, False), (5, False), (1, True)} <= good
    near = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(odd).collect()}
    assert {(1, 12, 1, True), (2, 12, 1, False), (3, 0, 3, True), (4, 0, 4, True), (8, 1, 8, True)} <= near
    assert any(r[0] is None and r[2] is None and r[3] for r in near)
    scored = {r.doc_id: r for r in lm.scores(odd).collect()}
    assert scored[4].n_tokens == 1 and scored[7].n_tokens == 20_002
    hits = {(r.doc_id, r.item_id) for r in decontamination.contaminated(odd, bench(spark)).collect()}
    assert hits == {(1, 1), (2, 1)}
    assert decontamination.decontaminated(odd, bench(spark)).count() == 8
    clean = decontamination.decontaminated(odd, bench(spark))
    assert clean.columns == odd.columns and {r._key for r in clean.collect()} == {7}
    assert decontamination.contaminated(odd, bench(spark).limit(0)).count() == 0
    assert {(r._key, r._quality) for r in quality.scored(odd, quality.train(odd)).collect()} == {(7, "q")}
    masked = {r.doc_id: r.text for r in secret_scan.redacted(odd).collect()}
    assert masked[9] == '[SECRET]" and more words follow it.' and masked[4] is None
    assert near_dup.deduplicated(odd).count() == 9


def test_odd_vectors(spark):
    big = [float(i) for i in range(3)]
    rows = [(0, big, 1), (50, big, 1), (1, big, 1), (1, big, 1), (2, None, 1), (3, [1.0, None, 2.0], 1), (4, [float("nan")] * 3, 1), (5, [1.0], 1), (None, big, 1), (6, [], 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, row int")
    asked = F.col("vec_id") % 50 == 0
    got = [tuple(r) for r in topk.top_k(table, asked, 5).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 327680), (0, 2, 1, 327680), (0, 3, 50, 327680), (0, 4, None, 327680), (50, 1, 0, 327680), (50, 2, 1, 327680), (50, 3, 1, 327680), (50, 4, None, 327680)]
    assert topk.top_k(table.limit(0), asked).count() == 0


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    out = run(spark, odd, "/root/testdata/sf0.01")
    assert out.columns[: len(odd.columns)] == odd.columns and 0 < out.count() <= odd.count()
    assert run(spark, odd.limit(0), "/root/testdata/sf0.01").count() == 0
