import pytest
from pyspark.sql import functions as F

from lodestone.operators import crawl as C
from lodestone.operators import prompts as R
from lodestone.plans.flows import elements_to_index, pages_to_elements, retrieve


@pytest.fixture
def hits(spark):
    rows = [(1, 2, "s2", "two\nlines", 0.5, 2), (1, 1, "s1", "a" * 701, 0.0, 0)]
    return spark.createDataFrame(rows, "query_id int, rank int, source string, text string, distance double, image_count int")


def test_context_and_prompt(hits):
    context = R.build_context(hits).first().context
    assert context == "來源: s1\n\n" + "a" * 701 + "\n\n---\n\n來源: s2\n\ntwo\nlines"
    prompt = R.build_prompts(R.build_context(hits).withColumn("query", F.lit("why?"))).first().prompt
    assert prompt.startswith("根據以下提供的資訊回答問題") and prompt.endswith("two\nlines\n\n問題: why?\n\n回答:")
    assert f"提供的資訊:\n{context}" in prompt


def test_source_list(hits):
    sources = R.format_sources(hits).first().sources
    assert sources == "1. source=s1, distance=0.0000\n" + "a" * 700 + "...\n\n2. source=s2, distance=0.5000\ntwo lines"


def test_reference_list(hits):
    refs = R.format_references(hits).first().refs
    assert refs.startswith("- Source: s1 (distance=0.000)\n  Content:\n  " + "a" * 500 + "... (truncated, total length: 701 characters)\n")
    assert refs.endswith("- Source: s2 (distance=0.500)\n  Content:\n  two\nlines\n  Images: 2 found\n")


def test_answer(spark):
    df = spark.createDataFrame([("a", "s"), ("a", ""), ("a", None)], "a string, s string")
    got = [r.t for r in df.select(R.answer_text(F.col("a"), F.col("s")).alias("t")).collect()]
    assert got == ["Answer:\na\n\nSources:\ns", "a", "a"]


def test_history(spark):
    df = spark.createDataFrame([(7, t, "user", f"t{t}") for t in range(3)], "conv_id int, turn int, role string, text string")
    assert [r.history for r in R.history_prompts(df).orderBy("turn").collect()] == ["", "t0", "t0\nt1"]
    assert [r.history for r in R.history_prompts(df, 1).orderBy("turn").collect()] == ["", "t0", "t1"]
    assert R.history_prompts(df).orderBy("turn").collect()[2].prompt == "歷史對話：t0\nt1以上回歷史路。 本次對話：t2"


def test_history_of_a_hot_conversation_is_cut_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "_BLOCK", 10)
    gaps = [t * 3 for t in range(100)]
    rows = [(1, t, "user", f"t{t}") for t in gaps] + [(2, t, "user", f"u{t}") for t in range(5)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = {(r.conv_id, r.turn): r.history for r in R.history_prompts(df, 7).collect()}
    assert len(got) == 105
    for i, t in enumerate(gaps):
        assert got[(1, t)] == "\n".join(f"t{x}" for x in gaps[max(0, i - 7) : i])
    assert got[(2, 4)] == "u0\nu1\nu2\nu3"


@pytest.mark.parametrize(
    "cap, depth, urls",
    [(5, 1, ["s", "a", "b"]), (2, 1, ["s", "a"]), (5, 2, ["s", "a", "b", "z"]), (3, 2, ["s", "a", "b"]), (2000, 3, ["s", "a", "b", "z", "s2"])],
)
def test_crawl(spark, cap, depth, urls):
    edges = [("s", "b"), ("s", "a"), ("s", "a"), ("s", "s"), ("s", "missing"), ("s", "blank"), ("a", "z"), ("a", "b"), ("z", "s2"), ("s2", "s")]
    links = spark.createDataFrame(edges, "src_url string, dst_url string")
    pages = spark.createDataFrame([(u, "<p>x") for u in ("s", "a", "b", "z", "s2")] + [("blank", " ")], "url string, html string")
    starts = spark.createDataFrame([("s",), ("missing",)], "start_url string")
    got = C.crawl_frontier(pages, links, starts, cap, depth).orderBy("ord").collect()
    assert [r.url for r in got] == urls and {r.start_url for r in got} == {"s"}


def test_flow_end_to_end(spark, pages):
    table = "<table><tr><th>Model</th><th>Weight</th></tr><tr><td>Zeta</td><td>twelve</td></tr></table>"
    df = pages("<p>the quick brown fox</p>", "<p>gear reducers and motors</p>" + table)
    index = elements_to_index(pages_to_elements(df, 64), 64)
    queries = spark.createDataFrame([("q1", "gear reducers and motors"), ("q2", " ")], "query_id string, query string")
    found = retrieve(index, queries, 64, k=3)
    assert {r.query_id: r.status for r in found.status.collect()} == {"q1": "ok", "q2": "no_embedding"}
    hits = found.hits.orderBy("rank").collect()
    assert len(hits) == 3 and hits[0].text == "gear reducers and motors" and hits[0].distance == pytest.approx(0, abs=1e-9)
    assert hits[0].source_url == "http://t.example/1"
    assert found.prompts.first().prompt.count("來源: ") == 3 and found.sources.first().sources.startswith("1. source=")


def test_answer_records(spark, hits):
    status = spark.createDataFrame([(1, "ok"), (2, "no_hits"), (3, "no_embedding")], "query_id int, status string")
    rows = {r.query_id: r for r in R.answer_records(status, hits).collect()}
    assert [h.source for h in rows[1].retrieved] == ["s1", "s2"] and rows[1].answer == R.NO_MODEL_ANSWER
    assert rows[2].retrieved == [] and rows[2].answer == "索引中沒有可用的檢索結果。"
    assert rows[3].answer.startswith("無法為查詢生成 embedding")
    answers = spark.createDataFrame([(1, "yes"), (2, "unheard")], "query_id int, answer string")
    rows = {r.query_id: r.answer for r in R.answer_records(status, hits, answers).collect()}
    assert rows[1] == "yes" and rows[2] == "索引中沒有可用的檢索結果。"
    failed = R.answer_records(status, hits, answers.where("query_id = 2")).where("query_id = 1").first()
    assert failed.answer == R.FAILED_ANSWER
