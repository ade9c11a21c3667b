import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import search as S
from lodestone.plans.flows import retrieve
from lodestone.operators.ranking import top_n
from lodestone.schema import INDEX
from lodestone.sources import io


def index_of(spark, vectors):
    rows = [(n, f"text {n}", f"src {n}", None, ["i"] * i, "text/html", v) for i, (n, v) in enumerate(vectors.items())]
    return spark.createDataFrame(rows, INDEX)


SMALL = {"c": [3.0, 4.0], "b": [3.0, 4.0], "a": [0.0, 0.0], "d": [1.0, 0.0], "odd": [1.0], "none": None}


def test_small_search(spark):
    index = index_of(spark, SMALL)
    got = [(r.node_id, r.distance, r["rank"]) for r in S.knn_search(index, [0.0, 0.0], 3).orderBy("rank").collect()]
    assert got == [("a", 0.0, 1), ("d", 1.0, 2), ("b", 25.0, 3)]
    assert S.knn_search(index, [0.0, 0.0], 10).count() == 4
    queries = spark.createDataFrame([(1, [0.0, 0.0])], "query_id int, embedding array<float>")
    joined = S.knn_join(index, queries, 10).orderBy("rank").collect()
    assert [r.node_id for r in joined] == ["a", "d", "b", "c"]


def brute_force(ids, vectors, queries, k):
    out = set()
    for q, v in enumerate(queries):
        dist = ((vectors - v) ** 2).sum(axis=1)
        order = sorted(range(len(ids)), key=lambda i: (round(dist[i], 9), ids[i]))[:k]
        out |= {(q, ids[i], r + 1, round(dist[i], 6)) for r, i in enumerate(order)}
    return out


@pytest.mark.parametrize("stretches", [1, 3])
@pytest.mark.parametrize("k", [1, 7, 500])
def test_join_equals_brute_force_with_a_third_of_copies(spark, stretches, k):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 6)).astype(np.float32)
    vectors[100:200] = vectors[0]
    ids = [f"n{i:04d}" for i in rng.permutation(300)]
    queries = np.concatenate([rng.normal(size=(12, 6)).astype(np.float32), vectors[:2]])
    index = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "node_id string, embedding array<float>")
    asked = spark.createDataFrame([(q, v.tolist()) for q, v in enumerate(queries)], "query_id int, embedding array<float>")
    one = len(queries) * (6 * 8 + 64 + k * 96)
    got = S.knn_join(index.repartition(5), asked, k, S.QUERY_BYTES if stretches == 1 else one // stretches).collect()
    found = {(r.query_id, r.node_id, r["rank"], round(r.distance, 6)) for r in got}
    assert len(got) == len(found)
    assert found == brute_force(ids, vectors.astype(float), queries.astype(float), k)


def test_no_queries_and_no_index(spark):
    index = index_of(spark, SMALL)
    none = spark.createDataFrame([], "query_id int, embedding array<float>")
    assert S.knn_join(index, none, 3).count() == 0
    one = spark.createDataFrame([(1, [0.0, 0.0])], none.schema)
    assert S.knn_join(spark.createDataFrame([], INDEX), one, 3).count() == 0


def test_status_and_payload(spark):
    index = index_of(spark, SMALL)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None)], "query_id int, embedding array<float>")
    hits = S.with_payload(S.knn_join(index, queries.where("query_id = 1"), 2), index)
    got = {(r.query_id, r["rank"], r.text, r.image_count) for r in S.project_hits(hits).collect()}
    assert got == {(1, 1, "text d", 3), (1, 2, "text a", 2)}
    status = lambda h, **kw: {r.query_id: (r.status, r.n_hits) for r in S.search_status(queries, h, **kw).collect()}
    assert status(hits) == {1: ("ok", 2), 2: ("no_embedding", 0), 3: ("no_embedding", 0)}
    assert status(hits.limit(0)) == {1: ("no_hits", 0), 2: ("no_embedding", 0), 3: ("no_embedding", 0)}
    assert status(hits, given=True)[2] == ("no_hits", 0)


@pytest.mark.parametrize("k, clamped", [(-3, 1), (0, 1), (5, 5), (99, 20)])
def test_clamp(spark, k, clamped):
    assert S.clamp_k(k) == clamped
    assert spark.range(1).select(S.clamp_k(F.lit(k)).alias("k")).first().k == clamped


@pytest.mark.parametrize("n", [3, 1500])
def test_top_n_of_a_hot_key(spark, n):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("key"), "id")
    got = top_n(df, ["key"], [F.col("id").desc()], n)
    hot = [r.id for r in got.where("key = -1").orderBy("rank").collect()]
    assert hot == [i for i in range(3999, -1, -1) if i % 3][:n]
    assert got.count() == n + 1334


def test_index_life(spark, tmp_path):
    path = str(tmp_path / "index")
    empty = io.load_index(spark, path)
    assert S.index_status(empty).first().asDict() == {"vectors": 0, "texts": 0, "dimension": None, "consistent": True, "ready": False}
    good = index_of(spark, {k: v for k, v in SMALL.items() if v and len(v) == 2})
    io.save_index(good.where("node_id <> 'd'"), path)
    for _ in range(2):
        io.append_index(good.unionByName(good), path)
    key = lambda r: r.node_id
    assert sorted(io.load_index(spark, path).collect(), key=key) == sorted(good.collect(), key=key)
    assert S.index_status(io.load_index(spark, path)).first().ready
    assert S.index_status(index_of(spark, SMALL)).first().consistent is False
    changed = good.withColumn("text", F.lit("other"))
    merged = io.merge_indexes(good.where("node_id = 'a'"), changed, good)
    assert {r.node_id: r.text for r in merged.collect()} == {"a": "text a", "b": "other", "c": "other", "d": "other"}


def test_lookup_joins_only_rows_on_the_map(spark, tmp_path):
    path = str(tmp_path / "index")
    good = index_of(spark, {k: v for k, v in SMALL.items() if v and len(v) == 2})
    io.save_index(good, path)
    index = io.load_index(spark, path)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<float>")
    hits = S.knn_join(index, queries, 2)
    assert sorted(S.lookup_payload(hits, index).collect()) == sorted(S.with_payload(hits, index).collect())
    wanted = hits.select("node_id").limit(1)
    assert [r.node_id for r in index.where(S.on_map_of(wanted)).collect()] == [r.node_id for r in wanted.collect()]
    assert S.lookup_payload(hits.limit(0), index).count() == 0


def test_saved_status(spark, tmp_path):
    path = str(tmp_path / "index")
    assert io.saved_index_status(spark, path).first().exists is False
    io.save_index(index_of(spark, {"a": [1.0]}), path)
    row = io.saved_index_status(spark, path).first()
    assert row.exists and row.ready and row.vectors == 1


def test_an_odd_query_leaves_the_others_alone(spark):
    index = index_of(spark, {"a": [0.0, 1.0], "b": [1.0, 0.0]})
    queries = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0, 0.0])], "query_id int, embedding array<float>")
    hits = S.knn_join(index, queries, 1)
    assert sorted((r.query_id, r.node_id) for r in hits.collect()) == [(1, "a"), (2, "b")]
    status = {r.query_id: r.status for r in S.search_status(queries, hits, dim=S.index_dim(index)).collect()}
    assert status == {1: "ok", 2: "ok", 3: "bad_dim"}


def test_retrieve_takes_k_as_it_is_and_asks_the_model_once(spark, tmp_path):
    log = tmp_path / "calls"

    def model(texts):
        with open(log, "a") as f:
            f.write("".join(f"{len(t)}\n" for t in texts))
        return [[1.0, 0.0] for _ in texts]

    index = index_of(spark, {f"n{i:02}": [float(i), 1.0] for i in range(60)})
    queries = spark.createDataFrame([(1, "x" * 9000)], "query_id int, query string")
    found = retrieve(index, queries, 2, k=50, fn=model)
    assert found.hits.count() == 50 and found.status.first().status == "ok" and found.prompts.count() == 1
    assert log.read_text() == "9000\n"
