"""The saved index: buckets, lookups, appends and merges, and what their plans read and move."""

import re

import pytest
from pyspark.sql import functions as F

from lodestone.operators import search as S
from lodestone.plans.flows import elements_to_index, follow_elements
from lodestone.schema import ELEMENT, INDEX
from lodestone.sources import index as X
from lodestone.sources import io
from lodestone.sources.images import base64_bytes, base64_text


def rows_of(spark, n, text="text", dim=2):
    ids = spark.range(n).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("node_id"), "id")
    vector = F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda i: (F.col("id") * i).cast("float"))
    return ids.select(
        "node_id",
        F.concat(F.lit(f"{text} "), "node_id").alias("text"),
        F.lit("s").alias("source"),
        F.lit(None).cast("string").alias("source_url"),
        F.array(F.lit("i")).alias("images"),
        F.lit("text/html").alias("filetype"),
        vector.alias("embedding"),
    ).select(*INDEX.fieldNames())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def path(spark, tmp_path):
    out = str(tmp_path / "index")
    X.save_index(rows_of(spark, 500), out, buckets=16)
    return out


def hits_of(spark, *ids):
    return spark.createDataFrame([(1, n, 0.5, i + 1) for i, n in enumerate(ids)], "query_id int, node_id string, distance double, rank int")


def test_layout(spark, path, tmp_path):
    assert X.layout(spark, path) == X.Layout(16, 2)
    loaded = X.load_index(spark, path)
    assert loaded.schema.names == INDEX.names and loaded.count() == 500
    assert spark.read.parquet(path).where(F.col("bucket") != X.bucket_of(F.col("node_id"), 16)).count() == 0
    assert X.layout(spark, str(tmp_path / "none")) is None and X.load_index(spark, str(tmp_path / "none")).count() == 0


def test_lookup_reads_the_buckets_of_the_hits_and_moves_no_text(spark, path):
    hits = hits_of(spark, "n3", "n77", "missing")
    found = X.lookup(hits, path)
    assert {(r.node_id, r.text, r["rank"]) for r in found.collect()} == {("n3", "text n3", 1), ("n77", "text n77", 2)}
    plan = plan_of(found)
    wanted = {r.b for r in hits.select(X.bucket_of(F.col("node_id"), 16).alias("b")).collect()}
    assert {int(x) for x in re.search(r"PartitionFilters: \[bucket#\d+ IN \(([\d,]+)\)\]", plan)[1].split(",")} == wanted
    assert "BroadcastHashJoin" in plan and not re.search(r"Exchange hashpartitioning", plan) and "embedding" not in plan
    files = spark.read.parquet(path).where(F.col("bucket").isin(list(wanted))).select("node_id").inputFiles()
    assert len(files) == 16  # what a scan lists; the filter above leaves three folders


def test_lookup_of_many_hits_is_the_same(spark, path, monkeypatch):
    hits = hits_of(spark, *[f"n{i}" for i in range(0, 600, 3)])
    few = sorted(X.lookup(hits, path).collect())
    monkeypatch.setattr(X, "FEW_HITS", 10)
    many = X.lookup(hits, path)
    assert sorted(many.collect()) == few and len(few) == 167
    assert X.lookup(hits.limit(0), path).count() == 0


def test_an_index_without_layout_is_still_read(spark, tmp_path):
    flat = str(tmp_path / "flat")
    rows_of(spark, 20).write.parquet(flat)
    assert X.layout(spark, flat) is None and X.load_index(spark, flat).count() == 20
    assert X.lookup(hits_of(spark, "n4"), flat).first().text == "text n4"


def test_append_adds_what_is_new_and_keeps_the_first(spark, path):
    more = rows_of(spark, 520, "later")
    twice = more.unionByName(more.withColumn("text", F.lit("third")))
    for _ in range(2):
        X.append_index(twice, path)
        got = {r.node_id: r.text for r in X.load_index(spark, path).collect()}
        assert len(got) == 520 == X.load_index(spark, path).count()
        assert got["n5"] == "text n5" and got["n510"] == "later n510"
    assert X.layout(spark, path) == X.Layout(16, 2)
    assert spark.read.parquet(path).where(F.col("bucket") != X.bucket_of(F.col("node_id"), 16)).count() == 0


def test_append_aggregates_ids_only_and_reads_touched_buckets(spark, path):
    rows = hits_of(spark, "n3", "x1").select("node_id", F.col("rank").cast("long").alias("number"))
    wanted = X.new_ids(rows, path)
    assert [r.number for r in wanted.collect()] == [2]
    plan = plan_of(wanted)
    assert "SortAggregate" not in plan and "bucket#" in re.search(r"PartitionFilters: \[[^\]]*\]", plan)[0]
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan)[-1] == "node_id:string"


def test_append_to_nothing(spark, tmp_path):
    path = str(tmp_path / "new")
    X.append_index(rows_of(spark, 30), path)
    assert X.load_index(spark, path).count() == 30 and X.layout(spark, path).dim == 2


def test_merge_takes_the_first_row_of_the_first_index(spark):
    one, two = rows_of(spark, 3, "one"), rows_of(spark, 6, "two")
    repeated = one.unionByName(one.withColumn("text", F.lit("again"))).coalesce(1)
    merged = X.merge_indexes(repeated, two, one)
    got = sorted((r.node_id, r.text) for r in merged.collect())
    assert got == [(f"n{i}", f"{'one' if i < 3 else 'two'} n{i}") for i in range(6)]
    assert merged.columns == one.columns and "SortAggregate" not in plan_of(merged)
    extra = X.merge_indexes(one.drop("images"), two)
    assert {r.node_id: r.images for r in extra.collect()}["n1"] is None


def test_the_most_frequent_length_is_the_dimension(spark, tmp_path):
    mixed = rows_of(spark, 2, dim=3).unionByName(rows_of(spark, 9).where("node_id > 'n1'"))
    assert S.index_dim(mixed) == 2 and S.index_dim(mixed.limit(0)) == 0
    path = str(tmp_path / "mixed")
    X.save_index(mixed, path, buckets=2)
    assert X.layout(spark, path).dim == 2
    asked = spark.createDataFrame([(1, [4.0, 8.0]), (2, [1.0, 2.0, 3.0])], "query_id int, embedding array<float>")
    assert [(r.query_id, r.node_id) for r in S.knn_join(X.load_index(spark, path), asked, 1).collect()] == [(1, "n4")]


def test_a_stream_of_files_gives_the_index_of_one_go(spark, tmp_path):
    fields = ELEMENT["metadata"].dataType
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])

    def land(folder, lo, hi):
        rows = spark.range(lo, hi).select(
            F.lit("e").alias("type"),
            F.concat(F.lit("id"), F.col("id").cast("string")).alias("element_id"),
            F.concat(F.lit("some text "), F.col("id").cast("string")).alias("text"),
            F.lit(None).cast("string").alias("chunk"),
            F.lit("s").alias("source"),
            empty.alias("metadata"),
        )
        io.write_elements(rows, folder, "jsonl", mode="append")

    folder, path, again = (str(tmp_path / n) for n in ("landed", "index", "again"))
    for lo, hi in ((0, 30), (20, 50)):
        land(folder, lo, hi)
        follow_elements(spark, folder, path, str(tmp_path / "state"), 4)
        assert X.load_index(spark, path).count() == hi
    follow_elements(spark, folder, path, str(tmp_path / "state"), 4)  # nothing new
    whole = elements_to_index(io.read_elements(spark, folder, "jsonl").dropDuplicates(["element_id"]), 4)
    X.append_index(whole, again)
    assert sorted(X.load_index(spark, path).collect()) == sorted(X.load_index(spark, again).collect())


def test_base64_there_and_back(spark):
    df = spark.createDataFrame([(b"abc",), (b"",), (None,), (bytes(range(256)),)], "b binary")
    back = df.select("b", base64_bytes(base64_text(F.col("b"))).alias("c")).collect()
    assert all(r.b == r.c for r in back)
    bad = spark.createDataFrame([("a*b",), ("===",), (None,)], "t string").select(base64_bytes(F.col("t")).alias("c")).collect()
    assert all(r.c is None for r in bad)


def test_one_stretch_of_queries_at_a_time(spark, monkeypatch):
    held, most = set(), []
    plain = S._in_place

    def counted(index, queries, *rest):
        df, shipped = plain(index, queries, *rest)
        held.add(id(shipped))
        most.append((len(held), queries.num_rows))
        drop = shipped.destroy
        shipped.destroy = lambda *a: (held.discard(id(shipped)), drop(*a))
        return df, shipped

    monkeypatch.setattr(S, "_in_place", counted)
    index = rows_of(spark, 40)
    asked = spark.range(60).select(F.col("id").alias("query_id"), F.array(F.col("id").cast("float"), (F.col("id") * 2).cast("float")).alias("embedding"))
    few = S.knn_join(index, asked, 1, dim=2).collect()
    most.clear()
    held.clear()
    got = S.knn_join(index, asked, 1, query_bytes=400, dim=2)
    assert len(most) > 20 and {n for n, _ in most} == {1} and not held
    assert plan_of(got).count("FileScan") == 1  # the results of all stretches, whatever their number
    assert sorted(got.collect()) == sorted(few) and len(few) == 60
