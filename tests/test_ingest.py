import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodestone.functions.vectors import bucket_counts, token_buckets
from lodestone.operators import ingest as N
from lodestone.operators.model import map_model, run_model, try_model
from lodestone.schema import ELEMENT
from lodestone.plans.flows import ingest_to_index
from lodestone.sources import io


def elements(spark, *entries):
    rows = []
    for e in entries:
        meta = e.get("metadata")
        if meta is not None:
            meta = tuple(meta.get(f.name) for f in ELEMENT["metadata"].dataType)
        rows.append(tuple(meta if f.name == "metadata" else e.get(f.name) for f in ELEMENT))
    return spark.createDataFrame(rows, ELEMENT)


ENTRIES = [
    {"chunk": "c1", "text": "t1", "source": "s1"},
    {"chunk": "", "text": "  "},
    {"text": "", "metadata": {"filename": "f3", "embedding": [0.0, 0.0]}},
    {"text": "x", "metadata": {"filetype": "table_row_query", "embedding": [1.0, 2.0]}},
    {"text": "", "metadata": {"filetype": "image"}},
    {"text": "y", "metadata": {"embedding": [1.0, 2.0, 3.0], "image_base64": ["zz"]}},
]


def test_ingest_entries(spark):
    done = N.ingest(elements(spark, *ENTRIES), 2)
    rows = done.collect()
    assert [(r.text, r.source, r.reason) for r in rows] == [
        ("c1", "s1", None), ("  ", "", "blank"), ("", "f3", None), ("x", "", None), ("", "", "blank"), ("y", "", "dim"),
    ]
    assert [r.images for r in rows] == [[], [], [], [], [], ["zz"]]
    assert N.ingest_report(done).first().asDict() == {"processed": 3, "skipped": 3, "tables": 1, "images": 1}
    assert N.index_rows(done).count() == 3
    N.ingest_guard(N.ingest_report(done)).collect()


def test_nothing_embedded_is_an_error(spark):
    bad = N.ingest(elements(spark, ENTRIES[1], ENTRIES[4]), 2)
    with pytest.raises(PySparkException, match="no entry got a vector"):
        N.ingest_guard(N.ingest_report(bad)).collect()
    N.ingest_guard(N.ingest_report(N.ingest(spark.createDataFrame([], ELEMENT), 2))).collect()


def test_model_sees_only_what_needs_a_vector(spark):
    def model(texts):
        assert all(t.strip() and t != "x" for t in texts)
        return [[0.0, 0.0] if t == "zero" else [1.0] if t == "short" else [float(len(t)), 1.0] for t in texts]

    entries = [*ENTRIES, {"text": "zero"}, {"text": "short"}, {"text": "z" * 9000}]
    rows = N.ingest(elements(spark, *entries), 2, model).collect()
    assert [r.reason for r in rows] == [None, "blank", None, None, "blank", "dim", "zero", "zero", None]
    assert rows[0].embedding == [2.0, 1.0] and rows[8].embedding == [9000.0, 1.0]  # texts go over whole


def test_hashed_embedding(spark):
    import hashlib

    text = "The cat　and the\that " * 3
    row = N.embed_text(spark.createDataFrame([(text,), (" ",), (None,)], "text string"), dim=16).collect()
    counts = [0] * 16
    for w in text.lower().split():
        counts[int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % 16] += 1
    length = math.sqrt(sum(c * c for c in counts))
    assert row[0].embedding == pytest.approx([c / length for c in counts], abs=1e-6)
    assert row[1].embedding == [0.0] * 16 and row[2].embedding is None


def test_bucket_counts_add_up(spark):
    df = spark.createDataFrame([(" ".join(f"w{i % 37}" for i in range(n)),) for n in (0, 1, 500)], "t string")
    rows = df.select(bucket_counts(token_buckets(F.col("t"), 8), 8).alias("c")).collect()
    assert [sum(r.c) for r in rows] == [0, 1, 500] and all(len(r.c) == 8 for r in rows)


@pytest.mark.parametrize("count, chunks", [(0, 0), (1, 1), (350, 1), (351, 2), (600, 2), (601, 3), (5000, 20)])
def test_chunks(spark, count, chunks):
    words = [f"w{i}" for i in range(count)]
    df = spark.createDataFrame([(1, "  ".join(words) + "\n")], "id int, text string")
    rows = N.chunk_words(df).orderBy("chunk_no").collect()
    assert len(rows) == chunks
    joined = []
    for r in rows:
        part = r.chunk.split(" ")
        assert part[0] == f"w{250 * r.chunk_no}"
        joined += part if r.chunk_no == 0 else part[100:]
    assert joined == words


def test_character_chunks(spark):
    df = spark.createDataFrame([("型號為什麼",)], "text string")
    rows = N.chunk_words(df, size=3, overlap=1, unit="char").orderBy("chunk_no").collect()
    assert [r.chunk for r in rows] == ["型號為", "為什麼"]


def test_image_list(spark):
    df = spark.createDataFrame([("zz",), (None,), ("",), ('["a","b"]',), ("[no json",)], "raw string")
    assert [r.i for r in df.select(N.image_list(F.col("raw")).alias("i")).collect()] == [["zz"], [], [], ["a", "b"], ["[no json"]]


def test_map_model_isolates_failures(spark):
    def fn(values):
        assert len(values) <= 3
        return [10 // v for v in values]

    df = spark.createDataFrame([(i, None if i == 4 else i % 5) for i in range(12)], "id int, v int")
    got = {r.id: r.r for r in df.select("id", map_model(fn, F.col("v"), "bigint", batch=3).alias("r")).collect()}
    assert got == {i: None if i == 4 or i % 5 == 0 else 10 // (i % 5) for i in range(12)}


def test_bad_rows_in_a_row_are_no_outage(spark):
    def fn(values):
        return [10 // v for v in values]

    df = spark.createDataFrame([(i, 0 if 10 <= i < 40 else 2) for i in range(100)], "id int, v int").coalesce(1)
    got = {r.id: (r.m.value, r.m.error) for r in df.select("id", try_model(fn, F.col("v"), "bigint", batch=7).alias("m")).collect()}
    bad = (None, "ZeroDivisionError: integer division or modulo by zero")
    assert {i for i, x in got.items() if x == bad} == set(range(10, 40)) and got[5] == (5, None)
    whole = run_model(df, fn, F.col("v"), "bigint")
    assert whole.columns == ["id", "v", "result"] and whole.where("result.value = 5").count() == 70
    with pytest.raises(RuntimeError, match="failed for 30 of 100 values: ZeroDivisionError"):
        run_model(df, fn, F.col("v"), "bigint", max_failed=0.2)
    assert run_model(df.limit(0), fn, F.col("v"), "bigint").count() == 0
    nulls = df.withColumn("v", F.lit(None).cast("int"))
    assert run_model(nulls, fn, F.col("v"), "bigint", max_failed=0.0).where("result.error is null").count() == 100


def test_errors_of_the_model_reach_the_rows(spark):
    def fn(texts):
        if "b" in texts:
            raise ValueError("no b")
        return [[1.0] if t == "c" else [1.0, 0.0] for t in texts]

    done = N.ingest(elements(spark, *({"text": t} for t in ("a", "b", "c", " "))), 2, fn)
    got = {r.text: (r.reason, r.error) for r in done.collect()}
    assert got == {"a": (None, None), "b": ("zero", "ValueError: no b"), "c": ("zero", "vector of length 1 instead of 2"), " ": ("blank", None)}
    assert {(r.error, r.n) for r in N.model_errors(done).collect()} == {("ValueError: no b", 1), ("vector of length 1 instead of 2", 1)}


def test_ingest_to_index_embeds_once_and_stops_a_dead_model(spark, tmp_path):
    log = tmp_path / "calls"

    def model(texts):
        with open(log, "a") as f:
            f.write("x" * len(texts))
        return [[1.0, 0.0] for _ in texts]

    def dead(texts):
        raise ConnectionError("no route")

    some = elements(spark, {"text": "a"}, {"text": "b"}, {"text": " "})
    report = ingest_to_index(some, str(tmp_path / "index"), 2, model).first()
    assert (report.processed, report.skipped) == (2, 1) and log.read_text() == "xx"
    assert io.load_index(spark, str(tmp_path / "index")).count() == 2
    with pytest.raises(RuntimeError, match="failed for 2 of 2 texts: ConnectionError: no route"):
        ingest_to_index(some, str(tmp_path / "none"), 2, dead)

    def half_dead(texts):
        if max(texts) > "t4":
            raise ConnectionError("no route")
        return model(texts)

    many = elements(spark, *({"text": f"t{i}"} for i in range(10)))
    with pytest.raises(RuntimeError, match="failed for 5 of 10"):
        ingest_to_index(many, str(tmp_path / "none"), 2, half_dead, max_failed=0.4)
    assert io.load_index(spark, str(tmp_path / "none")).count() == 0
