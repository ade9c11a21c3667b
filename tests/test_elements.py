import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodestone.operators import elements as E
from lodestone.operators import pages as P
from lodestone.plans import flows
from lodestone.schema import ELEMENT
from lodestone.sources import images as I
from lodestone.sources import io

GEAR = (
    "<p>first block</p><p>second block</p><table><tr><th>Model</th><th>W</th></tr><tr><td>A1</td><td>1</td></tr></table>"
    "<img src=/gear.png alt=Gear>"
)


def kinds(df):
    return {r.filetype: r.n for r in E.count_by_type(df).collect()}


def test_one_page_gives_every_kind(pages):
    df = E.build_elements(pages(GEAR))
    assert df.schema == ELEMENT or df.schema.simpleString() == ELEMENT.simpleString()
    assert kinds(df) == {"text/html": 1, "table/html": 1, "table_row_query": 2, "image": 1}
    rows = {r.metadata.filetype: r for r in df.collect()}
    assert rows["text/html"].text == "first block\nsecond block"
    assert rows["text/html"].metadata.content_blocks == ["first block", "second block"]
    assert rows["table/html"].text == "Model: A1, W: 1"
    assert rows["table_row_query"].metadata.table_html.startswith("<table>")
    image = rows["image"]
    assert (image.text, image.metadata.filename, image.metadata.label) == ("Gear", "Gear", "Gear")
    assert image.metadata.orig_img.url == "http://t.example/gear.png"
    assert image.metadata.image_base64 is None and image.metadata.embedding is None


def test_ids_repeat_and_differ(pages):
    ids = lambda: sorted(r.element_id for r in E.build_elements(pages(GEAR, GEAR)).collect())
    first = ids()
    assert first == ids() and len(set(first)) == 10


def test_first_profile_has_texts_only(pages):
    assert kinds(E.build_elements(pages(GEAR, "<table><tr><td>x</td></tr></table>"), profile="v1")) == {"text/html": 2}


def test_images_with_bytes_and_labels(spark, pages, tmp_path):
    page = pages("<img src=a.jpg alt=''><img src=b.png alt=Bee><img src=c.bin>", url=f"file:{tmp_path}/p.html")
    for name in ("a.jpg", "c.bin"):
        (tmp_path / name).write_bytes(bytes(range(200)))
    files = I.read_image_files(spark, str(tmp_path))
    labels = spark.createDataFrame([(f"file:{tmp_path}/a.jpg", "Label A"), (f"file:{tmp_path}/b.png", "unused")], "image_url string, label string")
    df = E.build_elements(page, files, labels)
    rows = {r.metadata.orig_img.url.rsplit("/", 1)[1]: r for r in df.collect()}
    assert rows["a.jpg"].text == "Label A" and rows["a.jpg"].metadata.image_mime_type == "image/jpeg"
    assert "\n" not in rows["a.jpg"].metadata.image_base64[0] and len(rows["a.jpg"].metadata.image_base64[0]) == 268
    assert rows["b.png"].text == "Bee" and rows["b.png"].metadata.image_base64 is None
    assert rows["c.bin"].text is None and rows["c.bin"].metadata.image_mime_type is None


def test_landed_media_type_goes_before_the_ending(spark):
    images = spark.createDataFrame([("u", i, f"http://t/{n}", "") for i, n in enumerate(("a.png", "b.png", "c", "d"))], "url string, image_no int, image_url string, alt string")
    rows = [("http://t/a.png", b"1", "image/webp"), ("http://t/b.png", b"2", " "), ("http://t/c", b"3", "image/gif"), ("http://t/d", None, "image/gif")]
    got = I.attach_images(images, spark.createDataFrame(rows, "url string, content binary, mime_type string")).collect()
    assert {r.image_url[9:]: r.image_mime_type for r in got} == {"a.png": "image/webp", "b.png": "image/png", "c": "image/gif", "d": None}


def test_a_model_labels_images(spark, pages):
    page = pages("<p>some words about gears</p><img src=a.png alt=A><img src=b.png alt=B><img src=c.png alt=C><img src=d.png alt=D><img src=a.png>")
    urls = sorted({r.image_url for r in P.page_images(page).collect()})
    files = spark.createDataFrame([(u, bytes([65 + i])) for i, u in enumerate(urls[:3])], "url string, content binary")

    def name(asked):
        for a in asked:
            if a["image_base64"] == "Qg==":
                raise ValueError("no idea")
            assert "some words about gears" in a["prompt"]
        return [f" label of {a['image_base64']} " for a in asked]

    found = {r.image_url: r.label for r in flows.model_labels(page, files, name).collect()}
    assert found == {urls[0]: "label of QQ==", urls[1]: "Classification Error", urls[2]: "label of Qw=="}
    given = spark.createDataFrame([(urls[1], "Given")], "image_url string, label string")
    rows = flows.pages_to_elements(page, 8, files=files, labels=given, label_fn=name).where("metadata.filetype = 'image'").collect()
    assert sorted(r.text for r in rows) == ["D", "Given", "label of QQ==", "label of QQ==", "label of Qw=="]

    def dead(asked):
        raise ValueError("down")

    with pytest.raises(RuntimeError, match="failed for 3 of 3"):
        flows.model_labels(page, files, dead)


def test_a_model_reads_tables(pages):
    table = "<table><tr><th>Model</th></tr><tr><td>{}</td></tr></table>"
    page = pages("<p>text</p>" + "".join(table.format(x) for x in ("one", "none", "fails")))

    def rows(markup):
        if any("fails" in m for m in markup):
            raise ValueError("no")
        return ["no rows here" if "none" in m else 'Rows: [{"Name": "from the model"}]' for m in markup]

    done = flows.pages_to_elements(page, 8, table_fn=rows).where("metadata.filetype = 'table/html'").collect()
    assert sorted(r.text for r in done) == ["Model: fails", "Model: none", "Name: from the model"]


def test_guard_and_profile(spark, pages):
    plain = E.build_elements(pages(GEAR))
    with pytest.raises(PySparkException, match="no element has an embedding"):
        E.build_guard(plain).collect()
    done = E.embed_elements(plain, 8)
    assert E.build_guard(done).first().embedded == 4
    assert E.profile_elements(done).first().asDict() == {
        "elements": 5, "tables": 3, "images": 1, "with_embedding": 4, "embedding_pct": 80.0,
    }
    nothing = spark.createDataFrame([], ELEMENT)
    assert E.profile_elements(nothing).first().embedding_pct is None
    assert E.build_guard(nothing).first().elements == 0
    fields = {r.field: r for r in E.describe_elements(done).collect()}
    assert fields["metadata.embedding"].filled == 4 and fields["metadata.embedding"].longest == 8
    assert fields["chunk"].filled == 0


def test_failed_embedding_keeps_the_element(pages):
    def broken(texts):
        raise RuntimeError("down")

    df = E.embed_elements(E.build_elements(pages(GEAR)), 4, broken)
    assert {tuple(r.metadata.embedding) for r in df.collect() if r.metadata.embedding is not None} == {()}


def test_label_prompt(spark):
    df = spark.createDataFrame([("c" * 500, "b"), ("c" * 501, "b" * 300)], "c string, b string")
    rows = [r.p for r in df.select(E.label_prompt(F.col("c"), F.col("b")).alias("p")).collect()]
    assert "PAGE CONTEXT:\n" + "c" * 500 + "\n\nIMAGE DATA (base64, truncated):\nb...\n\nLabel:" in rows[0]
    assert "c" * 500 + "...\n" in rows[1] and "\n" + "b" * 200 + "...\n" in rows[1]


@pytest.mark.parametrize("fmt", ["parquet", "jsonl"])
def test_write_and_read(spark, pages, tmp_path, fmt):
    df = E.embed_elements(E.build_elements(pages(GEAR)), 4)
    io.write_elements(df, str(tmp_path / "e"), fmt)
    back = io.read_elements(spark, str(tmp_path / "e"), fmt)
    assert (tmp_path / "e" / "filetype=image").is_dir()
    key = lambda r: r.element_id
    assert sorted(back.collect(), key=key) == sorted(df.collect(), key=key)


def test_read_array_file(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(
        """[{"type": "CompositeElement", "element_id": "1", "text": "t", "metadata": {"filename": "1", "embedding": []}},
        {"type": "CompositeElement", "element_id": "2", "text": "q", "metadata": {"filetype": "table_row_query",
         "embedding": [0.5, 1], "row_data": {"b": "1", "a": "2"}, "table_json": [{"z": "1"}, {"z": "2"}], "image_base64": "zz"}},
        {"element_id": "3", "chunk": "c", "metadata": {"image_base64": ["x", "y"]}}, {"text": "bare"}]""",
        encoding="utf8",
    )
    rows = io.read_elements(spark, str(path)).collect()
    assert rows[0].metadata.embedding == []
    assert [(c.k, c.v) for c in rows[1].metadata.row_data] == [("b", "1"), ("a", "2")]
    assert [[(c.k, c.v) for c in r] for r in rows[1].metadata.table_json] == [[("z", "1")], [("z", "2")]]
    assert rows[1].metadata.image_base64 == ["zz"] and rows[1].metadata.embedding == [0.5, 1.0]
    assert rows[2].metadata.image_base64 == ["x", "y"] and rows[2].chunk == "c"
    assert rows[3].metadata is None and rows[3].text == "bare"


def test_read_pages_from_files(spark, tmp_path):
    (tmp_path / "one.html").write_text("<p>line one\nline two</p>", encoding="utf8")
    df = io.read_pages(spark, str(tmp_path), "files")
    assert [r.text for r in P.text_blocks(df).collect()] == ["line one\nline two"]


def test_script_profile_keeps_what_is_empty(pages):
    table = "<table><tr><th>A</th></tr><tr><td></td></tr></table>"
    df = E.build_elements(pages(f"<div>{table}<img src=a.png alt=Pic></div>"), profile="script")
    rows = {r.metadata.filetype: r for r in df.collect()}
    assert {k: r.text for k, r in rows.items()} == {"text/html": "", "table/html": "", "image": ""}
    assert rows["image"].metadata.label == "Pic"
    v2 = E.build_elements(pages(f"<div>{table}<img src=a.png alt=Pic></div>"))
    assert {r.metadata.filetype: r.text for r in v2.collect()} == {"image": "Pic"}


def test_reports(spark, pages, tmp_path):
    assert P.page_report(pages("x", " ", None)).first().asDict() == {"pages": 3, "blank": 2}
    done = E.embed_elements(E.build_elements(pages(GEAR)), 8)
    assert {r.dim: r.n for r in E.embedding_sizes(done).collect()} == {8: 4, None: 1}
    (tmp_path / "a.json").write_text("[]")
    assert [r.bytes for r in io.file_sizes(spark, str(tmp_path)).collect()] == [2]


def test_no_bytes_no_question(spark):
    df = spark.createDataFrame([("c", None, "x"), ("c", "", "x"), ("c", "b", " Gear \n")], "c string, b string, a string")
    rows = df.select(E.label_prompt(F.col("c"), F.col("b")).alias("p"), E.asked_label(F.col("a"), F.col("b")).alias("l")).collect()
    assert [r.p is None for r in rows] == [True, True, False]
    assert [r.l for r in rows] == ["Unknown Image", "Unknown Image", "Gear"]


ARRAY = '[{"element_id": "1", "metadata": {"filename": 7.10, "row_data": {"b": 1.50, "a": "ü"}, "table_json": [{"z": 1e5}]}},\r\n {"element_id": "2"}]'


def test_array_files_read_alike_however_stored(spark, tmp_path):
    for name, data in (("plain.json", ARRAY.encode()), ("mark.json", b"\xef\xbb\xbf" + ARRAY.encode())):
        (tmp_path / name).write_bytes(data)
        (tmp_path / f"{name}.gz").write_bytes(gzip.compress(data))
    (tmp_path / "none.json").write_bytes(b"")
    names = ["plain.json", "plain.json.gz", "mark.json", "mark.json.gz"]
    read = [io.read_elements(spark, str(tmp_path / n)).collect() for n in names]
    assert read[0][0].metadata.filename == "7.10" and len(read[0]) == 2
    assert all(r == read[0] for r in read)
    assert io.read_elements(spark, str(tmp_path / "none.json")).collect() == []


def test_array_file_of_another_encoding_fails(spark, tmp_path):
    for name in ("utf-16", "utf-16-le", "utf-16-be"):
        (tmp_path / name).write_bytes(ARRAY.encode(name))
        with pytest.raises(Exception, match=r"(?i)malformed|FAILED_READ_FILE"):
            io.read_elements(spark, str(tmp_path / name)).collect()


def test_stored_lines_are_compressed_in_bounded_files(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(io, "ROWS_A_FILE", 40)
    rows = "".join(f"<tr><td>M{i}</td><td>{i}</td><td>name {i}</td></tr>" for i in range(60))
    df = E.build_elements(pages(f"<table><tr><th>Model</th><th>N</th><th>Name</th></tr>{rows}</table>"))
    io.write_elements(df, str(tmp_path / "e"), "jsonl")
    files = list((tmp_path / "e").glob("filetype=table_row_query/part-*"))
    raw = [gzip.decompress(f.read_bytes()) for f in files]
    assert max(r.count(b"\n") for r in raw) <= 40 and sum(r.count(b"\n") for r in raw) == 180
    assert 10 * sum(f.stat().st_size for f in files) < sum(map(len, raw))
    key = lambda r: r.element_id
    assert sorted(io.read_elements(spark, str(tmp_path / "e"), "jsonl").collect(), key=key) == sorted(df.collect(), key=key)
