import html as stdlib_html

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.operators import tables as T


def rows_of(spark, *tables):
    df = spark.createDataFrame(list(enumerate(tables)), "id int, table_html string")
    found = T.parse_tables(df).orderBy("id").collect()
    return [[[(c.k, c.v) for c in row] for row in t.table_rows] for t in found]


@pytest.mark.parametrize(
    "table, rows",
    [
        ("<table><tr><th>Model</th><th>W</th></tr><tr><td> A1 </td><td>1</td></tr></table>", [[("Model", "A1"), ("W", "1")]]),
        (
            "<table><tr><th rowspan=2>Model</th><th colspan=2>Size</th></tr><tr><th>W</th><th>H</th></tr>"
            "<tr><td>A1</td><td>1</td><td>2</td></tr></table>",
            [[("Model", "A1"), ("Size__W", "1"), ("Size__H", "2")]],
        ),
        (
            "<table><tr><th>K</th><th>V</th></tr><tr><td rowspan=2>A</td><td>1</td></tr><tr><td>2</td></tr></table>",
            [[("K", "A"), ("V", "1")], [("K", ""), ("V", "2")]],
        ),
        ("<table><tr><th>K</th><th>V</th></tr><tr><td>A</td></tr></table>", [[("K", "A"), ("V", "")]]),
        ("<table><thead></thead></table>", []),
        ("<table><tr><td>K</td><td>V</td></tr><tr><td>1<td>2</table>", [[("K", "1"), ("V", "2")]]),
        (
            "<table><tr><th>A</th><th>B</th><th>C</th></tr><tr><td rowspan=2 colspan=2>x</td><td>1</td></tr><tr><td>2</td></tr>"
            "<tr><td>3</td><td>4</td><td>5</td></tr></table>",
            [
                [("A", "x"), ("B", ""), ("C", "1")],
                [("A", ""), ("B", ""), ("C", "2")],
                [("A", "3"), ("B", "4"), ("C", "5")],
            ],
        ),
        (
            "<table><tr><th>A</th></tr><tr><td>out <table><tr><td>in &amp; side</td></tr></table></td></tr></table>",
            [[("A", "out   in & side")]],
        ),
    ],
)
def test_parse(spark, table, rows):
    assert [[(k, " ".join(v.split())) for k, v in row] for row in rows_of(spark, table)[0]] == [
        [(k, " ".join(v.split())) for k, v in row] for row in rows
    ]


_CELL = st.text(st.characters(codec="utf-8", exclude_categories=("Cc", "Cs", "Zs", "Zl", "Zp", "Cf")), max_size=6)


@settings(max_examples=5, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(_CELL, min_size=3, max_size=3), min_size=1, max_size=6))
def test_round_trip_through_markup(spark, body):
    cells = lambda tag, row: "".join(f"<{tag}>{stdlib_html.escape(c)}</{tag}>" for c in row)
    names = ["A", "B", "C"]
    table = f"<table><tr>{cells('th', names)}</tr>" + "".join(f"<tr>{cells('td', r)}</tr>" for r in body) + "</table>"
    assert rows_of(spark, table)[0] == [list(zip(names, r, strict=True)) for r in body]


def test_recover_json(spark):
    cases = {
        'x [{"b":"1","a":"2"}] y': [[("b", "1"), ("a", "2")]],
        '[{"a":1,"b":null,"a":{"x":[2]}}]': [[("a", '{"x":[2]}'), ("b", None)]],
        "[]": None,
        '[1,{"a":2}]': None,
        '["{x"]': None,
        "[broken]": None,
        "[{'a':1}]": None,
        '[{"a":1}] and [2]': None,
        "none": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    rows = df.select("t", T.recover_json_rows(F.col("t")).alias("v2"), T.recover_json_rows(F.col("t"), "v1").alias("v1")).collect()
    plain = lambda v: None if v is None else [[(c.k, c.v) for c in row] for row in v]
    assert {r.t: plain(r.v2) for r in rows} == cases
    assert {r.t: plain(r.v1) for r in rows} == cases | {"[]": []}


def test_sentences_and_questions(spark):
    head = "<table><tr><th>Model</th><th>W</th><th>H</th></tr>"
    table = head + "<tr><td>A1</td><td>1</td><td></td></tr><tr><td>A2</td><td>H</td><td>3</td></tr></table>"
    other = "<table><tr><th>X</th><th>Y</th></tr><tr><td>k</td><td>v</td></tr></table>"
    df = T.parse_tables(spark.createDataFrame([(0, table), (1, other)], "id int, table_html string"))
    sentences = T.with_sentences(df).orderBy("id").collect()
    assert sentences[0].table_sentences == ["Model: A1, W: 1", "Model: A2, W: H, H: 3"]
    questions = [(r.id, r.row_no, r.col_no, r.question) for r in T.cell_questions(df).orderBy("id", "row_no", "col_no").collect()]
    assert questions == [
        (0, 1, 1, "型號為A1的Model是什麼？答案：A1"),
        (0, 1, 2, "型號為A1的W是什麼？答案：1"),
        (0, 2, 1, "型號為A2的Model是什麼？答案：A2"),
        (0, 2, 3, "型號為A2的H是什麼？答案：3"),
        (1, 1, 1, "型號為k的X是什麼？答案：k"),
        (1, 1, 2, "型號為k的Y是什麼？答案：v"),
    ]


def test_row_key_order(spark):
    df = spark.createDataFrame([("m", "n", "x"), (None, "n", "x"), ("", "", "x"), ("", "", None)], "`型號` string, Model string, first string")
    row = T.row_of(df, ["first", "型號", "Model"])
    keys = df.select(T.row_key(row, F.transform(row, lambda c: c["k"])).alias("key")).collect()
    assert [r.key for r in keys] == ["m", "n", "x", ""]


@pytest.mark.parametrize(
    ("html", "rows"),
    [
        ("<table><tr><th>K</th></tr><tr><td>1</td><td>extra</td></tr></table>", [{"K": "1", "column_2": "extra"}]),
        ("<table><tr><td colspan=100000>a</td></tr><tr><td>1</td></tr></table>", [{"a": "1"}]),
        (
            "<table><thead><tr><td>A</td><td>B</td></tr><tr><td>x</td><td>y</td></tr></thead><tr><td>1</td><td>2</td></tr></table>",
            [{"A__x": "1", "B__y": "2"}],
        ),
    ],
)
def test_surplus_cells_wide_spans_and_heads(spark, html, rows):
    found = T.parse_tables(spark.createDataFrame([(html,)], "table_html string")).first().table_rows
    got = [{x.k: x.v for x in row if x.v} for row in found]
    assert got == rows
