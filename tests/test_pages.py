import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from lodestone.functions.html import element_text, strip_boilerplate
from lodestone.functions.text import decode_entities
from lodestone.functions.urls import resolve_url
from lodestone.operators import pages as P

PAGE = (
    "<nav><p>skip me</p></nav><h1>Title</h1><p>foo <b>bar</b> baz</p><p>© 2024 X</p><p>2024 All Rights Reserved</p>"
    "<p>Hi</p><p>See Copyright note</p><h4>Four</h4><ul><li>A1</li><li><p>B22</p></li></ul>"
)


def texts(df, profile="v2", **kw):
    return [r.text for r in P.text_blocks(df, profile, **kw).orderBy("url", "ord").collect()]


def test_blocks_of_both_profiles(pages):
    df = pages(PAGE)
    assert texts(df) == ["Title", "foobarbaz", "See Copyright note", "Four", "A1B22", "B22"]
    assert texts(df, "v1") == ["Title", "foobarbaz", "2024 All Rights Reserved", "Hi", "See Copyright note", "A1B22", "B22"]


@pytest.mark.parametrize(
    "html, v2, v1",
    [
        ("<p>d<p>e22</p>", ["e22"], ["d", "e22"]),
        ("<p>&copy; Firm</p>", [], []),
        ("<ul><li>a1<ul><li>b1</li></ul></li><li>c1</li></ul>", ["a1b1c1"], ["a1b1c1", "b1"]),
        ("<ol><li>one<ul><li>two</li></ul>x</ol><p>end of it", ["onetwox", "two", "end of it"], ["onetwox", "two", "end of it"]),
        ("<ul><li>never <li>closed", ["neverclosed"], ["neverclosed"]),
        ("<h2><div>in a div</div> and more</h2>", ["in a divand more"], ["in a divand more"]),
        ("<div><p>open paragraph</div>tail", ["open paragraph"], ["open paragraph"]),
        ("<pre>no block</pre><p-x>no block</p-x>", [], []),
        ("<p>a <!-- x --> b<script>var p='</p>';</script> c</p>", ["abc"], ["abc"]),
        ("<P CLASS='a>b'>Upper</P>", ["Upper"], ["Upper"]),
        ("<p>3 < 4 and 5 > 4</p>", ["3 < 4 and 5 > 4"], ["3 < 4 and 5 > 4"]),
        ("<aside><p>side</p></aside><footer><p>foot</p></footer><p>body</p>", ["body"], ["body"]),
    ],
)
def test_block_cases(pages, html, v2, v1):
    assert texts(pages(html)) == v2
    assert texts(pages(html), "v1") == v1


def test_separator(pages):
    assert texts(pages("<p>foo <b>bar</b><i>baz</i> </p>"), sep=" ") == ["foo bar baz"]


def test_page_text(pages):
    df = pages("<p>aaa</p><p>bbb</p>", "<div>none</div>", None, "  ")
    v2 = {r.url: r.text for r in P.page_text(df).collect()}
    assert v2 == {"http://t.example/0": "aaa\nbbb"}
    v1 = {r.url: r.text for r in P.page_text(df, "v1").collect()}
    assert v1 == {"http://t.example/0": "aaa\nbbb", "http://t.example/1": ""}


def test_links(pages):
    base = "https://h.example:8080/a/b.html"
    hrefs = ["/x#f", "/x", "c", "#top", "mailto:a@b", "//h.example:8080/y", "https://h.example/z", "ftp://h.example:8080/q", "/s?a=1&amp;b=2"]
    html = "<nav>" + "".join(f'<a class=x href="{h}">l</a>' for h in hrefs) + "<a name=q>no</a></nav><!-- <a href='/hidden'> -->"
    root = "https://h.example:8080"
    wanted = {f"{root}/x", f"{root}/a/c", base, f"{root}/y", f"{root}/s?a=1&b=2"}
    df = pages(html, url=base)
    assert {r.dst_url for r in P.page_links(df).collect()} == wanted
    assert P.page_links(df).count() == len(wanted)
    assert {r.dst_url for r in P.page_links(df, "v1").collect()} == wanted | {"ftp://h.example:8080/q"}


def test_images(pages):
    html = "<img src='a.SVG'><img src=b.gif><img src=\"c.png?v=.gif\"><img src='d.jpg'><img alt=x><img data-src=n.png src=e.png alt='A &amp; B'>"
    rows = P.page_images(pages(html, url="http://t.example/x/")).orderBy("image_no").collect()
    assert [(r.image_no, r.image_url, r.alt) for r in rows] == [
        (1, "http://t.example/x/d.jpg", ""),
        (2, "http://t.example/x/e.png", "A & B"),
    ]


def test_tables(pages):
    inner = "<table><tr><td>in</td></tr></table>"
    html = f"<nav>{inner}</nav><table><tr><td>1{inner}</td></tr></table><table><thead></thead></table><table></table><table><tr><td>open"
    found = [r.table_html for r in P.html_tables(pages(html)).orderBy("table_no").collect()]
    assert found == [f"<table><tr><td>1{inner}</td></tr></table>", inner, "<table><thead></thead></table>", "<table><tr><td>open</table>"]
    assert P.html_tables(pages(html), "v1").count() == 3


def test_entities(spark):
    cases = {
        "&amp;lt; &#233;&#x1F600; &eacute;": "&lt; é😀 é",
        "&bogus; a&b &copy 1": "&bogus; a&b &copy 1",
        "&#0;&#xD800;&#1114112;": "�" * 3,
        "&quot;&apos;&nbsp;": "\"' ",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.d for r in df.select("t", decode_entities(F.col("t")).alias("d")).collect()} == cases


def test_text_trims_every_kind_of_space(spark):
    df = spark.createDataFrame([("　<b> a b </b>&nbsp;<i>\tc </i>\x85",)], "h string")
    assert df.select(element_text(F.col("h")).alias("t")).first().t == "a bc"


def test_resolving_equals_the_standard_library(spark):
    rng = random.Random(7)
    segments = ["a", "b.html", "..", ".", "", "c d", "ü", "x:y"]
    fixed = ["", "?q", "#f", "?q=/../x", "//o.example/p/../q", "http://z.example", "https://z.example/a?b#c", "mailto:a@b", "a?x#y", "?", "x?"]
    made = [rng.choice(["", "/"]) + "/".join(rng.choices(segments, k=rng.randint(1, 5))) for _ in range(400)]
    bases = ["http://a.example/b/c/d?q#f", "https://h.example:8080", "http://u@h.example/a/b/", "http://h.example/a/../b/c"]
    rows = [(b, r) for b in bases for r in fixed + made if not r.startswith("//") or r in fixed]
    df = spark.createDataFrame(rows, "b string, r string").withColumn("found", resolve_url(F.col("b"), F.col("r")))
    wrong = [(r.b, r.r, r.found, urljoin(r.b, r.r)) for r in df.collect() if r.found != urljoin(r.b, r.r)]
    assert wrong == []


def test_long_and_open_character_references(spark):
    from lodestone.functions.text import decode_entities

    df = spark.createDataFrame([("&#0000000169; &#169 x &#x00000000A9; &#99999999999; &nosuchname; & &amp;lt; plain",)], "t string")
    assert df.select(decode_entities(F.col("t"))).first()[0] == "© © x © \ufffd &nosuchname; & &lt; plain"


@pytest.mark.parametrize(
    ("html", "kept"),
    [
        ("a<aside>one<aside>two</aside><p>leaked</p></aside>b", "ab"),
        ("<nav>x<footer>y</footer>z</nav>t<NAV>u</NAV >v", "tv"),
        ("a<nav>open<aside>in</aside>rest", "aopenrest"),
        ("<p>a</p><nav>x<aside>y</nav><p>keep</p>", "akeep"),
        ("<p>a</p><aside>x<nav>y</aside><p>keep</p>", "akeep"),
        ("<nav>a<aside>b</nav>c</aside>d", "cd"),
        ("<nav>a<aside>b</nav>c<nav>d</aside>e</nav>f", "cf"),
        ("<nav>a<aside>b<nav>c</aside>d</nav>e", "e"),
        ("x<footer>a</nav>b</footer>y" + "<nav>m</nav>z" * 40, "xy" + "z" * 40),
        ("</nav>a<nav>b</nav>c", "ac"),
        ("a<script>never closed <p>x</p>", "a"),
        ("a<!-- never closed", "a"),
        ("<navigation>a</navigation>", "a"),
    ],
)
def test_furniture_goes_with_all_it_holds(spark, html, kept):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(element_text(strip_boilerplate(F.col("h")))).first()[0] == kept
