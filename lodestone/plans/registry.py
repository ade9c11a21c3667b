"""Every operator as a query over the given tables. ``oracles`` has the same queries in SQL.

Where the tables lack something (HTML tables, images, landed files) it is derived from ``part``, row by row or in
blocks of forty keys, so that the work grows with the table.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import unfold
from ..functions.urls import resolve_url, url_authority, url_scheme
from ..functions.vectors import has_non_zero
from ..operators import crawl as C
from ..operators import elements as E
from ..operators import ingest as N
from ..operators import pages as P
from ..operators import prompts as R
from ..operators import search as S
from ..operators import tables as T
from ..operators.model import run_model
from ..schema import ELEMENT, INDEX
from ..sources import images as I
from ..sources import io
from ..sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

DIM = 64
K = 5
BLOCK = 40  # table rows per derived page
SITE = "http://parts.example.com"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table, spread over all cores if its file is too small to be split."""
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# ---- inputs derived from the tables -------------------------------------------------------------


def part_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The values of each part as they go into HTML: ``block``, ``key``, ``model``, ``name``, ``size``, ``price``."""
    return table(spark, sf, "part").select(
        F.floor(F.col("p_partkey") / BLOCK).alias("block"),
        F.col("p_partkey").alias("key"),
        F.concat(F.lit("M-"), F.col("p_partkey").cast("string")).alias("model"),
        F.replace("p_name", F.lit(" "), F.lit(" & ")).alias("name"),
        F.when(F.col("p_size") == 1, "Price").when(F.col("p_size") == 2, "").otherwise(F.col("p_size").cast("string")).alias("size"),
        F.printf(F.lit("%.2f"), F.col("p_retailprice")).alias("price"),
    )


def _td(value: Column, extra: str = "") -> Column:
    return F.concat(F.lit(f"<td{extra}> "), F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit(" </td>"))


def _block_html(spark: SparkSession, sf: str, row: Column, head: str, foot: str) -> DataFrame:
    # Parsing comes after this shuffle and costs more than its bytes suggest, so the partition count is fixed.
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = part_cells(spark, sf).select("block", "key", row.alias("row")).repartition(partitions, "block")
    ordered = F.array_sort(F.collect_list(F.struct("key", "row")))
    body = F.array_join(F.transform(ordered, lambda r: r["row"]), "")
    return rows.groupBy("block").agg(F.concat(F.lit(head), body, F.lit(foot)).alias("table_html"))


FLAT_HEAD = "<table><tr><th>Model</th><th>Name</th><th>Size</th><th>Price</th></tr>"
WIDE_HEAD = (
    '<table class="w"><thead><tr><th colspan="2">Part</th><th colspan=2>Detail</th></tr>'
    "<tr><th>Model</th><th>Name</th><th>Size</th><th>Price</th></tr></thead>"
)


def _row_html() -> Column:
    cells = [_td(F.col(c)) for c in ("model", "name", "size", "price")]
    return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))


def flat_tables(spark: SparkSession, sf: str) -> DataFrame:
    return _block_html(spark, sf, _row_html(), FLAT_HEAD, "</table>")


def part_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a menu table, a table of parts, an empty table, an image and some text."""
    menu = "<nav><table><tr><td>menu</td></tr></table></nav>"
    rest = "<table><thead></thead></table><table><caption>none</caption></table>"
    number = F.col("block").cast("string")
    return flat_tables(spark, sf).select(
        F.concat(F.lit(f"{SITE}/list/"), number).alias("url"),
        F.concat(
            F.lit(f"<html><body>{menu}<h2>Block "),
            number,
            F.lit("</h2><p>All <b>parts</b>"),
            F.col("table_html"),
            F.lit(rest),
            F.lit('<img src="/img/'),
            number,
            F.lit('.png" alt="Block '),
            number,
            F.lit('"><footer><img src="/logo.png"></footer></body></html>'),
        ).alias("html"),
    )


def image_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per part, with images to keep and to drop."""
    key = F.col("key").cast("string")
    return part_cells(spark, sf).select(
        F.concat(F.lit(f"{SITE}/p/"), key).alias("url"),
        F.concat(
            F.lit('<p>x</p><img data-src="no.png" alt="'),
            F.replace("name", F.lit("&"), F.lit("&amp;")),
            F.lit("\" src='../img/"),
            key,
            F.lit('.jpg?v=1&amp;w=2\'><IMG SRC=/d.GIF><img src="//cdn.example.com/'),
            key,
            F.lit('.png"/><img src="b.svg"><img alt="none"><img src="c.png?v=.gif">'),
        ).alias("html"),
    )


def part_images(spark: SparkSession, sf: str) -> DataFrame:
    return P.page_images(image_pages(spark, sf))


def part_files(spark: SparkSession, sf: str) -> DataFrame:
    """Landed files for the images of every part whose size is not blank."""
    rows = part_cells(spark, sf).where(F.col("size") != "")
    return rows.select(
        F.concat(F.lit(f"{SITE}/img/"), F.col("key").cast("string"), F.lit(".jpg?v=1&w=2")).alias("url"),
        F.encode(F.repeat("name", 5), "UTF-8").alias("content"),
    )


def doc_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as elements. Some have a chunk, some a stored vector (one kind too short, some all zero)."""
    lang, n = F.col("lang"), F.col("n_chars")
    filetype = F.when(lang == "fr", "table_row_query").when(lang == "es", "image").otherwise("text/html")
    value = (n % 5).cast("float")
    stored = F.when(lang == "fr", F.array_repeat(value, DIM)).when((lang == "es") & (n % 2 == 0), F.array_repeat(value, 3))
    given = {
        "filename": F.concat(F.lit("f"), F.col("doc_id").cast("string")),
        "source_url": F.concat(F.lit("http://docs.example.com/"), F.col("doc_id").cast("string")),
        "filetype": filetype,
        "embedding": stored,
        "image_base64": F.when(lang == "es", F.array(F.col("source"))),
    }
    meta = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ELEMENT["metadata"].dataType]
    return table(spark, sf, "documents").select(
        F.lit(E.TYPE).alias("type"),
        F.lit(None).cast("string").alias("element_id"),
        F.when(n % 11 == 0, F.lit(" \t ")).otherwise(F.col("text")).alias("text"),
        F.when(lang == "de", F.concat(F.lit("de: "), F.col("text"))).when(lang == "en", "").alias("chunk"),
        F.when(lang != "en", F.col("source")).alias("source"),
        F.struct(*meta).alias("metadata"),
    )


def ingested_docs(spark: SparkSession, sf: str) -> DataFrame:
    return N.ingest(doc_elements(spark, sf), DIM)


def doc_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return N.chunk_words(table(spark, sf, "documents").select("doc_id", "lang", "text"))


def chunk_index(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, whole, in chunks with vectors."""
    rows = doc_chunks(spark, sf).select(
        N.hash_id(F.col("doc_id"), F.col("chunk_no")).alias("node_id"),
        F.col("chunk").alias("text"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("source"),
        F.concat(F.lit("http://docs.example.com/"), F.col("doc_id").cast("string")).alias("source_url"),
        F.when(F.col("lang") == "fr", F.array(F.lit("aa"), F.lit("bb"))).otherwise(F.array().cast("array<string>")).alias("images"),
        F.lit("text/html").alias("filetype"),
    )
    return N.embed_text(rows, "text", DIM).select(*INDEX.fieldNames())


def benchmark_queries(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return N.embed_text(rows, "query", DIM)


def saved_chunks(spark: SparkSession, sf: str) -> str:
    """The chunk index, saved: its vectors are made once, for the search and for the rows of the hits."""
    path = scratch_path(spark, "index")
    io.save_index(chunk_index(spark, sf), path)
    return path


def hits(spark: SparkSession, sf: str, k: int = K) -> DataFrame:
    path = saved_chunks(spark, sf)
    near = S.knn_join(io.load_index(spark, path), benchmark_queries(spark, sf), k, dim=io.layout(spark, path).dim)
    return io.lookup(near, path)


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("node_id"), "embedding", "label")


def label_queries(spark: SparkSession, sf: str) -> DataFrame:
    """One query per label: the mean of its vectors."""
    parts = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("d", "x"))
    means = parts.groupBy("label", "d").agg(F.avg("x").alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("d", F.round("m", 6).alias("m"))))
    mean = F.transform(ordered, lambda p: p["m"].cast("float"))
    return means.groupBy(F.col("label").alias("query_id")).agg(mean.alias("embedding"))


def page_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """A link table: the links found on the pages, none of which landed, and from each page to six further ones."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    ahead = F.explode(F.array(*[F.lit(i) for i in (1, 2, 3, 5, 8, 13)]))
    steps = pages.select("url", "page_id", ahead.alias("step"))
    near = steps.select(F.col("url").alias("src_url"), (F.col("page_id") + F.col("step")).alias("page_id"))
    near = near.join(pages, "page_id").select("src_url", F.col("url").alias("dst_url"))
    return near.unionByName(P.page_links(table(spark, sf, "pages")))


# ---- the queries --------------------------------------------------------------------------------


def read_pages(spark, sf):
    pages = io.read_pages(spark, f"{sf}/pages.parquet")
    return P.usable_pages(pages).select("page_id", "url", F.length("html").alias("html_chars"))


def strip_boilerplate(spark, sf):
    return P.strip_pages(table(spark, sf, "pages")).select("page_id", "html")


CROSSED = ["a<nav>x<aside>y</nav>k", "a<aside>x<nav>y</aside>k", "<nav>x<aside>y</nav>a</aside>k", "a<nav>x<aside>y<nav>z</aside>w</nav>k", "a<footer>x</nav>y</footer>k"]


def strip_crossed(spark, sf):
    """Each page between the two halves of furniture that is closed by its neighbour's tag, which all goes but for ``a`` and ``k``."""
    marks = F.array(*[F.lit(m) for m in CROSSED])
    rows = table(spark, sf, "pages").select("page_id", F.posexplode(marks).alias("no", "mark"), "url")
    held = F.replace("mark", F.lit("x"), F.col("url"))
    ends = F.replace(held, F.lit("k"), F.concat(F.lit("k"), F.col("page_id").cast("string")))
    return rows.select("page_id", "no", H.element_text(H.strip_boilerplate(ends)).alias("kept"))


def text_blocks(profile):
    return lambda spark, sf: P.text_blocks(table(spark, sf, "pages"), profile, keys=["page_id"])


def block_predicate(spark, sf):
    """Lines of all documents, some made to look like a copyright line."""
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    marked = F.concat(
        F.element_at(F.array(*[F.lit(m) for m in ("", "Copyright ", "© ", "2024 All Rights ", "x ")]), F.col("line_no") % 5 + 1),
        F.col("line"),
    )
    lines = lines.select("doc_id", "line_no", marked.alias("line"))
    return lines.where(H.keep_block(F.col("line"))).select("doc_id", "line_no", "line")


def element_text(spark, sf):
    html = H.strip_comments(F.col("html"))
    return table(spark, sf, "pages").select(
        "page_id", H.element_text(html).alias("text"), H.element_text(html, " ").alias("spaced")
    )


def page_text(profile):
    def run(spark, sf):
        return P.page_text(table(spark, sf, "pages"), profile, keys=["page_id"]).select("page_id", "text")

    return run


def html_tables(spark, sf):
    return P.html_tables(part_pages(spark, sf))


def page_images(spark, sf):
    return part_images(spark, sf)


def page_links(spark, sf):
    return P.page_links(table(spark, sf, "pages"))


def resolve_urls(spark, sf):
    """Each page url with each of a list of references."""
    refs = ["/x/../y?q=1", "c/d", "?z=2", "//o.example/p", "https://h.example/z#f", "./e/./f", "mailto:a@b", "#top"]
    rows = table(spark, sf, "pages").select("page_id", "url", F.explode(F.array(*[F.lit(r) for r in refs])).alias("ref"))
    found = resolve_url(F.col("url"), F.col("ref"))
    return rows.select("page_id", "ref", found.alias("found"), url_scheme(found).alias("scheme"), url_authority(found).alias("host"))


def crawl_frontier(depth, cap):
    def run(spark, sf):
        pages = table(spark, sf, "pages")
        starts = pages.select(F.col("url").alias("start_url"))
        return C.crawl_frontier(pages, page_neighbours(spark, sf), starts, cap, depth)

    return run


def unvisited_links(spark, sf):
    links = page_neighbours(spark, sf).select(F.col("src_url").alias("start_url"), F.col("dst_url").alias("url"))
    doubled = links.unionByName(links)
    visited = table(spark, sf, "pages").where(F.col("url").startswith("https")).select(F.col("url").alias("start_url"), "url")
    reached = links.where(F.col("url").endswith("html")).unionByName(visited)
    return C.unvisited(doubled, reached)


def landed_links(spark, sf):
    links = page_neighbours(spark, sf).select(F.col("src_url").alias("start_url"), F.col("dst_url").alias("url"))
    return C.landed(links, table(spark, sf, "pages"))


def _pairs(df: DataFrame, *keys: str) -> DataFrame:
    return (
        df.select(*keys, F.posexplode(unfold(F.col("table_rows"))).alias("row_no", "row"))
        .select(*keys, "row_no", F.posexplode("row").alias("col_no", "cell"))
        .select(*keys, "row_no", "col_no", F.col("cell.k").alias("k"), F.col("cell.v").alias("v"))
    )


def parse_tables(spark, sf):
    wide = _block_html(spark, sf, _row_html(), WIDE_HEAD, "</table>")
    return _pairs(T.parse_tables(wide), "block")


def parse_spanned_tables(spark, sf):
    """Header and body cells that span rows, which take the Python path."""
    head = (
        "<table><tr><th rowspan=2>Model</th><th colspan=2>Detail</th><th rowspan=2>Block</th></tr>"
        "<tr><th>Size</th><th>Price</th></tr>"
    )
    block = F.concat(F.lit("B"), F.col("block").cast("string"))
    first = F.when(F.col("key") % BLOCK == 0, _td(block, f" rowspan={BLOCK}")).otherwise("")
    row = F.concat(F.lit("<tr>"), *[_td(F.col(c)) for c in ("model", "size", "price")], first, F.lit("</tr>"))
    return _pairs(T.parse_tables(_block_html(spark, sf, row, head, "</table>")), "block")


def recover_json(spark, sf):
    """Rows written as JSON into free text, and texts that hold none."""
    good = F.to_json(F.array(F.struct(F.col("p_type").alias("t"), F.col("p_name").alias("n"), F.col("p_size").cast("string").alias("a"))))
    text = (
        F.when(F.col("p_size") % 5 == 1, F.concat(F.lit("[1, "), good, F.lit("]")))
        .when(F.col("p_size") % 5 == 2, F.lit("none here"))
        .otherwise(F.concat(F.lit("Sure:\n"), good, F.lit("\nDone.")))
    )
    rows = table(spark, sf, "part").select("p_partkey", T.recover_json_rows(text).alias("table_rows"))
    return _pairs(rows, "p_partkey")


_PART_COLS = ["p_name", "p_brand", "p_type", "p_size"]


def _part_rows(spark, sf) -> DataFrame:
    part = table(spark, sf, "part")
    return part.withColumn("p_type", F.when(F.col("p_type") != "ECONOMY", F.col("p_type")))


def row_sentences(spark, sf):
    part = _part_rows(spark, sf)
    return part.select("p_partkey", T.row_sentence(T.row_of(part, _PART_COLS)).alias("sentence"))


def table_elements(spark, sf):
    parsed = T.parse_tables(flat_tables(spark, sf)).withColumn("url", F.lit(SITE)).withColumn("table_no", F.col("block"))
    return E.table_elements(parsed).select("element_id", "text", F.size("metadata.table_sentences").alias("n_rows"))


def cell_questions(spark, sf):
    parsed = T.parse_tables(flat_tables(spark, sf))
    return T.cell_questions(parsed).select("block", "row_no", "col_no", "question")


def row_keys(spark, sf):
    part = _part_rows(spark, sf)
    row = T.row_of(part, ["p_type", "p_name", "p_brand"])
    header = F.transform(row, lambda x: x["k"])
    return part.select(
        "p_partkey",
        T.row_key(row, header).alias("by_header"),
        T.row_key(row, header, ["Model", "p_brand"]).alias("by_brand"),
    )


def attach_images(spark, sf):
    return I.attach_images(part_images(spark, sf), part_files(spark, sf)).select(
        "url", "image_no", "image_url", "image_base64", "image_mime_type"
    )


def image_bytes(spark, sf):
    """Attached images back as bytes; every third with a sign that Base64 does not have."""
    images = I.attach_images(part_images(spark, sf), part_files(spark, sf))
    text = F.when(F.length("image_url") % 3 == 0, F.concat("image_base64", F.lit("*"))).otherwise(F.col("image_base64"))
    content = I.base64_bytes(text)
    return images.select("url", "image_no", F.octet_length(content).cast("bigint").alias("n_bytes"), F.md5(content).alias("digest"))


def image_elements(spark, sf):
    images = I.attach_images(part_images(spark, sf), part_files(spark, sf))
    labels = part_cells(spark, sf).where(F.col("name").startswith("red")).select(
        F.concat(F.lit(f"{SITE}/img/"), F.col("key").cast("string"), F.lit(".jpg?v=1&w=2")).alias("image_url"),
        F.concat(F.lit("Label "), F.col("model")).alias("label"),
    )
    return E.image_elements(images, labels).select(
        "element_id", "text", F.col("metadata.filename").alias("filename"), F.col("metadata.orig_img.url").alias("image_url")
    )


def label_prompts(spark, sf):
    rows = table(spark, sf, "documents")
    prompt = E.label_prompt(F.col("text"), I.base64_text(F.encode("text", "UTF-8")))
    return rows.select("doc_id", prompt.alias("prompt"))


def _all_pages(spark, sf) -> DataFrame:
    return table(spark, sf, "pages").select("url", "html").unionByName(part_pages(spark, sf))


def build_elements(profile):
    def run(spark, sf):
        rows = E.build_elements(_all_pages(spark, sf), profile=profile)
        meta = F.col("metadata")
        return rows.select("element_id", meta["source_url"].alias("source_url"), meta["filetype"].alias("filetype"), "text")

    return run


def element_ids(spark, sf):
    rows = table(spark, sf, "documents")
    made = E.element_id(F.col("source"), F.lit("text/html"), F.col("doc_id"), F.col("text"))
    return rows.select("doc_id", made.alias("element_id"))


def build_guard(spark, sf):
    return E.build_guard(E.embed_elements(E.build_elements(_all_pages(spark, sf)), DIM))


def profile_elements(spark, sf):
    return E.profile_elements(E.embed_elements(E.build_elements(_all_pages(spark, sf)), DIM))


def count_by_type(spark, sf):
    return E.count_by_type(E.build_elements(_all_pages(spark, sf)))


def describe_elements(spark, sf):
    return E.describe_elements(doc_elements(spark, sf)).fillna(0)


def embedding_sizes(spark, sf):
    return E.embedding_sizes(doc_elements(spark, sf)).fillna(0)


def page_report(spark, sf):
    """All pages whole, and for each of them a blank one."""
    pages = table(spark, sf, "pages").select("html")
    return P.page_report(pages.unionByName(pages.select(F.when(F.length("html") % 2 == 0, " ").alias("html"))))


def lookup_payload(spark, sf):
    """Search over a saved index, and its rows read by a map of the hits' ids."""
    index = io.load_index(spark, saved_chunks(spark, sf))
    found = S.lookup_payload(S.knn_join(index, benchmark_queries(spark, sf), K), index)
    return found.select("query_id", "rank", "source", "text", F.round("distance", 6).alias("distance"))


def saved_index_status(spark, sf):
    return io.saved_index_status(spark, saved_chunks(spark, sf))


def pick_text_and_source(spark, sf):
    entries = N.to_entries(doc_elements(spark, sf))
    return entries.select("source_url", "text", "source", F.size("images").alias("n_images"))


def image_lists(spark, sf):
    raw = (
        F.when(F.col("lang") == "en", F.col("source"))
        .when(F.col("lang") == "fr", F.to_json(F.array("source", "lang")))
        .when(F.col("lang") == "de", F.lit(""))
    )
    listed = N.image_list(raw)
    return table(spark, sf, "documents").select("doc_id", F.size(listed).alias("n"), F.array_join(listed, "|").alias("images"))


def resolve_vectors(spark, sf):
    rows = N.resolve_vectors(N.to_entries(doc_elements(spark, sf)), DIM)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x)
    return rows.select("source_url", "fresh", F.coalesce(F.size("embedding"), F.lit(0)).alias("dim"), F.round(total, 4).alias("total"))


def embed_text(spark, sf):
    rows = N.embed_text(table(spark, sf, "documents").select("doc_id", "text"), "text", DIM)
    values = rows.select("doc_id", F.posexplode(unfold(F.col("embedding"))).alias("bucket", "value"))
    return values.where(F.col("value") != 0).select("doc_id", "bucket", F.round(F.col("value").cast("double"), 6).alias("value"))


def valid_vectors(spark, sf):
    return ingested_docs(spark, sf).select("source_url", "reason")


def node_ids(spark, sf):
    return ingested_docs(spark, sf).select("source_url", "node_id")


def ingest_report(spark, sf):
    return N.ingest_guard(N.ingest_report(ingested_docs(spark, sf)))


def chunk_words(spark, sf):
    return doc_chunks(spark, sf).select("doc_id", "chunk_no", "chunk")


def knn_search(spark, sf):
    near = S.knn_search(vectors(spark, sf), [0.125] * DIM, 10)
    return near.select("node_id", F.round("distance", 6).alias("distance"), "rank")


def knn_join(spark, sf):
    near = S.knn_join(vectors(spark, sf), label_queries(spark, sf), 10)
    return near.select("query_id", "node_id", F.round("distance", 6).alias("distance"), "rank")


def knn_join_blocks(spark, sf):
    """The same beyond the broadcast bound: block by block."""
    near = S.knn_join(vectors(spark, sf), label_queries(spark, sf), 10, query_bytes=2048)
    return near.select("query_id", "node_id", F.round("distance", 6).alias("distance"), "rank")


def hit_lookup(spark, sf):
    return hits(spark, sf).select("query_id", "rank", "source", "text", F.round("distance", 6).alias("distance"))


def clamp_k(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.clamp_k(F.col("n_chars") % 40 - 5).alias("k"))


def _asked(spark, sf) -> tuple[DataFrame, DataFrame]:
    """All benchmark texts and, for each of them, a blank query, a query whose vector is too long, and one that the model fails for; and all
    hits of those that have any."""
    texts = table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("id"), "text")

    def model(given):
        if any(t.startswith("fail ") for t in given):
            raise ValueError("no vector for this text")
        return [[float(len(t) % 7), 1.0] + [0.0] * (DIM - 2) for t in given]

    kinds = {"plain": F.col("text"), "blank": F.lit(" "), "failed": F.concat(F.lit("fail "), F.col("text"))}
    asked = [texts.select(F.concat_ws("-", F.lit(kind), "id").alias("query_id"), text.alias("query")) for kind, text in kinds.items()]
    plain, blank, failed = asked
    queries = N.embed_text(plain.unionByName(blank), "query", DIM).withColumn("error", F.lit(None).cast("string"))
    queries = queries.unionByName(N.embed_text(failed, "query", DIM, model, error_col="error"))
    long = queries.where(F.col("query_id").startswith("plain")).select(
        F.concat(F.lit("long-"), "query_id").alias("query_id"), "query", F.concat("embedding", "embedding").alias("embedding"), "error"
    )
    queries = queries.unionByName(long)
    path = saved_chunks(spark, sf)
    found = S.knn_join(io.load_index(spark, path), queries.where(has_non_zero(F.col("embedding"))), 3, dim=DIM)
    return queries, io.lookup(found, path)


def search_status(spark, sf):
    """The same queries over the whole index and, as ``none-``, over an empty one."""
    queries, found = _asked(spark, sf)
    none = queries.withColumn("query_id", F.concat(F.lit("none-"), "query_id"))
    return S.search_status(queries, found, dim=DIM).unionByName(S.search_status(none, found.limit(0), dim=DIM))


def answer_records(spark, sf):
    queries, found = _asked(spark, sf)
    status = S.search_status(queries, found, dim=DIM)
    odd = F.length("query") % 2 == 1
    answers = queries.where(F.col("query_id").startswith("plain")).select(
        "query_id", F.when(odd, F.concat(F.lit("A: "), "query")).alias("answer"), F.when(~odd, F.concat(F.lit("E: "), "query_id")).alias("error")
    )
    sources = F.array_join(F.transform("retrieved", lambda r: r["source"]), "|")
    return R.answer_records(status, found, answers).select("query_id", "status", "answer", "error", sources.alias("sources"))


def project_hits(spark, sf):
    return S.project_hits(hits(spark, sf)).select("query_id", "rank", "source", "image_count")


def build_context(spark, sf):
    return R.build_context(hits(spark, sf))


def build_prompts(spark, sf):
    queries = benchmark_queries(spark, sf).select("query_id", "query")
    return R.build_prompts(R.build_context(hits(spark, sf)).join(queries, "query_id")).select("query_id", "prompt")


def format_sources(spark, sf):
    return R.format_sources(hits(spark, sf))


def format_references(spark, sf):
    return R.format_references(S.project_hits(hits(spark, sf)))


def answer_text(spark, sf):
    """All hits; and for each query one more, which finds nothing."""
    items = table(spark, sf, "benchmark")
    one = items.select(F.col("item_id").alias("query_id"), F.col("text").alias("answer"))
    none = items.select((-1 - F.col("item_id")).alias("query_id"), F.col("text").alias("answer"))
    rows = one.unionByName(none).join(R.format_sources(hits(spark, sf)), "query_id", "left")
    return rows.select("query_id", R.answer_text(F.col("answer"), F.col("sources")).alias("answer"))


def index_status(spark, sf):
    return S.index_status(chunk_index(spark, sf))


def history_prompts(spark, sf):
    return R.history_prompts(table(spark, sf, "conversations"), 4).select("conv_id", "turn", "history", "prompt")


def map_model_lengths(spark, sf):
    """A user function over all documents; it fails for some."""

    def word_count(texts):
        if any("\n" not in t for t in texts):
            raise ValueError("one line")
        return [len([w for w in t.split(" ") if w]) for t in texts]

    rows = table(spark, sf, "documents").select("doc_id", "text")
    counted = run_model(rows, word_count, F.col("text"), "bigint", max_failed=1.0)
    return counted.select("doc_id", F.coalesce("result.value", F.lit(-1)).alias("n_words"), F.coalesce("result.error", F.lit("")).alias("error"))


def _doc_index(spark, sf, keep: Column) -> DataFrame:
    return N.index_rows(N.ingest(doc_elements(spark, sf).where(keep), DIM))


def _checked(index: DataFrame) -> DataFrame:
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x)
    return index.select("node_id", "source", "source_url", "filetype", F.size("images").alias("n_images"), F.round(total, 4).alias("total"))


def save_load_index(spark, sf):
    path = scratch_path(spark, "index")
    io.save_index(_doc_index(spark, sf, F.lit(True)), path)
    return _checked(io.load_index(spark, path))


def append_index(spark, sf):
    """One part saved, then all appended twice: the same index as saved in one go."""
    path = scratch_path(spark, "index")
    io.save_index(_doc_index(spark, sf, F.col("source") == "src1"), path)
    rows = _doc_index(spark, sf, F.lit(True))
    io.append_index(rows, path)
    io.append_index(rows, path)
    return _checked(io.load_index(spark, path))


def merge_indexes(spark, sf):
    kind = F.col("metadata.filetype")
    return _checked(io.merge_indexes(_doc_index(spark, sf, kind != "image"), _doc_index(spark, sf, kind == "text/html"), _doc_index(spark, sf, kind != "text/html")))


def write_read_elements(fmt):
    def run(spark, sf):
        path = scratch_path(spark, "elements")
        io.write_elements(E.build_elements(part_pages(spark, sf)), path, fmt)
        back = io.read_elements(spark, path, fmt)
        return back.select(
            "element_id",
            "text",
            F.col("metadata.filetype").alias("filetype"),
            F.coalesce(T.row_sentence(F.col("metadata.row_data")), F.lit("")).alias("row"),
            F.coalesce(F.size("metadata.table_json"), F.lit(0)).alias("n_rows"),
        )

    return run


def write_read_arrays(spark, sf):
    """Elements as array files, one for each page, read back."""
    path = scratch_path(spark, "arrays")
    elements = E.build_elements(part_pages(spark, sf))
    meta = F.col("metadata")
    # In such files rows of a table are objects, as the readers of ``recover_json_rows`` have them.
    rows = F.transform(meta["table_json"], lambda r: F.map_from_entries(r))
    raw = elements.withColumn("metadata", meta.withField("table_json", rows).withField("row_data", F.map_from_entries(meta["row_data"])))
    arrays = raw.groupBy("metadata.source_url").agg(F.to_json(F.collect_list(F.struct(*raw.columns))).alias("value"))
    arrays.select("value").write.options(maxRecordsPerFile=1, compression="gzip").text(path)
    back = io.read_elements(spark, path)
    return back.select(
        "element_id",
        "text",
        F.col("metadata.filetype").alias("filetype"),
        F.coalesce(T.row_sentence(F.col("metadata.row_data")), F.lit("")).alias("row"),
        F.coalesce(F.size("metadata.table_json"), F.lit(0)).alias("n_rows"),
    )


def registry() -> dict[str, Query]:
    return {
        "read_pages": read_pages,
        "strip_boilerplate": strip_boilerplate,
        "strip_crossed": strip_crossed,
        "text_blocks": text_blocks("v2"),
        "text_blocks_v1": text_blocks("v1"),
        "block_predicate": block_predicate,
        "element_text": element_text,
        "page_text": page_text("v2"),
        "page_text_v1": page_text("v1"),
        "html_tables": html_tables,
        "page_images": page_images,
        "page_links": page_links,
        "resolve_urls": resolve_urls,
        "crawl_frontier": crawl_frontier(1, 5),
        "crawl_frontier_deep": crawl_frontier(2, 12),
        "unvisited_links": unvisited_links,
        "landed_links": landed_links,
        "parse_tables": parse_tables,
        "parse_spanned_tables": parse_spanned_tables,
        "recover_json": recover_json,
        "row_sentences": row_sentences,
        "table_elements": table_elements,
        "cell_questions": cell_questions,
        "row_keys": row_keys,
        "attach_images": attach_images,
        "image_bytes": image_bytes,
        "image_elements": image_elements,
        "label_prompts": label_prompts,
        "build_elements": build_elements("v2"),
        "build_elements_script": build_elements("script"),
        "element_ids": element_ids,
        "build_guard": build_guard,
        "profile_elements": profile_elements,
        "count_by_type": count_by_type,
        "describe_elements": describe_elements,
        "embedding_sizes": embedding_sizes,
        "page_report": page_report,
        "pick_text_and_source": pick_text_and_source,
        "image_lists": image_lists,
        "resolve_vectors": resolve_vectors,
        "embed_text": embed_text,
        "valid_vectors": valid_vectors,
        "node_ids": node_ids,
        "ingest_report": ingest_report,
        "chunk_words": chunk_words,
        "knn_search": knn_search,
        "knn_join": knn_join,
        "knn_join_blocks": knn_join_blocks,
        "hit_lookup": hit_lookup,
        "lookup_payload": lookup_payload,
        "clamp_k": clamp_k,
        "search_status": search_status,
        "answer_records": answer_records,
        "project_hits": project_hits,
        "build_context": build_context,
        "build_prompts": build_prompts,
        "format_sources": format_sources,
        "format_references": format_references,
        "answer_text": answer_text,
        "index_status": index_status,
        "saved_index_status": saved_index_status,
        "history_prompts": history_prompts,
        "map_model": map_model_lengths,
        "save_load_index": save_load_index,
        "append_index": append_index,
        "merge_indexes": merge_indexes,
        "write_read_elements": write_read_elements("parquet"),
        "write_read_elements_jsonl": write_read_elements("jsonl"),
        "write_read_elements_array": write_read_arrays,
    }
