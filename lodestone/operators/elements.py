"""Elements: one row per page text, table, table cell question or image."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.text import cut, let, non_empty, trim_ws
from ..functions.urls import resolve_url
from ..schema import ELEMENT
from ..sources.images import attach_images
from .ingest import embedding_of, hash_id
from .model import map_model
from .pages import cleaned, page_images, with_blocks, with_images, with_tables
from .tables import parse_tables, questions_of, recover_json_rows, sentences_of

# The type of every element, and the instruction given with an image.
TYPE = "CompositeElement"
LABEL_PROMPT = """
You are a highly knowledgeable image classification assistant specializing in industrial mechanical components.
Your job is to analyze a single image (provided as a Base64‐encoded string) in the context of its web page,
and return exactly one concise English label that best describes what the image depicts.

Requirements:
- Respond with only the label, no additional commentary or punctuation.
- Use Title-Case (e.g. "Horizontal Motor Gear Reducer").
- Do not include words like "Photo of" or "Image of"; just the component name.
- If the image shows a type of gear reducer, mention its orientation or mounting style
  (e.g. Horizontal, Vertical, Direct-Drive, Dual-Shaft).
- If uncertain between two, choose the more specific label.

Now, based on the following context and image, provide only the best single label.

PAGE CONTEXT:
{page_context}

IMAGE DATA (base64, truncated):
{image_b64_truncated}

Label:"""
NO_IMAGE_LABEL = "Unknown Image"
FAILED_LABEL = "Classification Error"
CONTEXT_CHARS = 500
IMAGE_CHARS = 200


def element_id(source_url: Column, filetype: Column, ordinal: Column, text: Column) -> Column:
    return hash_id(source_url, filetype, ordinal, text)


def label_prompt(
    context: Column, image_base64: Column, template: str = LABEL_PROMPT, context_chars: int = CONTEXT_CHARS, image_chars: int = IMAGE_CHARS
) -> Column:
    """What to ask about an image: page context cut to ``context_chars``, the start of its data always marked as cut.

    Null if there are no bytes: there is nothing to ask then.
    """
    before, rest = template.split("{page_context}")
    middle, after = rest.split("{image_b64_truncated}")
    data = F.concat(F.left(image_base64, F.lit(image_chars)), F.lit("..."))
    prompt = F.concat(F.lit(before), cut(context, context_chars), F.lit(middle), data, F.lit(after))
    return F.when(image_base64 != "", prompt)


def asked_label(answer: Column, image_base64: Column) -> Column:
    """Label a model gave, trimmed; without bytes it was not asked and the image is unknown."""
    return F.when(F.coalesce(image_base64, F.lit("")) == "", NO_IMAGE_LABEL).otherwise(trim_ws(answer))


def image_label(label: Column, alt: Column, image_base64: Column) -> Column:
    """Label of an image: the given one if there are bytes to judge, else its alt text, else none."""
    return F.coalesce(F.when(image_base64.isNotNull(), non_empty(label)), non_empty(alt))


_ITEM = (
    "array<struct<kind:string,no:int,text:string,content_blocks:array<string>,table_html:string,src:string,alt:string>>"
)


def make_element(source_url: Column, filetype: str, ordinal: Column, text: Column, **fields: Column) -> Column:
    """One element as a struct with every field of the schema."""

    def build(identity: Column) -> Column:
        given = {"filename": identity, "source_url": source_url, "filetype": F.lit(filetype), **fields}
        none = F.lit(None)
        meta = F.struct(*[given.get(n, none).alias(n) for n in ELEMENT["metadata"].dataType.fieldNames()])
        top = {"type": F.lit(TYPE), "element_id": identity, "text": text, "metadata": meta}
        return F.struct(*[top.get(n, none).alias(n) for n in ELEMENT.fieldNames()]).cast(ELEMENT)

    return let(element_id(source_url, F.lit(filetype), ordinal, text), build)


def _no_elements() -> Column:
    return F.array().cast(ArrayType(ELEMENT))


def text_element_of(url: Column, text: Column, blocks: Column) -> Column:
    return make_element(url, "text/html", F.lit(1), text, content_blocks=blocks)


def table_element_list(url: Column, no: Column, html: Column, rows: Column, keep_empty: bool) -> Column:
    """The element of a parsed table, if it has rows and, unless ``keep_empty``, a row sentence."""

    def build(sentences: Column) -> Column:
        element = make_element(
            url,
            "table/html",
            no,
            F.array_join(sentences, "\n"),
            table_html=html,
            table_json=rows,
            table_sentences=sentences,
        )
        wanted = (F.size(rows) > 0) if keep_empty else (F.size(sentences) > 0)
        return F.when(wanted, F.array(element)).otherwise(_no_elements())

    return let(sentences_of(rows), build)


def question_element_list(url: Column, no: Column, html: Column, rows: Column) -> Column:
    """The elements of all cell questions of a parsed table."""

    def build(q: Column) -> Column:
        ordinal = F.concat_ws(".", no, q["row_no"], q["col_no"])
        return make_element(url, "table_row_query", ordinal, q["question"], table_html=html, row_data=q["row_data"])

    return F.transform(questions_of(rows), build)


def text_elements(texts: DataFrame) -> DataFrame:
    """From ``(url, text, content_blocks)``."""
    return texts.select(F.inline(F.array(text_element_of(F.col("url"), F.col("text"), F.col("content_blocks")))))


def table_elements(tables: DataFrame, keep_empty: bool = False) -> DataFrame:
    """From parsed tables ``(url, table_no, table_html, table_rows)``: their row sentences, one per line."""
    cols = [F.col(c) for c in ("url", "table_no", "table_html", "table_rows")]
    return tables.select(F.inline(table_element_list(*cols, keep_empty)))


def question_elements(tables: DataFrame) -> DataFrame:
    """From parsed tables: one element per cell question."""
    cols = [F.col(c) for c in ("url", "table_no", "table_html", "table_rows")]
    return tables.select(F.inline(question_element_list(*cols)))


def image_element_of(
    url: Column,
    no: Column,
    image_url: Column,
    alt: Column,
    label: Column | None = None,
    image_base64: Column | None = None,
    mime_type: Column | None = None,
    text_is_label: bool = True,
) -> Column:
    missing = F.lit(None).cast("string")
    payload = missing if image_base64 is None else image_base64
    name = image_label(missing if label is None else label, alt, payload)
    return make_element(
        url,
        "image",
        no,
        name if text_is_label else F.lit(""),
        filename=name,
        image_base64=F.when(payload.isNotNull(), F.array(payload)),
        image_mime_type=missing if mime_type is None else mime_type,
        orig_img=F.struct(image_url.alias("url"), alt.alias("alt")),
        label=name,
    )


def image_elements(images: DataFrame, labels: DataFrame | None = None, text_is_label: bool = True) -> DataFrame:
    """From ``(url, image_no, image_url, alt)``, with payload columns if attached, and ``labels(image_url, label)``.

    Of several labels of one image the last in order of text counts.
    """
    rows = images.where(F.coalesce(F.col("image_url"), F.lit("")) != "")
    if labels is not None:
        rows = rows.join(labels.groupBy("image_url").agg(F.max("label").alias("label")), "image_url", "left")
    optional = [F.col(c) if c in rows.columns else None for c in ("label", "image_base64", "image_mime_type")]
    cols = [F.col(c) for c in ("url", "image_no", "image_url", "alt")]
    return rows.select(F.inline(F.array(image_element_of(*cols, *optional, text_is_label=text_is_label))))


def page_items(pages: DataFrame, profile: str = "v2", with_pictures: bool = True) -> DataFrame:
    """The extracts of each page in one scan: one row per page text, table or image, told apart by ``kind``.

    Columns of the other kinds are null. The profile ``v1`` gives page texts only.
    """
    null = F.lit(None)
    blocks = F.transform("blocks", lambda b: b["text"])
    text = trim_ws(F.array_join(blocks, "\n"))
    parts = [F.array(F.struct(F.lit("text"), F.lit(1), text, blocks, null, null, null)).cast(_ITEM)]
    rows = with_blocks(cleaned(pages), profile)
    if profile == "v2":
        parts = [F.when(F.size("blocks") > 0, parts[0]).otherwise(F.array().cast(_ITEM))]
    if profile != "v1":
        rows = with_tables(rows, profile)
        tables = F.transform("tables", lambda t, i: F.struct(F.lit("table"), i + 1, null, null, t, null, null))
        parts.append(tables.cast(_ITEM))
    if profile != "v1" and with_pictures:
        rows = with_images(rows)
        images = F.transform(
            "images", lambda m, i: F.struct(F.lit("image"), i + 1, null, null, null, m["src"], m["alt"])
        )
        parts.append(images.cast(_ITEM))
    return rows.select("url", F.inline(F.concat(*parts)))


def build_elements(
    pages: DataFrame,
    files: DataFrame | None = None,
    labels: DataFrame | None = None,
    profile: str = "v2",
    table_fn: Callable[[list], list] | None = None,
) -> DataFrame:
    """Elements of all kinds of landed pages, in no promised order.

    ``table_fn`` is a model that gets the markup of tables and answers with text that holds their rows as JSON. A table
    for which it fails, or whose answer holds no rows, keeps the rows read from its markup.

    Pages are scanned once and nothing shuffles. Only if ``files(url, content)`` or ``labels(image_url, label)`` are
    to be joined do the images come from a scan of their own.
    """
    script = profile == "script"
    joined = profile != "v1" and (files is not None or labels is not None)
    items = page_items(pages, profile, with_pictures=not joined)
    url, no, kind = F.col("url"), F.col("no"), F.col("kind")
    text = F.array(text_element_of(url, F.col("text"), F.col("content_blocks")))
    if profile == "v1":
        return items.select(F.inline(text))
    rows = parse_tables(items)
    if table_fn is not None:
        answered = recover_json_rows(map_model(table_fn, F.col("table_html"), "string"))
        rows = rows.withColumn("table_rows", F.coalesce(answered, "table_rows"))
    table = [url, no, F.col("table_html"), F.col("table_rows")]
    image_url = resolve_url(url, F.col("src"))
    elements = rows.select(
        F.inline(
            F.when(kind == "text", text)
            .when(kind == "table", F.concat(table_element_list(*table, script), question_element_list(*table)))
            .otherwise(F.array(let(image_url, lambda u: image_element_of(url, no, u, F.col("alt"), text_is_label=not script))))
        )
    )
    if not joined:
        return elements
    images = page_images(pages)
    if files is not None:
        images = attach_images(images, files)
    return elements.unionByName(image_elements(images, labels, text_is_label=not script))


def embed_elements(elements: DataFrame, dim: int, fn: Callable[[list], list] | None = None) -> DataFrame:
    """Store a vector in every element but images; one whose text gives none keeps an empty list."""
    meta, text = F.col("metadata"), F.col("text")
    vector = embedding_of(F.when(meta["filetype"] != "image", text), dim, fn)
    usable = F.filter(F.array(vector), lambda v: F.exists(v, lambda x: x != 0))
    stored = F.coalesce(F.get(usable, F.lit(0)), F.array().cast("array<float>"))
    stored = F.when(meta["filetype"] != "image", stored)
    return elements.withColumn("metadata", meta.withField("embedding", stored))


def _has_vector() -> Column:
    return F.coalesce(F.size("metadata.embedding") > 0, F.lit(False))


def build_guard(elements: DataFrame) -> DataFrame:
    """One row: elements, and how many have a vector. Running it fails if there are elements and none has one."""
    counts = elements.agg(F.count("*").alias("elements"), F.count_if(_has_vector()).alias("embedded"))
    bad = (F.col("elements") > 0) & (F.col("embedded") == 0)
    failed = F.raise_error(F.concat(F.lit("no element has an embedding, of "), F.col("elements").cast("string")))
    return counts.select("elements", F.when(bad, failed.cast("bigint")).otherwise(F.col("embedded")).alias("embedded"))


def profile_elements(elements: DataFrame) -> DataFrame:
    """One row: elements, tables, images, with vector, and their share in percent (null if there are none).

    A cell question carries its table and so counts as one.
    """
    meta = F.col("metadata")
    table = meta["table_html"].isNotNull() | (F.coalesce(meta["filetype"], F.lit("")) == "table/html")
    image = meta["image_base64"].isNotNull() | (F.coalesce(meta["filetype"], F.lit("")) == "image")
    embedded = F.count_if(_has_vector())
    return elements.agg(
        F.count("*").alias("elements"),
        F.count_if(table).alias("tables"),
        F.count_if(image).alias("images"),
        embedded.alias("with_embedding"),
        F.round(F.try_divide(embedded * 100.0, F.count("*")), 2).alias("embedding_pct"),
    )


def count_by_type(elements: DataFrame) -> DataFrame:
    return elements.groupBy(F.coalesce("metadata.filetype", F.lit("")).alias("filetype")).agg(F.count("*").alias("n"))


def embedding_sizes(elements: DataFrame) -> DataFrame:
    """How many elements have a vector of which length; null where there is none."""
    return elements.groupBy(F.size("metadata.embedding").alias("dim")).agg(F.count("*").alias("n"))


def describe_elements(elements: DataFrame) -> DataFrame:
    """One row per field: how many elements fill it, and the shortest and longest value of list fields."""
    meta_fields = ELEMENT["metadata"].dataType.fields
    names = [f.name for f in ELEMENT.fields if f.name != "metadata"] + [f"metadata.{f.name}" for f in meta_fields]
    lists = {f"metadata.{f.name}" for f in meta_fields if f.dataType.typeName() == "array"}
    one = elements.agg(
        *[F.count(F.col(n)).alias(f"n{i}") for i, n in enumerate(names)],
        *[
            f(F.size(n)) .alias(f"{f.__name__}{i}")
            for i, n in enumerate(names)
            if n in lists
            for f in (F.min, F.max)
        ],
    )
    rows = [
        F.struct(
            F.lit(n).alias("field"),
            F.col(f"n{i}").alias("filled"),
            (F.col(f"min{i}") if n in lists else F.lit(None).cast("int")).alias("shortest"),
            (F.col(f"max{i}") if n in lists else F.lit(None).cast("int")).alias("longest"),
        )
        for i, n in enumerate(names)
    ]
    return one.select(F.inline(F.array(*rows)))
