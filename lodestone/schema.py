"""Fixed schemas. Readers always pass one: nothing is inferred."""

from pyspark.sql import types as T

KV = "array<struct<k:string,v:string>>"

_TEXT = T.StringType()
_TEXTS = T.ArrayType(_TEXT)
_VECTOR = T.ArrayType(T.FloatType())
_PAIRS = T.ArrayType(T.StructType().add("k", _TEXT).add("v", _TEXT))


def _entry(table_json: T.DataType, row_data: T.DataType, images: T.DataType) -> T.StructType:
    metadata = (
        T.StructType()
        .add("filename", _TEXT)
        .add("source_url", _TEXT)
        .add("filetype", _TEXT)
        .add("embedding", _VECTOR)
        .add("content_blocks", _TEXTS)
        .add("table_html", _TEXT)
        .add("table_json", table_json)
        .add("table_sentences", _TEXTS)
        .add("row_data", row_data)
        .add("image_base64", images)
        .add("image_mime_type", _TEXT)
        .add("orig_img", T.StructType().add("url", _TEXT).add("alt", _TEXT))
        .add("label", _TEXT)
    )
    entry = T.StructType()
    for name in ("type", "element_id", "text", "chunk", "source"):
        entry = entry.add(name, _TEXT)
    return entry.add("metadata", metadata)


# What the engine works with.
ELEMENT = _entry(T.ArrayType(_PAIRS), _PAIRS, _TEXTS)

# What element files hold: these three fields vary in JSON type, so they are read as raw text.
ELEMENT_RAW = _entry(_TEXT, _TEXT, _TEXT)

INDEX = (
    T.StructType()
    .add("node_id", _TEXT)
    .add("text", _TEXT)
    .add("source", _TEXT)
    .add("source_url", _TEXT)
    .add("images", _TEXTS)
    .add("filetype", _TEXT)
    .add("embedding", _VECTOR)
)

# One spot of a table grid: its text, and whether the cell starts here or merely reaches this far.
GRID = T.ArrayType(T.ArrayType(T.StructType().add("text", _TEXT).add("first", T.BooleanType())))
