"""From entries to index rows: pick text and source, embed what has no vector, check, report."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_non_empty, is_blank, let, non_empty, words
from ..functions.vectors import has_non_zero, hashed_embedding
from ..schema import INDEX
from .model import try_model
from .ranking import where_once

# The cut before a model is called, and the chunk sizes in words.
CHUNK_SIZE = 350
CHUNK_OVERLAP = 100

SEPARATOR = "\u0001"


def pick_text(chunk: Column, text: Column) -> Column:
    return first_non_empty(chunk, text)


def pick_source(source: Column, filename: Column) -> Column:
    return first_non_empty(source, filename)


def image_list(raw: Column) -> Column:
    """Image payloads as a list: one text becomes a list of one, JSON lists are read, null gives an empty list."""
    listed = F.from_json(raw, "array<string>")
    return (
        F.when(raw.isNull() | (raw == ""), F.array().cast("array<string>"))
        .when(raw.rlike(r"^\s*\["), F.coalesce(listed, F.array(raw)))
        .otherwise(F.array(raw))
    )


def hash_id(*parts: Column) -> Column:
    """Id from content: the same row gets the same id on every run and every retry."""
    return F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def chunk_words(
    df: DataFrame,
    text_col: str = "text",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    unit: str = "word",
) -> DataFrame:
    """One row per chunk: the other columns, ``chunk_no`` from 0 and ``chunk``.

    Text of up to ``size`` words is one chunk, blank text none. ``unit="char"`` is for scripts without spaces.
    """
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    items, sep = (words(F.col(text_col)), " ") if unit == "word" else (F.split(text_col, ""), "")
    kept = [c for c in df.columns if c != text_col]

    def chunks(w: Column) -> Column:
        last = F.greatest(F.ceil((F.size(w) - size) / step).cast("int"), F.lit(0))
        cut_at = lambda i: F.array_join(F.slice(w, i * step + 1, size), sep)
        return F.when(F.size(w) > 0, F.transform(F.sequence(F.lit(0), last), cut_at))

    # Only finished chunks leave the row: a row per chunk with all words in it would grow with the square of the text.
    return df.select(*kept, F.posexplode(let(items, chunks)).alias("chunk_no", "chunk"))


def embedding_and_error(
    text: Column, dim: int, fn: Callable[[list], list] | None = None, max_chars: int | None = None
) -> tuple[Column, Column]:
    """Vector of a text, and why the model gave none. Null text gives null; blank text, a failure or a wrong length zeros.

    Without ``fn`` the hashed bag of words over the whole text is used. With ``fn`` (a batch of texts in, vectors
    out) texts go over whole too, or cut to ``max_chars`` if that is given.
    """
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    if fn is None:
        source = text if max_chars is None else F.left(text, F.lit(max_chars))
        return F.when(text.isNotNull(), hashed_embedding(source, dim)), F.lit(None).cast("string")
    asked = F.when(~is_blank(text), text if max_chars is None else F.left(text, F.lit(max_chars)))
    made = try_model(fn, asked, "array<float>")
    vector = made["value"]
    size = F.size(vector)
    odd = F.when(size != dim, F.concat(F.lit("vector of length "), size.cast("string"), F.lit(f" instead of {dim}")))
    return F.when(text.isNotNull(), F.when(size == dim, vector).otherwise(zeros)), F.coalesce(made["error"], odd)


def embedding_of(
    text: Column, dim: int, fn: Callable[[list], list] | None = None, max_chars: int | None = None
) -> Column:
    """The vector of ``embedding_and_error``."""
    return embedding_and_error(text, dim, fn, max_chars)[0]


def embed_text(
    df: DataFrame,
    text_col: str = "text",
    dim: int = 64,
    fn: Callable[[list], list] | None = None,
    max_chars: int | None = None,
    out_col: str = "embedding",
    error_col: str | None = None,
) -> DataFrame:
    """Add the vector of a text, and in ``error_col``, if it has a name, the model's error."""
    vector, error = embedding_and_error(F.col(text_col), dim, fn, max_chars)
    return df.withColumns({out_col: vector} | ({error_col: error} if error_col else {}))


def to_entries(elements: DataFrame) -> DataFrame:
    """Element rows as ingest entries: text and source settled, stored vector in ``stored``."""
    meta = F.col("metadata")
    images = meta["image_base64"]
    if dict(elements.select("metadata.image_base64").dtypes)["image_base64"] == "string":
        images = image_list(images)
    return elements.select(
        non_empty(F.col("element_id")).alias("entry_id"),
        pick_text(F.col("chunk"), F.col("text")).alias("text"),
        pick_source(F.col("source"), meta["filename"]).alias("source"),
        meta["source_url"].alias("source_url"),
        F.coalesce(images, F.array().cast("array<string>")).alias("images"),
        F.coalesce(meta["filetype"], F.lit("")).alias("filetype"),
        meta["embedding"].alias("stored"),
    )


def has_vector(stored: Column) -> Column:
    return F.coalesce(F.size(stored) > 0, F.lit(False))


def resolve_vectors(
    entries: DataFrame, dim: int, fn: Callable[[list], list] | None = None, max_chars: int | None = None
) -> DataFrame:
    """Add ``fresh``, ``embedding`` (the stored vector as it is, else one made from the text) and the model's ``error``.

    Only texts that need a vector are handed over; the rest pass as null, in the same scan.
    """
    stored, text = F.col("stored"), F.col("text")
    wanted = F.when(~has_vector(stored) & ~is_blank(text), text)
    made, error = embedding_and_error(wanted, dim, fn, max_chars)
    vector = F.when(has_vector(stored), stored).otherwise(made)
    return entries.withColumns({"fresh": ~has_vector(stored), "embedding": vector, "error": error})


def valid_vectors(entries: DataFrame, dim: int) -> DataFrame:
    """Add ``reason`` for dropping a row (``blank``, ``dim``, ``zero``), null if it is good.

    Every vector must have the right length; blank text and zeros matter for fresh vectors only.
    """
    vec = F.col("embedding")
    return entries.withColumn(
        "reason",
        F.when(F.col("fresh") & is_blank(F.col("text")), "blank")
        .when(F.coalesce(F.size(vec), F.lit(0)) != dim, "dim")
        .when(F.col("fresh") & ~has_non_zero(vec), "zero"),
    )


def with_node_id(entries: DataFrame) -> DataFrame:
    """Add ``node_id``: the entry's own id, or a hash of what it says and where it is from."""
    made = hash_id(*[F.col(c) for c in ("source", "source_url", "filetype", "text")])
    return entries.withColumn("node_id", F.coalesce("entry_id", made))


def ingest(
    elements: DataFrame, dim: int, fn: Callable[[list], list] | None = None, max_chars: int | None = None
) -> DataFrame:
    """Entries with vector, ``reason`` and ``node_id``; feed it to ``index_rows`` and ``ingest_report``."""
    return with_node_id(valid_vectors(resolve_vectors(to_entries(elements), dim, fn, max_chars), dim))


def index_rows(ingested: DataFrame) -> DataFrame:
    return where_once(ingested, F.col("reason").isNull()).select(*INDEX.fieldNames())


def ingest_report(ingested: DataFrame) -> DataFrame:
    """One row: processed, skipped, tables, images. Skipped rows count as tables or images too."""
    table = F.col("filetype").contains("table")
    return ingested.agg(
        F.count_if(F.col("reason").isNull()).alias("processed"),
        F.count_if(F.col("reason").isNotNull()).alias("skipped"),
        F.count_if(table).alias("tables"),
        F.count_if(~table & F.col("filetype").contains("image")).alias("images"),
    )


def model_errors(ingested: DataFrame) -> DataFrame:
    """``error``, ``n``: how often the model gave each error."""
    return ingested.where("error is not null").groupBy("error").agg(F.count("*").alias("n"))


def ingest_guard(report: DataFrame) -> DataFrame:
    """The report as it is; running it fails if rows came in and no vector came out."""
    bad = (F.col("skipped") > 0) & (F.col("processed") == 0)
    failed = F.raise_error(F.concat(F.lit("no entry got a vector, of "), F.col("skipped").cast("string")))
    return report.withColumn("processed", F.when(bad, failed.cast("bigint")).otherwise(F.col("processed")))
