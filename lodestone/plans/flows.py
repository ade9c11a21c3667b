"""The two flows a user runs: pages to an index, and questions to prompts."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.elements import CONTEXT_CHARS, FAILED_LABEL, asked_label, build_elements, embed_elements, label_prompt
from ..operators.ingest import embed_text, index_rows, ingest, ingest_guard, ingest_report
from ..operators.pages import page_images, page_text
from ..operators.prompts import build_context, build_prompts, format_sources
from ..operators.search import index_dim, knn_join, lookup_payload, search_status
from ..functions.text import is_blank
from ..functions.vectors import has_non_zero
from ..operators.model import MAX_FAILED, try_model
from ..schema import ELEMENT
from ..sources import io
from ..sources.images import attach_images
from ..sources.scratch import cut_lineage, settle

Model = Callable[[list], list] | None


def model_labels(pages: DataFrame, files: DataFrame, fn: Callable[[list], list], profile: str = "v2", max_failed: float = MAX_FAILED) -> DataFrame:
    """``labels(image_url, label)`` of all images with bytes, as a model names them.

    ``fn`` gets a list of ``{"prompt", "image_base64"}`` and returns as many labels. Each image is asked for once, with
    the text of the page of the smallest url that shows it. One for which the model failed is labelled so; if it failed for
    more than ``max_failed`` of them this raises. Of page texts only the start that the prompt shows moves.
    """
    once = page_images(pages).where("image_url <> ''").groupBy("image_url").agg(F.min("url").alias("url"))
    shown = attach_images(once, files).where("image_base64 <> ''")
    starts = page_text(pages, profile).select("url", F.left("text", F.lit(CONTEXT_CHARS + 1)).alias("context"))
    asked = shown.join(starts.groupBy("url").agg(F.min("context").alias("context")), "url", "left")
    prompt = label_prompt(F.coalesce("context", F.lit("")), F.col("image_base64"))
    question = F.struct(prompt.alias("prompt"), F.col("image_base64").alias("image_base64"))
    done = settle(asked.select("image_url", try_model(fn, question, "string").alias("found")), "labels")
    seen = done.agg(F.count("*").alias("asked"), F.count("found.error").alias("failed"), F.max("found.error").alias("error")).first()
    if seen["failed"] > max_failed * seen["asked"]:
        raise RuntimeError(f"the model failed for {seen['failed']} of {seen['asked']} images: {seen['error']}")
    named = F.when(F.col("found.error").isNotNull(), FAILED_LABEL).otherwise(asked_label(F.col("found.value"), F.lit("asked")))
    return done.select("image_url", named.alias("label"))


def pages_to_elements(
    pages: DataFrame,
    dim: int,
    fn: Model = None,
    profile: str = "v2",
    files: DataFrame | None = None,
    labels: DataFrame | None = None,
    label_fn: Model = None,
    table_fn: Model = None,
) -> DataFrame:
    """Elements of landed pages, with vectors. ``files(url, content)`` and ``labels(image_url, label)`` are optional.

    With ``files``, ``label_fn`` names the images (``model_labels``) for which ``labels`` has none; ``table_fn``
    reads the rows of tables (``build_elements``).
    """
    if label_fn is not None and files is not None:
        if labels is None:
            labels = model_labels(pages, files, label_fn, profile)
        else:
            others = files.join(labels.select(F.col("image_url").alias("url")), "url", "left_anti")
            labels = labels.select("image_url", "label").unionByName(model_labels(pages, others, label_fn, profile))
    return embed_elements(build_elements(pages, files, labels, profile, table_fn), dim, fn)


def elements_to_index(elements: DataFrame, dim: int, fn: Model = None) -> DataFrame:
    return index_rows(ingest(elements, dim, fn))


def ingest_to_index(elements: DataFrame, path: str, dim: int, fn: Model = None, max_failed: float = MAX_FAILED) -> DataFrame:
    """Embed once, save the index, and report. Fails before anything is saved if rows came in and none got a vector, or if the model
    failed for more than ``max_failed`` of the texts that it was given."""
    done = cut_lineage(ingest(elements, dim, fn))
    asked = F.col("fresh") & ~is_blank(F.col("text"))
    seen = done.agg(F.count_if(asked).alias("asked"), F.count("error").alias("failed"), F.max("error").alias("error")).first()
    if seen["failed"] > max_failed * seen["asked"]:
        raise RuntimeError(f"the model failed for {seen['failed']} of {seen['asked']} texts: {seen['error']}")
    report = cut_lineage(ingest_guard(ingest_report(done)))
    io.save_index(index_rows(done), path)
    return report


def follow_elements(spark: SparkSession, folder: str, path: str, checkpoint: str, dim: int, fn: Model = None, fmt: str = "jsonl") -> None:
    """Bring the index at ``path`` up to date with the element files that have landed in ``folder`` since the last call.

    A file stream remembers in ``checkpoint`` which files it has read; each batch is embedded and appended. Ids come from content, so a
    batch that is repeated after a failure, or an element that landed twice, adds nothing.
    """
    stream = spark.readStream.schema(io.STORED_ELEMENT).format("json" if fmt == "jsonl" else fmt).option("mode", "FAILFAST").load(folder)
    landed = stream.select(*ELEMENT.fieldNames())

    def add(batch: DataFrame, _: int) -> None:
        io.append_index(elements_to_index(batch, dim, fn), path)

    query = landed.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


@dataclass
class Retrieval:
    queries: DataFrame
    hits: DataFrame
    status: DataFrame
    prompts: DataFrame
    sources: DataFrame


def retrieve(index: DataFrame | str, queries: DataFrame, dim: int, k: int = 5, fn: Model = None) -> Retrieval:
    """Answer ``queries(query_id, query)`` from the index: ranked hits, a status each, prompts and source lists.

    ``index`` is best the path of a saved one: it is scanned for its vectors, then only the buckets that hold a hit are read for its
    payload. Queries are embedded once and settled; where the model failed for one, its status has the error. ``k`` is taken as it is;
    ``clamp_k`` is there for callers who want a limit.
    """
    spark = queries.sparkSession
    embedded = cut_lineage(embed_text(queries, "query", dim, fn, error_col="error"))
    saved = isinstance(index, str)
    rows = io.load_index(spark, index) if saved else index
    there = io.layout(spark, index) if saved else None
    length = there.dim if there else index_dim(rows)
    usable = embedded.where(has_non_zero(F.col("embedding")))
    near = knn_join(rows, usable.select("query_id", "embedding"), k, dim=length)
    hits = cut_lineage(io.lookup(near, index) if saved else lookup_payload(near, rows))
    contexts = build_context(hits).join(queries, "query_id")
    return Retrieval(embedded, hits, search_status(embedded, hits, dim=length or None), build_prompts(contexts), format_sources(hits))
