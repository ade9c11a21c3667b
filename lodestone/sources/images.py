"""Landed image files and how they reach the images of pages."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Media types by file ending.
MIME_TYPES = {
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "webp": "image/webp",
    "bmp": "image/bmp",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "ico": "image/x-icon",
    "avif": "image/avif",
}


def mime_type(url: Column) -> Column:
    """Media type by the ending of the path, null if unknown."""
    ending = F.lower(F.regexp_extract(url, r"\.([A-Za-z0-9]+)(?:[?#].*)?$", 1))
    known = F.create_map(*[F.lit(x) for pair in MIME_TYPES.items() for x in pair])
    return F.try_element_at(known, ending)


def base64_text(content: Column) -> Column:
    """Base64 on one line, whatever the session says about line breaks."""
    return F.translate(F.base64(content), "\r\n", "")


def base64_bytes(text: Column) -> Column:
    """The bytes that a Base64 text stands for; null where it is none."""
    return F.try_to_binary(text, F.lit("base64"))


def read_image_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed image files as ``(url, content)``, their path as url."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("url"), "content")


def attach_images(images: DataFrame, files: DataFrame) -> DataFrame:
    """Add ``image_base64`` and ``image_mime_type`` from ``files(url, content)``; null where the file is missing.

    If the files have a column ``mime_type``, what the server said, it goes before the ending of the url; null or blank
    counts as not said. Bytes are encoded before the join, once per file. A picture that half the web shows makes a hot key
    on the left side of an outer join, which AQE splits.
    """
    said = F.trim("mime_type") if "mime_type" in files.columns else F.lit(None).cast("string")
    landed = files.select("url", F.struct("content", F.when(said != "", said).alias("said")).alias("file")).where("content is not null")
    one = landed.groupBy("url").agg(F.max("file").alias("file"))  # a file landed twice is one file
    payload = one.select(
        F.col("url").alias("image_url"), base64_text(F.col("file.content")).alias("image_base64"), F.col("file.said").alias("_said")
    )
    found = F.col("image_base64").isNotNull()
    kind = F.when(found, F.coalesce("_said", mime_type(F.col("image_url"))))
    return images.join(payload, "image_url", "left").withColumn("image_mime_type", kind).drop("_said")
