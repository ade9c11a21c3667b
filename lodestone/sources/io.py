"""Files in and out: pages and elements; the vector index has its own module, whose functions are here too."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ingest import image_list
from ..operators.tables import recover_json_rows
from ..schema import ELEMENT, ELEMENT_RAW
from .index import append_index, layout, load_index, lookup, merge_indexes, save_index, saved_index_status

__all__ = [
    "append_index",
    "file_sizes",
    "layout",
    "load_index",
    "lookup",
    "merge_indexes",
    "read_elements",
    "read_pages",
    "save_index",
    "saved_index_status",
    "write_elements",
]

PAGE = "url string, html string"
STORED_ELEMENT = StructType([*ELEMENT.fields]).add("filetype", "string")
NO_LINE = "\u0000"  # ends no line: JSON in UTF-8 cannot hold it
ROWS_A_FILE = 100_000  # of compressed lines, which one task reads


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed pages. ``fmt="files"`` takes a folder of HTML files, one page each, its path as url."""
    if fmt == "files":
        whole = spark.read.text(path, wholetext=True)
        return whole.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
    if fmt == "json":
        return spark.read.schema(PAGE).json(path)
    return spark.read.format(fmt).load(path)


def _settled(df: DataFrame) -> DataFrame:
    """The fields that array files hold in varying JSON types, brought to their types."""
    meta = F.col("metadata")
    single = F.concat(F.lit("["), meta["row_data"], F.lit("]"))
    settled = (
        meta.withField("table_json", recover_json_rows(meta["table_json"]))
        .withField("row_data", F.get(recover_json_rows(single), F.lit(0)))
        .withField("image_base64", image_list(meta["image_base64"]))
    )
    return df.withColumn("metadata", F.when(meta.isNotNull(), settled).cast(ELEMENT["metadata"].dataType))


def read_elements(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Element files: ``json`` (one array per file), or ``jsonl`` and ``parquet`` as ``write_elements`` leaves them.

    An array file, of UTF-8 and under 2 GB, is read whole by one task; large sets belong in the other two, which are split
    or dealt to several files. A broken file or one of another encoding fails the read.
    """
    if fmt == "json":
        # Read as one line, the raw texts of the varying fields are cut from it; multiLine goes back to the file for each.
        return _settled(spark.read.schema(ELEMENT_RAW).options(lineSep=NO_LINE, mode="FAILFAST").json(path))
    reader = spark.read.schema(STORED_ELEMENT).format("json" if fmt == "jsonl" else fmt).option("mode", "FAILFAST")
    return reader.load(path).select(*ELEMENT.fieldNames())


def write_elements(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Elements as ``parquet`` or ``jsonl``, in one folder per element type.

    The questions of a table all carry its markup, so lines are compressed (gzip), in files of at most ``ROWS_A_FILE``.
    """
    by_type = df.withColumn("filetype", F.coalesce("metadata.filetype", F.lit("none")))
    writer = by_type.write.mode(mode).partitionBy("filetype")
    if fmt == "jsonl":
        writer = writer.format("json").options(compression="gzip", maxRecordsPerFile=ROWS_A_FILE)
    else:
        writer = writer.format(fmt)
    writer.save(path)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of the files at a path; their content is not read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))
