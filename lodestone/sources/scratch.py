"""Shared scratch space: where lineage is cut and intermediate tables go."""

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; where that is unset, one beside the warehouse's tables.

    A warehouse on a local disk is no shared folder; on a cluster that calls for a warning.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            warnings.warn(f"spark.checkpoint.dir is unset and the warehouse {warehouse} looks local: executors may not share it", stacklevel=2)
        named = f"{warehouse.rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the shared folder and go on from there, so that a lost executor costs no recomputation."""
    scratch_dir(df.sparkSession)
    return df.checkpoint()


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """The same as a Parquet table, which can be read by columns and parts."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
