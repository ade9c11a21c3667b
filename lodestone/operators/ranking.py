"""First n rows per key, safe for hot keys, and a filter on costly columns."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SALTS = 64


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """The first ``n`` rows per key in the given order, with their rank from 1.

    A salted round goes first, so that no task gets more than its share of a hot key, whatever ``n`` is.
    """
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
    first = Window.partitionBy(*keys, "_salt").orderBy(*order)
    some = rows.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= n).drop("_salt", "_rn")
    ranked = some.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank_col) <= n)


def where_once(df: DataFrame, condition: Column) -> DataFrame:
    """``where`` for conditions on costly columns.

    Catalyst pushes a filter below the projection that makes its columns, which makes them twice. A generator of one
    or no row is not pushed.
    """
    pass_on = F.explode(F.when(condition, F.array(F.lit(True))))
    return df.select("*", pass_on.alias("_kept")).drop("_kept")
