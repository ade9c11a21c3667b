"""Hook for outside models: a user function run in batches on the executors."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.scratch import settle

BATCH = 500
MAX_FAILED = 0.5  # of the values handed over


def try_model(fn: Callable[[list], list], value: Column, returns: str, batch: int = BATCH) -> Column:
    """``fn`` over a column, as ``struct<value, error>``: it gets up to ``batch`` values and returns as many results.

    Null values never reach ``fn`` and give null for both. If a batch fails its values are tried one by one; those that
    fail give the text of their error and no value. What a value gives never depends on the rows around it.
    """

    def one_by_one(values: list) -> list:
        out = []
        for v in values:
            try:
                out.append((fn([v])[0], None))
            except Exception as e:
                out.append((None, f"{type(e).__name__}: {e}"))
        return out

    def run(values: list) -> list:
        try:
            out = list(fn(values))
        except Exception:
            return one_by_one(values)
        return [(v, None) for v in out] if len(out) == len(values) else one_by_one(values)

    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for wrapped in batches:
            # Each value comes in a list of its own, so that a null does not turn whole numbers into floats.
            given = [i for i, v in enumerate(wrapped) if v is not None and len(v)]
            out = [(None, None)] * len(wrapped)
            for start in range(0, len(given), batch):
                places = given[start : start + batch]
                values = [v.tolist()[0] if hasattr(v, "tolist") else v[0] for v in (wrapped.iloc[i] for i in places)]
                for i, result in zip(places, run(values), strict=True):
                    out[i] = result
            columns = [pd.Series([x[j] for x in out], index=wrapped.index, dtype=object) for j in (0, 1)]
            yield pd.DataFrame({"value": columns[0], "error": columns[1]})

    return F.pandas_udf(call, f"value {returns}, error string")(F.when(value.isNotNull(), F.array(value)))


def map_model(fn: Callable[[list], list], value: Column, returns: str, batch: int = BATCH) -> Column:
    """The values of ``try_model``: null where ``fn`` failed."""
    return try_model(fn, value, returns, batch)["value"]


def run_model(
    df: DataFrame, fn: Callable[[list], list], value: Column, returns: str, out_col: str = "result", max_failed: float = MAX_FAILED, batch: int = BATCH
) -> DataFrame:
    """``df`` with ``out_col``, the struct of ``try_model``, settled: the model is called once for each value.

    Values and failures of the whole job are counted on the way. If more than ``max_failed`` of the values failed this
    raises, so that an outage is no empty result.
    """
    seen = Observation()
    made = df.withColumn("_given", value.isNotNull()).withColumn(out_col, try_model(fn, value, returns, batch))
    failed = F.col(out_col)["error"]
    counts = [F.count_if("_given").alias("given"), F.count(failed).alias("failed"), F.max(failed).alias("error")]
    done = settle(made.observe(seen, *counts), "model")
    found = seen.get
    if found["failed"] > max_failed * found["given"]:
        raise RuntimeError(f"the model failed for {found['failed']} of {found['given']} values: {found['error']}")
    return done.drop("_given")
