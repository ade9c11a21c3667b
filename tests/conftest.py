import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lodestone-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def pages(spark):
    """Rows of (url, html) from a list of markups; the n-th page is ``http://t.example/n``."""

    def make(*htmls, url=None):
        rows = [(url or f"http://t.example/{i}", h) for i, h in enumerate(htmls)]
        return spark.createDataFrame(rows, "url string, html string")

    return make
