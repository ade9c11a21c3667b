"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs twice and the second run counts: the first compiles code and starts Python workers.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from lodestone.plans.registry import registry

HEADLINES = [
    "text_blocks",
    "page_text",
    "page_links",
    "page_images",
    "parse_tables",
    "parse_spanned_tables",
    "cell_questions",
    "build_elements",
    "crawl_frontier",
    "chunk_words",
    "embed_text",
    "ingest_report",
    "knn_search",
    "knn_join",
    "knn_join_blocks",
    "hit_lookup",
    "build_prompts",
    "history_prompts",
    "append_index",
    "merge_indexes",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lodestone-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    names = sys.argv[1:] or HEADLINES
    spark.read.parquet(f"{sf}/documents.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in list(queries) if names == ["all"] else names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - start, 3))
        seconds[name] = runs[-1]
        print(name, *runs, file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf)}))


if __name__ == "__main__":
    main()
