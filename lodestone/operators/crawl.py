"""Which pages a bounded crawl would take, out of landed pages and a link table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import cut_lineage
from .pages import usable_pages
from .ranking import top_n


def unvisited(found: DataFrame, visited: DataFrame) -> DataFrame:
    """Links ``(start_url, url)`` not seen yet in the crawl they belong to, each once."""
    return found.dropDuplicates(["start_url", "url"]).join(visited, ["start_url", "url"], "left_anti")


def landed_urls(pages: DataFrame) -> DataFrame:
    """Urls of pages that were fetched. Markup, if there is any, must not be blank."""
    return (usable_pages(pages) if "html" in pages.columns else pages).select("url")


def landed(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """Candidates whose page was fetched; one that failed is skipped and takes no place under the cap."""
    return candidates.join(landed_urls(pages), "url", "left_semi")


def crawl_frontier(
    pages: DataFrame, links: DataFrame, starts: DataFrame, max_pages: int = 5, max_depth: int = 1
) -> DataFrame:
    """Pages of each crawl: ``start_url``, ``url``, ``depth``, ``ord`` from 1.

    From every start page its links are followed, breadth first, ``max_depth`` steps far and up to ``max_pages`` pages
    in order of depth and url. ``starts(start_url)`` may hold any number of crawls; all advance together, one join
    per step. Links are cut per page before they meet the crawls, so a hub brings each crawl ``2 * max_pages`` rows at most.
    """
    if "html" in pages.columns:
        pages = cut_lineage(landed_urls(pages))  # the markup is read once, not once per step
    # Of a page's links only these can matter: a crawl takes at most max_pages of them and has seen at most as many.
    useful = landed(links.select("src_url", F.col("dst_url").alias("url")).distinct(), pages)
    links = top_n(useful, ["src_url"], [F.col("url")], 2 * max_pages).select("src_url", F.col("url").alias("dst_url"))
    if max_depth > 1:
        links = cut_lineage(links)
    first = starts.select("start_url", F.col("start_url").alias("url")).distinct()
    visited = landed(first, pages).withColumn("depth", F.lit(0))
    for depth in range(1, max_depth + 1):
        if depth > 1:
            visited = cut_lineage(visited)  # it is read three times below
        edge = visited.where(F.col("depth") == depth - 1).select("start_url", F.col("url").alias("src_url"))
        found = links.join(edge, "src_url").select("start_url", F.col("dst_url").alias("url"))
        fresh = unvisited(found, visited)
        grown = visited.unionByName(fresh.withColumn("depth", F.lit(depth)))
        visited = top_n(grown, ["start_url"], [F.col("depth"), F.col("url")], max_pages, "ord").drop("ord")
    return top_n(visited, ["start_url"], [F.col("depth"), F.col("url")], max_pages, "ord").select(
        "start_url", "url", "depth", "ord"
    )
