"""Sitemap expansion: breadth-first over a ``sitemaps(url, xml)`` table.

The documents are parsed once into edges (parent, pos, loc), written to the
shared folder apart by whether they lead to another sitemap. Levels only join
the few edges that do: each joins its frontier with them, drops what was seen
before and writes the next frontier. They end when a level finds no new
sitemap, so cycles end and no depth is cut off. The page edges, by far the
most, meet the sitemaps of all levels in one join at the end, and are
shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.html import unescape
from shelfline.functions.text import strip
from shelfline.session import shared_dir

LOC = r"(?s)<(?:[A-Za-z0-9_.-]+:)?loc>\s*((?:<!\[CDATA\[.*?\]\]>|[^<])*)</(?:[A-Za-z0-9_.-]+:)?loc>"
CDATA = r"(?s)^<!\[CDATA\[(.*?)\]\]>$"
READABLE = r"</(?:[A-Za-z0-9_.-]+:)?(?:urlset|sitemapindex)>\s*$"


def sitemap_locs(docs: DataFrame, xml: str = "xml") -> DataFrame:
    """``loc`` values (any namespace prefix, e.g. ``image:loc``; CDATA as it stands) of readable documents."""
    readable = F.coalesce(F.col(xml).rlike(READABLE), F.lit(False))
    locs = F.when(readable, F.regexp_extract_all(F.col(xml), F.lit(LOC), 1))
    out = docs.select("*", F.posexplode(locs).alias("pos", "_loc")).withColumn("_loc", strip("_loc"))
    loc = F.when(F.col("_loc").rlike(CDATA), strip(F.regexp_extract("_loc", CDATA, 1))).otherwise(unescape("_loc"))
    return out.withColumn("loc", loc).drop("_loc").filter(F.col("loc") != "")


def expand_sitemaps(spark, sitemaps: DataFrame, roots: list[str] | DataFrame, max_nested: int | None = None) -> DataFrame:
    """Page URLs reachable from the root sitemaps (within ``max_nested`` levels, if given).

    ``.xml`` locs are followed, other locs are results. Returns (url, depth,
    ord): each URL once, with the BFS position where it was first found.
    """
    base = shared_dir(spark, "sitemap-bfs")
    edges = sitemap_locs(sitemaps.select("url", "xml")).select(
        F.col("url").alias("parent"), F.col("pos").cast("int").alias("pos"), "loc", F.col("loc").endswith(".xml").alias("nested"))
    edges.write.partitionBy("nested").parquet(f"{base}/edges")
    kinds = edges.schema
    edges = spark.read.schema(kinds).parquet(f"{base}/edges")
    if isinstance(roots, list):
        frontier = spark.createDataFrame([(u, [i]) for i, u in enumerate(roots)], "url string, ord array<int>")
    else:
        frontier = roots.select("url", F.array(F.col("pos").cast("int")).alias("ord"))
    level = frontier.groupBy("url").agg(F.min("ord").alias("ord")).withColumn("depth", F.lit(0))
    reached, depth = level, 0
    while max_nested is None or depth + 1 < max_nested:
        found = level.join(edges.filter("nested"), F.col("url") == F.col("parent")).select(F.col("loc").alias("url"), F.concat("ord", F.array("pos")).alias("ord"))
        found = found.groupBy("url").agg(F.min("ord").alias("ord")).join(reached.select("url"), "url", "left_anti")
        depth += 1
        path = f"{base}/level={depth}"
        found.withColumn("depth", F.lit(depth)).write.parquet(path)
        level = spark.read.schema(level.schema).parquet(path)
        if level.isEmpty():
            break
        reached = reached.unionByName(level)
    if max_nested == 0:
        reached = reached.limit(0)
    pages = reached.join(edges.filter("not nested"), F.col("url") == F.col("parent")).select(F.col("loc").alias("url"), F.struct("depth", F.concat("ord", F.array("pos")).alias("ord")).alias("_f"))
    first = pages.groupBy("url").agg(F.min("_f").alias("_f"))
    return first.select("url", F.col("_f.depth").alias("depth"), F.col("_f.ord").alias("ord"))
