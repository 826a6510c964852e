"""File sources: raw feed documents, HTML pages, sitemaps and images as tables.

Each file is one document (``wholetext``), which is the unit the original
fetched per request; its path becomes the endpoint / URL unless a mapping
table says otherwise. Reading is split across tasks by file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _norm_path(c):
    """Local paths compare without the ``file:`` scheme prefix."""
    return F.regexp_replace(c, r"^file:(//)?(?=/)", "")


def _whole_files(spark: SparkSession, paths) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.option("wholetext", "true").text(paths)
            .select(_norm_path(F.col("_metadata.file_path")).alias("path"), F.col("value")))


def _with_urls(docs: DataFrame, urls: DataFrame) -> DataFrame:
    return docs.join(urls.withColumn("path", _norm_path(F.col("path"))), "path", "left")


def read_feed_documents(spark: SparkSession, paths, urls: DataFrame | None = None) -> DataFrame:
    """``feeds(endpoint, endpoint_pos, page, payload)`` from JSON files.

    ``urls`` (path, endpoint, endpoint_pos) maps files to their endpoints;
    without it the file path is the endpoint, and at position 0 all documents
    arrive in the order of their paths.
    """
    docs = _whole_files(spark, paths).withColumnRenamed("value", "payload")
    if urls is not None:
        docs = _with_urls(docs, urls)
    else:
        docs = docs.withColumn("endpoint", F.col("path")).withColumn("endpoint_pos", F.lit(0))
    return docs.select("endpoint", "endpoint_pos", F.lit(0).cast("bigint").alias("page"), "payload")


def read_pages(spark: SparkSession, paths, urls: DataFrame | None = None) -> DataFrame:
    """``pages(page_id, url, html)`` from HTML files (page id = hash of the path)."""
    docs = _whole_files(spark, paths)
    if urls is not None:
        docs = _with_urls(docs, urls)
    else:
        docs = docs.withColumn("url", F.col("path"))
    return docs.select(F.xxhash64("path").alias("page_id"), "url", F.col("value").alias("html"))


def read_sitemaps(spark: SparkSession, paths, urls: DataFrame | None = None) -> DataFrame:
    """``sitemaps(url, xml)`` from XML files."""
    docs = _whole_files(spark, paths)
    if urls is not None:
        docs = _with_urls(docs, urls)
    else:
        docs = docs.withColumn("url", F.col("path"))
    return docs.select("url", F.col("value").alias("xml"))


def read_images(spark: SparkSession, paths, urls: DataFrame | None = None, max_bytes: int = 64 << 20) -> DataFrame:
    """``images(image_url, length, content)`` from image files, for ``embed_column``.

    ``urls`` (path, url) maps files to their URLs; without it the path stands
    for the URL. The length limit is pushed into the scan: a file of over
    ``max_bytes`` is listed with null content and never read; Spark lists no
    empty file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    small = files.filter(F.col("length") <= max_bytes).select("path", "length", "content")
    large = files.filter(F.col("length") > max_bytes).select("path", "length", F.lit(None).cast("binary").alias("content"))
    found = small.unionByName(large).withColumn("path", _norm_path(F.col("path")))
    found = _with_urls(found, urls) if urls is not None else found.withColumn("url", F.col("path"))
    return found.select(F.col("url").alias("image_url"), "length", "content")
