"""Read queries over the products table: counts, groups, recency, samples.

Counting and grouping run as partial + final aggregates inside the plan
(the original fetched every row to the client and counted there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_products(products: DataFrame, columns=None, source: str | None = None) -> DataFrame:
    """Projection + optional ``source = x`` filter; both reach the Parquet scan."""
    df = products
    if source is not None:
        df = df.filter(F.col("source") == source)
    return df.select(*columns) if columns else df


def product_count(products: DataFrame, source: str | None = None) -> DataFrame:
    df = products if source is None else products.filter(F.col("source") == source)
    return df.agg(F.count(F.lit(1)).alias("n_products"))


def count_by_source(products: DataFrame) -> DataFrame:
    """Group count; a missing source counts as 'unknown'."""
    return (products.groupBy(F.coalesce(F.col("source"), F.lit("unknown")).alias("source"))
            .agg(F.count(F.lit(1)).alias("n_products")))


def site_totals(imported: DataFrame, site: str = "brand") -> DataFrame:
    """Imported rows per site plus a grand total (site = null)."""
    return imported.rollup(site).agg(F.count(F.lit(1)).alias("imported"))


def recent_products(products: DataFrame, source: str | None = None, k: int = 10,
                    ts: str = "created_at", tie: str = "id") -> DataFrame:
    """Newest ``k`` rows of a source (TakeOrderedAndProject: a per-task top-k)."""
    df = products if source is None else products.filter(F.col("source") == source)
    return df.orderBy(F.col(ts).desc(), F.col(tie).asc()).limit(k)


def sample_products(products: DataFrame, n: int = 3, source: str | None = None,
                    order: str = "id", title_chars: int = 40) -> DataFrame:
    """First ``n`` rows by ``order`` with the title cut to ``title_chars`` for display."""
    df = products if source is None else products.filter(F.col("source") == source)
    return (df.orderBy(order).limit(n)
            .select(order, F.substring("title", 1, title_chars).alias("title_short"), "brand"))
