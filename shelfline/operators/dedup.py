"""Order-preserving de-duplication, per-group limits and paging cut-offs.

Arrival order is explicit: the reference processed lists in order, so every
input carries order columns (e.g. ``endpoint_pos, item_pos``).

Skew: "first row per key" is ``row_number() = 1``, which Spark plans with a
partial group limit: a key holding a third of all rows is reduced to one row
per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def _ranked(df: DataFrame, key, order) -> DataFrame:
    n = "_n"
    while n in df.columns:
        n += "_"
    rank = F.row_number().over(Window.partitionBy(*_as_list(key)).orderBy(*order))
    return df.withColumn(n, rank).filter(F.col(n) == 1).drop(n)


def dedup_first(df: DataFrame, key="id", order=("endpoint_pos", "item_pos")) -> DataFrame:
    """First row per key in arrival order."""
    return _ranked(df, key, [F.col(c).asc() for c in _as_list(order)])


def dedup_last(df: DataFrame, key="id", order=("endpoint_pos", "item_pos")) -> DataFrame:
    """Last row per key in arrival order."""
    return _ranked(df, key, [F.col(c).desc() for c in _as_list(order)])


def ordered_distinct(df: DataFrame, value: str = "url", order=("pos",),
                     group=()) -> DataFrame:
    """First-seen distinct values: each value with its first position."""
    group, order = _as_list(group), _as_list(order)
    first = F.min(F.struct(*[F.col(c) for c in order])).alias("_first")
    out = df.groupBy(*group, value).agg(first)
    return out.select(*group, value, *[F.col(f"_first.{c}").alias(c) for c in order])


def limit_per_site(df: DataFrame, n: int, site: str = "site",
                   order=("endpoint_pos", "item_pos")) -> DataFrame:
    """First ``n`` rows per site in arrival order (0 = all).

    ``row_number() <= n`` is planned as a WindowGroupLimit, which keeps at
    most n rows per site in every map task before the shuffle.
    """
    if not n:
        return df
    w = Window.partitionBy(site).orderBy(*_as_list(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def dedup_stats(df: DataFrame, key: str = "id") -> DataFrame:
    """input rows, unique keys and removed duplicates, in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("input_rows"),
                  F.count_distinct(F.col(key)).alias("unique_rows")) \
        .withColumn("removed", F.col("input_rows") - F.col("unique_rows"))


def take_until_empty_page(pages: DataFrame, site: str = "site", page: str = "page",
                          n_items: str = "n_items", max_page: int | None = None) -> DataFrame:
    """Keep pages before the first page with no items, and up to ``max_page`` if given.

    The first empty page per site is a grouped ``min``; joining it back is a
    join against one row per site.
    """
    stop = (pages.filter(F.col(n_items) == 0).groupBy(site)
            .agg(F.min(page).alias("_stop")))
    # One row per site: Spark broadcasts it by its size, else AQE splits a hot site.
    keep = F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))
    if max_page is not None:
        keep = keep & (F.col(page) <= max_page)
    return pages.join(stop, site, "left").filter(keep).drop("_stop")
