"""Table maintenance: snapshot upsert, source-scoped prune, pending vectors.

Parquet has no MERGE, so an upsert produces a new snapshot:

    new = (target rows whose id is not in the batch)
        ∪ (batch rows, with columns the batch lacks taken from the target)

Every operator is one lazy plan of the same shape whatever the sizes: equi-joins
against the batch's ids, which Spark broadcasts or shuffles by their measured
bytes (AQE splits skewed keys). No job runs while a plan is built. Persisted
tables apply these per partition through ``shelfline.sources.table.PartitionedTable``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import constants as K
from shelfline.functions.text import truthy
from shelfline.operators.dedup import dedup_first


def categories_table(spark) -> DataFrame:
    """The fixed category dimension (24 rows)."""
    return spark.createDataFrame(list(K.CATEGORY_NAMES.items()),
                                 "category_id string, category string")


def category_lookup(df: DataFrame, categories: DataFrame, endpoint: str = "endpoint",
                    out: str = "category") -> DataFrame:
    """Left equi-join of ``/category/<id>/`` in the endpoint to a category table.

    No endpoint, no id in it, or an unknown id all give 'clothing'.
    """
    dim = categories.select(F.col("category_id").alias("_cid"), F.col("category").alias("_cname"))
    keyed = df.withColumn("_cid", F.regexp_extract(F.coalesce(F.col(endpoint), F.lit("")),
                                                   r"/category/(\d+)/", 1))
    joined = keyed.join(dim, "_cid", "left")
    return (joined.withColumn(out, F.coalesce(F.col("_cname"), F.lit(K.DEFAULT_CATEGORY)))
            .drop("_cid", "_cname"))


def unique_batch(batch: DataFrame, key: str = "id", order=None) -> DataFrame:
    """Batch rows with a key, one per key: the first in ``order``; without one,
    equal keys are told apart by a hash of the row, so reruns agree."""
    named = batch.filter(truthy(F.col(key).cast("string")))
    if order:
        order = [order] if isinstance(order, str) else list(order)
        return dedup_first(named, key, order).drop(*order)
    return dedup_first(named.withColumn("_h", F.xxhash64(F.to_json(F.struct(*batch.columns)))), key, "_h").drop("_h")


def upsert_products(target: DataFrame, batch: DataFrame, key: str = "id",
                    drop=("embedding",), order=None) -> DataFrame:
    """Insert-or-update by ``key``.

    The batch is first reduced to one row per key (``unique_batch``). Updated
    rows take *every* column the batch has, nulls included; columns the batch
    lacks keep the target's value (null for inserts).
    """
    batch = unique_batch(batch, key, order)
    batch = batch.drop(*[c for c in drop if c in batch.columns])
    cols = list(dict.fromkeys(target.columns + batch.columns))
    ids = batch.select(key)
    kept = target.join(ids, key, "left_anti")
    lacking = [c for c in target.columns if c not in batch.columns]
    updated = batch
    if lacking:
        # Old values of the updated rows only, one row per id.
        old = target.join(ids, key, "left_semi").select(key, *lacking).dropDuplicates([key])
        updated = batch.join(old, key, "left")
    for c in cols:
        if c not in kept.columns:
            kept = kept.withColumn(c, F.lit(None).cast(batch.schema[c].dataType))
    return kept.select(*cols).unionByName(updated.select(*cols))


def prune_missing(target: DataFrame, current_ids: DataFrame, source: str, key: str = "id") -> DataFrame:
    """Delete rows of ``source`` whose id is not in ``current_ids``.

    An empty id set deletes nothing; other sources are untouched. Both are
    decided inside the plan: ``_any`` is one row if there is an id at all, and
    meets the target on its source.
    """
    ids = current_ids.select(key).distinct().withColumn("_seen", F.lit(True))
    any_id = current_ids.select(F.lit(source).alias("source"), F.lit(True).alias("_any")).limit(1)
    joined = target.join(any_id, "source", "left").join(ids, key, "left")
    return joined.filter(F.col("_any").isNull() | F.col("_seen").isNotNull()).select(*target.columns)


def inserted_rows(target: DataFrame, batch: DataFrame, key: str = "id") -> DataFrame:
    """Batch rows whose key the target does not have."""
    return batch.join(target.select(key), key, "left_anti")


def pending_embeddings(target: DataFrame, batch: DataFrame, key: str = "id",
                       vector: str = "image_embedding", image: str = "image_url") -> DataFrame:
    """Rows the batch inserts (not in target) that carry no vector: (id, image_url)."""
    fresh = inserted_rows(target, unique_batch(batch, key), key)
    return fresh.filter(F.col(vector).isNull()).select(key, image)


def align_columns(*batches: DataFrame, drop=("embedding",)) -> DataFrame:
    """Union by name over batches with different columns; missing -> null."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out.drop(*[c for c in drop if c in out.columns])


def reset_vector_column(df: DataFrame, column: str, dim: int, keep_matching: bool = False) -> DataFrame:
    """Dimension migration: the column becomes ``array<float>`` of the new width.

    Default (as the migrations do) nulls every value; ``keep_matching`` keeps
    vectors that already have ``dim`` elements.
    """
    if keep_matching:
        return df.withColumn(column, F.when(F.size(column) == dim, F.col(column).cast("array<float>")))
    return df.withColumn(column, F.lit(None).cast("array<float>"))
