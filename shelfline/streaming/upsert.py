"""Structured Streaming: keep the products table current as batches arrive.

``readStream`` over a folder of arriving Parquet files -> ``foreachBatch``:
each micro-batch is reduced to one row per key and upserted into a
partitioned table (``upsert_products``: every column of the batch is taken,
nulls included, columns it lacks are kept). Only the partitions the
micro-batch touches are rewritten, so the work per batch follows the batch,
not the table.

The embedding queue is a stream of its own, with keyed state: a key's first
micro-batch puts it into the queue if its row has no vector, and marks it as
known. Its work per epoch follows the batch's keys; the table is only read
once, for the keys it had before the queue was first started. The queries'
checkpoints keep epoch ids and state stable across restarts; a replayed epoch
writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfline.operators.dedup import dedup_last
from shelfline.operators.maintain import upsert_products
from shelfline.session import path_exists, written
from shelfline.sources.table import PartitionedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def upsert_newest(current: DataFrame | None, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Upsert of one row per key; rows older than the table's are late and change nothing."""
    if current is None:
        return batch
    known = current.select(key, F.struct(*order).alias("_known"))
    fresh = (batch.join(known, key, "left").filter(F.col("_known").isNull() | (F.struct(*order) >= F.col("_known"))).drop("_known"))
    return upsert_products(current, fresh, key, drop=())


def _arrivals(spark: SparkSession, source_dir: str, schema: T.StructType, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(source_dir)


def _run(arrivals: DataFrame, checkpoint_dir: str, handle: Callable[[DataFrame, int], None]) -> None:
    """All that is available now, one micro-batch after the other, then stop."""
    q = arrivals.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()


def first_seen(arrivals: DataFrame, key: str, order: list[str], vector: str) -> DataFrame:
    """Rows of a stream whose key was not seen in an earlier micro-batch and that carry no vector.

    Of the rows of a key's first micro-batch the last one in ``order`` counts.
    ``_known`` marks rows that only tell a key. The state is one flag per key.
    """
    def of_key(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = [b for b in batches if len(b)]
        if state.exists:
            return
        state.update((True,))
        rows = pd.concat(rows)
        if not rows["_known"].any():
            # Ordered by a struct of the order columns, as the upsert takes its rows.
            last = rows.sort_values(order, kind="stable", na_position="first").tail(1)
            yield last[last["_missing"]].drop(columns=["_known", "_missing"])

    rows = arrivals.withColumn("_missing", F.col(vector).isNull()).drop(vector)
    out = T.StructType([f for f in rows.schema.fields if f.name not in ("_known", "_missing")])
    return rows.groupBy(key).applyInPandasWithState(of_key, out, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def stream_pending(spark: SparkSession, source_dir: str, schema: T.StructType, pending_dir: str, checkpoint_dir: str, key: str, order, vector: str,
                   table: PartitionedTable | None = None, max_files_per_trigger: int | None = None) -> None:
    """Run the embedding queue over everything available now: ``pending_dir/epoch=<id>`` gets an epoch's rows.

    Keys that ``table`` has when the queue first starts count as seen: they
    join the stream as rows of its first epoch. The state is kept by RocksDB
    on the executors, so it need not fit into their memory.
    """
    order = [order] if isinstance(order, str) else list(order)
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    arrivals = _arrivals(own, source_dir, schema, max_files_per_trigger).withColumn("_known", F.lit(False))
    seeds = f"{checkpoint_dir.rstrip('/')}-known"
    if not path_exists(spark, checkpoint_dir):
        stored = table.read() if table is not None else None
        known = spark.createDataFrame([], schema).select(key) if stored is None else stored.select(key)
        known.write.mode("overwrite").parquet(seeds)
    columns = [F.col(f.name) if f.name == key else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    known = own.readStream.schema(T.StructType([schema[key]])).parquet(seeds).select(*columns, F.lit(True).alias("_known"))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{pending_dir.rstrip('/')}/epoch={epoch_id}")

    _run(first_seen(arrivals.unionByName(known), key, order, vector), checkpoint_dir, handle)


def stream_upsert(spark: SparkSession, source_dir: str, schema: T.StructType, table_dir: str,
                  checkpoint_dir: str, key: str, order, pending_dir: str | None = None,
                  vector: str | None = None, max_files_per_trigger: int | None = None,
                  buckets: int = 64) -> PartitionedTable:
    """Run the stream over everything available now, then stop.

    With ``pending_dir`` and ``vector`` set, the embedding queue runs first
    (``stream_pending``), under a checkpoint beside this one.
    """
    table = PartitionedTable(spark, table_dir, key, buckets)
    order = list(order) if not isinstance(order, str) else [order]
    if pending_dir and vector:
        stream_pending(spark, source_dir, schema, pending_dir, f"{checkpoint_dir.rstrip('/')}-pending", key, order, vector, table, max_files_per_trigger)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        with written(dedup_last(batch, key, order), "epoch") as deduped:
            table.merge(deduped, lambda cur, b: upsert_newest(cur, b, key, order))

    _run(_arrivals(spark, source_dir, schema, max_files_per_trigger), checkpoint_dir, handle)
    return table


def read_pending(spark: SparkSession, pending_dir: str) -> DataFrame:
    return spark.read.parquet(pending_dir)


def stream_feed_run(spark: SparkSession, feed_dir: str, schema: T.StructType, table_dir: str,
                    checkpoint_dir: str, site: dict, mapping: dict, buckets: int = 64,
                    max_files_per_trigger: int | None = None) -> PartitionedTable:
    """Feed documents arriving as files -> product rows -> the products table.

    Each micro-batch runs the feed pipeline (items, field map, gates, site
    defaults, product rows, price gate, first row per id) and is upserted into
    a table partitioned by (source, bucket): a product sent again takes its
    new values.
    """
    from shelfline.plans.catalog import ORDER, feed_products

    table = PartitionedTable(spark, table_dir, "id", buckets, scope="source")

    def handle(batch: DataFrame, epoch_id: int) -> None:
        with written(feed_products(batch, site, mapping).drop(*ORDER), "epoch") as products:
            table.merge(products, lambda cur, b: b if cur is None else upsert_products(cur, b))

    _run(_arrivals(spark, feed_dir, schema, max_files_per_trigger), checkpoint_dir, handle)
    return table
