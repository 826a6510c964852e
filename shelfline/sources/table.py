"""A keyed table as plain partitioned Parquet, changed by Spark's own partition overwrite.

The table is a folder of ``[scope=.../]bucket=...`` partitions that any reader
of Parquet can use. A change computes the new rows of the partitions it
touches and writes them with ``partitionOverwriteMode=dynamic``: Spark
replaces exactly those partitions when the job commits. Changes are
idempotent, so a change that failed or is replayed is simply run again. One
writer at a time; a reader that must not see a change half way reads before
or after it. ``_schema`` beside the partitions is an empty Parquet table with
all columns so far, so that no reader has to merge the schemas of all files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.session import path_exists


class PartitionedTable:
    """A table partitioned by ``[scope,] bucket`` with ``bucket = pmod(xxhash64(key), buckets)``.

    ``scope`` (e.g. ``source``, text) must be determined by the key, which
    holds for ids hashed from the source. Columns that a change adds are null
    in older rows.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64, scope: str | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.buckets, self.scope = key, buckets, scope
        self.parts = ([scope] if scope else []) + ["bucket"]

    def _schema(self) -> T.StructType | None:
        path = f"{self.path}/_schema"
        return self.spark.read.parquet(path).schema if path_exists(self.spark, f"{path}/_SUCCESS") else None

    def exists(self) -> bool:
        return self._schema() is not None

    def _stored(self) -> DataFrame | None:
        """All rows with their bucket; null where the table was never written."""
        schema = self._schema()
        # The schema tells the kinds of the partition columns, whatever the folders' names look like.
        return None if schema is None else self.spark.read.schema(schema).parquet(self.path).filter(F.col(self.key).isNotNull())

    def read(self) -> DataFrame | None:
        rows = self._stored()
        return None if rows is None else rows.drop("bucket")

    def _with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _place(self) -> Column:
        """The partition as text; over partition columns only, so a filter on it prunes folders."""
        return F.concat_ws("/", *[F.coalesce(F.col(p).cast("string"), F.lit("\0")) for p in self.parts])

    def _places(self, rows: DataFrame) -> list[str]:
        """Partitions that rows stand in: at most scopes x buckets, whatever the rows."""
        return [r[0] for r in rows.select(self._place().alias("p")).distinct().collect()]

    def _replace(self, places: list[str], rows: DataFrame) -> None:
        """Make ``rows`` the content of these partitions.

        Spark leaves a partition that gets no row as it was, so each also gets
        a row without a key, which reading leaves out.
        """
        rows = self._with_bucket(rows)
        empty = self.spark.createDataFrame([(p,) for p in places], "_p string")
        at = F.split("_p", "/(?=[^/]*$)")
        scope = {self.scope: F.when(at[0] != "\0", at[0])} if self.scope else {}
        bucket = at[1] if self.scope else F.col("_p")
        empty = empty.select(*[({**scope, "bucket": bucket.cast("int")}[f.name] if f.name in self.parts else F.lit(None)).cast(f.dataType).alias(f.name)
                               for f in rows.schema.fields])
        known = self._schema()
        names = set(known.names) if known else set()
        if new := [f for f in rows.schema.fields if f.name not in names]:
            self.spark.createDataFrame([], T.StructType([*(known.fields if known else []), *new])).write.mode("overwrite").parquet(f"{self.path}/_schema")
        # Rebalanced: a large partition is written by several tasks, small ones share one.
        (rows.unionByName(empty).hint("rebalance", *self.parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.parts).parquet(self.path))

    def merge(self, batch: DataFrame, merge_fn) -> None:
        """Replace the partitions that the batch's keys fall in by ``merge_fn(current_rows_or_None, batch)``."""
        places = self._places(self._with_bucket(batch))
        if not places:
            return
        stored = self._stored()
        current = None if stored is None else stored.filter(self._place().isin(places)).drop("bucket")
        self._replace(places, merge_fn(current, batch))

    def delete_missing(self, value: str, keep_ids: DataFrame) -> int:
        """Delete rows of one scope value whose key is not in ``keep_ids``.

        Only partitions that lose rows are rewritten: an id-only scan of the
        scope, anti-joined with the kept ids, names them. An empty ``keep_ids``
        deletes nothing. Returns the number of partitions rewritten.
        """
        stored = self._stored()
        if stored is None or keep_ids.isEmpty():
            return 0
        ids = keep_ids.select(self.key)
        doomed = self._places(stored.filter(F.col(self.scope) == value).join(ids, self.key, "left_anti"))
        if doomed:
            left = stored.filter((F.col(self.scope) == value) & self._place().isin(doomed)).join(ids, self.key, "left_semi")
            self._replace(doomed, left.drop("bucket"))
        return len(doomed)
