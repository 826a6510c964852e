"""Helpers of the training-data operators: shared folder, staged tables, running totals."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Unset, a temporary folder serves a ``local`` master (tests); on a cluster
    that would be a folder no executor shares, so it raises.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _roots:
        base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="shelfline-llm-")
        _roots[app] = f"{base.rstrip('/')}/llm-{app}"
        atexit.register(_drop, spark, app)
    return _roots[app]


def _drop(spark: SparkSession, app: str) -> None:
    """Remove the application's staged tables when the driver ends."""
    sc = spark.sparkContext
    if sc._jsc is None or sc.applicationId != app:
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(_roots[app])
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column], within: list[str] | None = None) -> DataFrame:
    """``df`` with exclusive running totals in ``order``, per value of ``within``.

    Rows are dealt by range of (within, order), so a group of any size spreads
    over many tasks; each range adds the totals of the ranges before it (one
    row per range and group).
    """
    within = within or []
    parts = shuffle_partitions(df.sparkSession)
    dealt = staged(df.repartitionByRange(parts, *[F.col(c).asc_nulls_last() for c in within], *order)
                   .withColumn("_part", F.spark_partition_id()), "ranges")
    # One range may end a group and begin the next; row order inside a range is a bounded window.
    inner = Window.partitionBy("_part", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.select("*", *[F.coalesce(F.sum(c).over(inner), F.lit(0)).alias(k) for k, c in sums.items()])
    totals = dealt.groupBy("_part", *within).agg(*[F.sum(c).alias(f"_t_{k}") for k, c in sums.items()])
    outer = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_part", *[F.col(c).alias(f"_g_{c}") for c in within],
                           *[F.coalesce(F.sum(f"_t_{k}").over(outer), F.lit(0)).alias(f"_o_{k}") for k in sums])
    joined = out.join(totals.withColumnRenamed("_part", "_p2"), _on(within))
    return joined.select(*df.columns, *[(F.col(k) + F.col(f"_o_{k}")).alias(k) for k in sums])


def _on(within: list[str]) -> Column:
    on = F.col("_part") == F.col("_p2")
    for c in within:
        on = on & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return on


def by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places) of 64-bit keys dealt by their remainder, shards in order."""
    shard = (keys % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    ends = np.flatnonzero(np.diff(shard[order], append=-1)) + 1
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        yield int(shard[order[a]]), order[a:b]
