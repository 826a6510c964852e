"""Session construction and the shared folder used to cut lineage.

On a cluster ``spark.checkpoint.dir`` names a folder every executor can
reach (HDFS, S3, ...). We read it from the session and only set our own
when it is unset, which happens in local tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "shelfline", master: str | None = None,
              shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and a UTC clock.

    ``driver_memory`` matters only in local mode (the driver is the executor)
    and only before the JVM starts.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:  # else the cluster's own setting stands
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a ``local`` master."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
    elif not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    else:
        local = tempfile.mkdtemp(prefix="shelfline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", local)
        spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any that a pattern names, exists."""
    files, place = _file_system(spark, pattern)
    return bool(files.globStatus(place))


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder, for results that need it several times; removed when they are done."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        files, place = _file_system(df.sparkSession, path)
        files.delete(place, True)
