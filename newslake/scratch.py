"""Where intermediate tables go: a folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; without it, one below the SQL warehouse.

    Both are shared by configuration. Nothing goes to a machine's temporary folder.
    """
    configured = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF, None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_runs"
    return configured.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one run of ``name``."""
    return f"{shared_dir(spark)}/newslake/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage for good.

    Nothing reads the shuffle files of the write again, so they go with its end.
    """
    spark = df.sparkSession
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Executors delete the shuffle files of a query of the block once it has ended."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def release(spark: SparkSession) -> None:
    """Let the executors delete the shuffle files of finished jobs whose plans nothing refers to.

    Spark does so when the driver's plans are collected, which may take long on an idle heap.
    """
    spark._jvm.System.gc()


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a run's folder once its result has been read or stored elsewhere."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
