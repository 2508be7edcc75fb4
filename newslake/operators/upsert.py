"""Insert-or-update by key, for whole tables and for partitioned folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake import scratch
from newslake.operators.dedup import latest_per_key


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job when a key column is null."""
    checked = {
        k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null key: {k}"))).otherwise(F.col(k))
        for k in keys
    }
    return df.withColumns(checked)


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
) -> DataFrame:
    """``incoming`` replaces rows of equal key; other current rows stay.

    ``order`` makes the last incoming row of a key win. Leave it out where
    incoming keys are unique already, which saves a shuffle.
    """
    new = require_keys(incoming, keys)
    if order:
        new = latest_per_key(new, keys, order)
    new = new.select(*current.columns)
    return current.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


# -- versioned partitions ----------------------------------------------------------
# A table is a set of partitions, each as some load wrote it:
#   data/version=N/<partitions>/   the partitions that load N wrote, whole
#   index/version=N/               for every partition, the load that wrote it last, as of load N
#   commits/                       the numbers of the loads that were finished
# Files are never changed or moved. A load without a commit is invisible, and the next one
# takes its number and overwrites what it left.


def current_version(spark: SparkSession, root: str) -> int | None:
    """Number of the last committed load; null before the first one."""
    try:
        log = spark.read.schema("version long").json(f"{root}/commits")
        return log.agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def commit_version(spark: SparkSession, root: str, version: int) -> None:
    """Make a load visible: one small file, which is there as a whole or not at all."""
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").json(f"{root}/commits")


def _index(spark: SparkSession, root: str, version: int | None, partitions: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"{p} string" for p in partitions) + ", written long"
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/index/version={version}")


def read_versioned(
    spark: SparkSession, root: str, schema: str, partitions: Sequence[str], only: DataFrame | None = None
) -> DataFrame:
    """The committed rows; ``only`` names the partitions wanted.

    The index is joined to the folders' own columns, so folders of other versions or partitions
    are passed over by dynamic partition pruning, before a file is opened.
    """
    empty = spark.createDataFrame([], schema)
    version = current_version(spark, root)
    index = _index(spark, root, version, partitions)
    if only is not None:
        index = index.join(only.select(*partitions), list(partitions), "left_semi")
    loads = [r.written for r in index.select("written").distinct().orderBy("written").collect()]
    if not loads:
        return empty
    stored = spark.read.schema(f"{schema}, version long").option("basePath", f"{root}/data")
    stored = stored.parquet(*[f"{root}/data/version={v}" for v in loads])
    # The range is that of the loads; Spark prunes by tables that a comparison has narrowed.
    index = index.where(F.col("written").between(loads[0], loads[-1]))
    index = index.select(*[F.col(p).alias(f"_{p}") for p in partitions], "written")
    same = [F.col(p) == F.col(f"_{p}") for p in partitions]
    found = stored.join(F.broadcast(index), [F.col("version") == F.col("written"), *same], "left_semi")
    return found.select(*empty.columns)


def upsert_partitions(root: str, incoming: DataFrame, partitions: Sequence[str], keys: Sequence[str]) -> int:
    """Replace rows of equal key inside the partitions that ``incoming`` touches; returns the new version.

    Those partitions alone are read, and written whole under the load's number; all others keep the
    version they have. Keys are unique in ``incoming``, which is read several times. The rebalance
    keeps files near the advisory size: a partition holding most rows is split over several
    tasks, small ones share a task. Null partition values or keys fail. Loads must not run
    concurrently.
    """
    spark = incoming.sparkSession
    current = current_version(spark, root)
    version = (current or 0) + 1
    touched = incoming.select(*partitions).distinct()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in incoming.schema.fields)
    before = read_versioned(spark, root, schema, partitions, touched)
    merged = upsert(before, incoming, [*partitions, *keys]).hint("rebalance", *partitions)
    merged.write.mode("overwrite").partitionBy(*partitions).parquet(f"{root}/data/version={version}")
    index = _index(spark, root, current, partitions).join(touched, list(partitions), "left_anti")
    index = index.unionByName(touched.withColumn("written", F.lit(version).cast("long")))
    index.hint("rebalance").write.mode("overwrite").parquet(f"{root}/index/version={version}")
    commit_version(spark, root, version)
    return version


def drop_old_versions(spark: SparkSession, root: str, partitions: Sequence[str]) -> int:
    """Delete loads of which no partition is current any more; returns how many.

    Not while an older version is being read.
    """
    current = current_version(spark, root)
    used = {r.written for r in _index(spark, root, current, partitions).select("written").distinct().collect()}
    old = set(range(1, (current or 0) + 1)) - used
    for version in sorted(old):
        scratch.drop_dir(spark, f"{root}/data/version={version}")
    for version in range(1, current or 0):
        scratch.drop_dir(spark, f"{root}/index/version={version}")
    return len(old)
