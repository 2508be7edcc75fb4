"""Gold datasets and the six keyed warehouse tables.

A load writes a new version of all tables, then commits it by adding its number
to a log. Readers follow the log, so they see all six tables of one load or none.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.operators.upsert import current_version, require_keys, upsert
from newslake.schemas import GOLD_DATASETS, gold_schema, warehouse_schema
from newslake.sources.tables import run_together


def write_gold(tables: dict[str, DataFrame], base: str, generated_at: str) -> None:
    """Each dataset under ``base/name``, stamped with ``generated_at``."""
    stamp = F.lit(generated_at).cast("timestamp")

    def write(name: str) -> None:
        rows = tables[name].withColumn("generated_at", stamp)
        rows.write.mode("overwrite").parquet(f"{base}/{name}")

    run_together(partial(write, name) for name in tables)


def read_gold(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(gold_schema(name)).parquet(f"{base}/{name}")


def _version_path(root: str, version: int, name: str) -> str:
    return f"{root}/versions/{version:08d}/{name}"


def _read_version(spark: SparkSession, root: str, version: int | None, name: str) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], warehouse_schema(name))
    return spark.read.schema(warehouse_schema(name)).parquet(_version_path(root, version, name))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The committed state of one table; empty before the first load."""
    return _read_version(spark, root, current_version(spark, root), name)


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of one committed load, whatever is loaded meanwhile."""
    version = current_version(spark, root)
    return {name: _read_version(spark, root, version, name) for name in GOLD_DATASETS}


def warehouse_rows(gold: DataFrame, name: str, loaded_at: str) -> DataFrame:
    """Gold rows as warehouse rows: null counts are 0, null keys fail, one stamp per load."""
    key, key_type, value = GOLD_DATASETS[name]
    rows = gold.select(
        F.col(key).cast(key_type).alias(key),
        F.coalesce(F.col(value).cast("long"), F.lit(0).cast("long")).alias(value),
        F.lit(loaded_at).cast("timestamp").alias("updated_at"),
    )
    return require_keys(rows, [key])


def _checked_rows(incoming: DataFrame, key: str) -> int:
    """Number of rows; fails when a key occurs twice."""
    rows, keys = incoming.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
    if rows != keys:
        raise ValueError(f"key {key} is not unique: {rows} rows, {keys} keys")
    return rows


def load_warehouse(
    spark: SparkSession, root: str, datasets: dict[str, DataFrame], loaded_at: str
) -> dict[str, int]:
    """Upsert all six datasets and commit them together; returns the rows loaded of each.

    Keys missing from a dataset stay as they are. Loads must not run concurrently.
    """
    missing = set(GOLD_DATASETS) - set(datasets)
    if missing:
        raise ValueError(f"missing datasets: {sorted(missing)}")
    current = current_version(spark, root)
    version = (current or 0) + 1

    def load(name: str) -> int:
        key = GOLD_DATASETS[name][0]
        rows = warehouse_rows(datasets[name], name, loaded_at)
        loaded = _checked_rows(rows, key)
        merged = upsert(_read_version(spark, root, current, name), rows, [key])
        merged.write.mode("overwrite").parquet(_version_path(root, version, name))
        return loaded

    loaded = dict(zip(GOLD_DATASETS, run_together(partial(load, name) for name in GOLD_DATASETS)))
    entry = spark.createDataFrame([(version, loaded_at)], "version long, loaded_at string")
    entry.coalesce(1).write.mode("append").json(f"{root}/commits")
    return loaded
