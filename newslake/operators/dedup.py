"""Keeping one row per key without ever gathering a key's rows in one task.

Keys that occur once need no work, and most do. Repeated keys are found by counting
64-bit hashes, then settled over narrow columns: key and order. The wide rows are read once
more at the end, against the few places that lose.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake import scratch

# A lookup of at most so many narrow rows is broadcast; a larger one is shuffled and hashed,
# so that the rows it is looked up for are never sorted.
BROADCAST_ROWS = 50_000


def _same(columns: Sequence[str], prefix: str) -> Column:
    """Equality with the prefixed columns of another table; null equals null."""
    return reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns))


def _prefixed(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def sized_lookup(lookup: DataFrame, size: int) -> DataFrame:
    """A lookup of ``size`` rows with the join that this number allows."""
    return F.broadcast(lookup) if size <= BROADCAST_ROWS else lookup.hint("shuffle_hash")


def join_repeated(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], copies: str, size: int, parts: int | None = None
) -> DataFrame:
    """Rows with a match in ``lookup``, which holds each key once with its number of ``copies``.

    ``size`` bounds the rows of the lookup: few are broadcast. Else the ``parts`` keys with most copies (by default the number of shuffle partitions P) are
    sent to the rows wherever they are. Any other key has less than one in P of all rows, the
    average share of a partition, so the rest can be shuffled by key.
    """
    def found(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(_prefixed(right, keys, "_of_"), _same(keys, "_of_")).drop(*[f"_of_{k}" for k in keys])

    if size <= BROADCAST_ROWS and not parts:
        return found(rows, F.broadcast(lookup))
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = lookup.orderBy(F.desc(copies), *keys).limit(parts)
    names = _prefixed(hot.select(*keys), keys, "_hot_")
    cold = lookup.join(F.broadcast(names), _same(keys, "_hot_"), "left_anti")
    apart = rows.join(F.broadcast(names), _same(keys, "_hot_"), "left_anti")
    return found(rows, F.broadcast(hot)).unionByName(found(apart, cold))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], work_dir: str | None = None) -> DataFrame:
    """The last row of each key by ``order`` (last write wins).

    Keys and order alone are grouped, first inside each task, so a key that holds a third of the
    input shuffles one row per task. Rows that are not the last of their key are then taken out of
    ``df`` by key and order; what stays is neither sorted nor, where few rows lose, shuffled.
    Rows of one key and order must be equal; they count once. Null keys are one key.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    if not rest:
        last = df.groupBy(*keys).agg(F.max(place).alias("_last"))
        ordered = [F.col("_last").alias(order[0])] if len(order) == 1 else [F.col(f"_last.{c}").alias(c) for c in order]
        return last.select(*keys, *ordered).select(*df.columns)
    work = work_dir or scratch.run_dir(df.sparkSession, "latest")
    names = [*keys, *(c for c in order if c not in keys)]
    narrow = scratch.stored(df.select(*names), f"{work}/narrow")
    best = narrow.groupBy(*keys).agg(F.max(place).alias("_best"), F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    best = scratch.stored(best, f"{work}/repeated")
    size = best.count()
    if not size:
        return df
    placed = join_repeated(narrow, best, keys, "_copies", size).withColumn("_last", place.eqNullSafe(F.col("_best")))
    placed = placed.groupBy(*names, "_last").agg(F.count(F.lit(1)).alias("_same"))
    placed = _prefixed(scratch.stored(placed, f"{work}/places"), names, "_at_")
    is_tied = F.col("_last") & (F.col("_same") > 1)
    n_lost, n_tied = placed.agg(F.count_if(~F.col("_last")), F.count_if(is_tied)).first()
    kept = df.join(sized_lookup(placed.where("NOT _last"), n_lost), _same(names, "_at_"), "left_anti") if n_lost else df
    if not n_tied:
        return kept
    tied = sized_lookup(placed.where(is_tied), n_tied)
    once = kept.join(tied, _same(names, "_at_"), "left_semi").distinct()
    return kept.join(tied, _same(names, "_at_"), "left_anti").unionByName(once)


def later_copies(
    rows: DataFrame, key: str, order: Sequence[str], valid: str, work_dir: str, parts: int | None = None
) -> DataFrame:
    """The ``order`` columns of rows that come after the first valid row of their key, stored.

    Rows without a key have no copies. Hashes of keys are counted first: only rows whose hash occurs
    again are looked at further, by the key itself. They are numbered in their order, so the
    first valid one of a key is the least of whole numbers, combined inside the tasks.
    """
    keyed = rows.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("_hash"), F.col(key).alias("_key"), *order, F.col(valid).alias("_valid"))
    repeated = keyed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    repeated = scratch.stored(repeated, f"{work_dir}/repeated_hashes")
    size = repeated.count()
    copies = join_repeated(keyed, repeated, ["_hash"], "_copies", size, parts)
    copies = copies.groupBy("_key", *order).agg(F.max("_valid").alias("_valid"))
    numbered = copies.orderBy(*order).withColumn("_number", F.monotonically_increasing_id())
    numbered = scratch.stored(numbered, f"{work_dir}/copies")
    firsts = numbered.groupBy("_key").agg(
        F.min(F.when(F.col("_valid"), F.col("_number"))).alias("_first"), F.count(F.lit(1)).alias("_copies")
    ).where("_first IS NOT NULL AND _copies > 1")
    if size > BROADCAST_ROWS:
        firsts = scratch.stored(firsts, f"{work_dir}/firsts")
    # Hashes rarely stand for two keys, so there are hardly more keys than hashes.
    later = join_repeated(numbered.select("_key", "_number", *order), firsts, ["_key"], "_copies", size, parts)
    later = later.where("_number > _first")
    return scratch.stored(later.select("_key", *order), f"{work_dir}/later")
