"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target is a share of all words, capped at ``MAX_REPEATS`` times its size.
Every document of a source is wanted target / size times: the whole part is taken for
certain, the fraction is an inclusion probability. The flight phase moves these
probabilities along directions that keep the balance equations (words and documents of
the source) until all but a few are 0 or 1. It runs in blocks of bounded size; what is
left of the blocks of one source goes into the next round of blocks, until one block is
left. There the few open documents are settled at the least distance from the totals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslake import scratch

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_ROWS = 20_000
_OPEN = 1e-9
_LEAVE = 12


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    blank = F.translate(text, "\t\n\u000b\u000c\r", "     ")
    words = F.length(F.regexp_replace(blank, "[^ ]+", "x")) - F.length(F.regexp_replace(blank, "[^ ]+", ""))
    return F.coalesce(words, F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, n_docs, target) from rows (source, size).

    Sources in code-point order, null last, take the weights in turn. The word total is
    shared by weight; a source stops at ``max_repeats`` times its size and the excess is
    shared again by weight. In ascending order of cap per weight, a source is capped if the
    share left at its turn exceeds its cap; one pass gives the fixed point of the resharing.
    Works on one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("cap", (max_repeats * F.col("source_size")).cast("double"))
    everything = Window.partitionBy()
    up = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(up), F.lit(0.0))
    per = per.withColumn("total", F.sum("source_size").over(everything).cast("double")).withColumn("weights", F.sum("w").over(everything))
    per = per.withColumn("capped", F.col("cap") * (F.col("weights") - before("w")) < F.col("w") * (F.col("total") - before("cap")))
    left = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("w"))).over(everything)
    share = F.when(F.col("capped"), F.col("cap")).otherwise(left * F.col("w") / open_weight)
    return per.select("source", "source_size", "n_docs", share.alias("target"))


def flight(p: np.ndarray, balance: np.ndarray) -> np.ndarray:
    """Move probabilities through the null space of the balance equations.

    ``balance`` has a row per unit and a column per equation (the unit's amount). Works on one
    more unit than there are equations at a time: along a direction that changes no total,
    up to the first wall of the cube; the unit that hits it is settled and the next
    one takes its place. At most as many units as equations stay open.
    """
    p = p.astype(float).copy()
    q = balance.shape[1]
    waiting = iter(np.flatnonzero((p > _OPEN) & (p < 1 - _OPEN)).tolist())
    active: list[int] = []
    while True:
        for i in waiting:
            active.append(i)
            if len(active) > q:
                break
        if len(active) <= q:
            break
        a = balance[active].T
        if q == 2:
            u = np.array([a[0, 1] * a[1, 2] - a[0, 2] * a[1, 1], a[0, 2] * a[1, 0] - a[0, 0] * a[1, 2], a[0, 0] * a[1, 1] - a[0, 1] * a[1, 0]])
            if not u.any():
                # All amounts are in proportion: one equation, any pair can trade.
                u = np.array([a[1, 1], -a[1, 0], 0.0]) if a[1, :2].any() else np.array([1.0, 0.0, 0.0])
        else:
            u = np.linalg.svd(a)[2][-1]
        now = p[active]
        with np.errstate(divide="ignore", invalid="ignore"):
            walls = np.where(u > 0, (1 - now) / u, np.where(u < 0, -now / u, np.inf))
            back = np.where(u > 0, now / u, np.where(u < 0, (now - 1) / u, np.inf))
        go, come = walls.min(), back.min()
        # The unbiased choice between both walls, by a fixed draw of the units at hand.
        draw = (active[0] * 0.6180339887498949 + active[-1] * 0.7548776662466927) % 1.0
        step = go if draw * (go + come) < come else -come
        now = np.clip(now + step * u, 0.0, 1.0)
        p[active] = now
        still = [i for i, v in zip(active, now) if _OPEN < v < 1 - _OPEN]
        if len(still) == len(active):  # rounding kept all open: settle the one nearest a wall
            k = int(np.argmin(np.minimum(now, 1 - now)))
            p[active[k]] = round(now[k])
            still = [i for j, i in enumerate(active) if j != k]
        active = still
    return np.where(p <= _OPEN, 0.0, np.where(p >= 1 - _OPEN, 1.0, p))


def landing(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Settle the open units by the subset nearest to the word total they stand for, then to their number."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if not len(open_):
        return p
    want, count = (p[open_] * sizes[open_]).sum(), p[open_].sum()
    subsets = np.arange(1 << len(open_))[:, None] >> np.arange(len(open_)) & 1
    off = np.abs(subsets @ sizes[open_] - want)
    best = np.lexsort((np.arange(len(subsets)), np.abs(subsets.sum(1) - count), off))[0]
    p = p.copy()
    p[open_] = subsets[best]
    return p


def _fly_block(rows: pd.DataFrame, last: bool) -> pd.DataFrame:
    """Flight over one block, largest documents first so that small ones stay open."""
    rows = rows.sort_values(["size", "key"], ascending=[False, True], kind="stable", ignore_index=True)
    size, p = rows["size"].to_numpy(float), rows["p"].to_numpy(float)
    # A few documents at doubling ranks of size are kept back in every block, so that the last
    # one has small and large ones to make up for those that the flight leaves open.
    ranks = (1 << np.arange(_LEAVE)) - 1
    moving = np.ones(len(p), bool)
    moving[ranks[ranks < len(p)]] = False
    p[moving] = flight(p[moving], np.column_stack([np.ones(moving.sum()), size[moving]]))
    rows["p"] = landing(p, size) if last else p
    return rows


def mix_sources(
    docs: DataFrame, work: str, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, block_rows: int = BLOCK_ROWS,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """(doc_id, size, source_size, target, repeats, taken) of every row.

    ``size`` counts words (null text: 0), ``repeats`` is how often the mix takes the
    document, ``taken`` is repeats times size. Null is a source of its own, last in order.
    Documents without words are taken as often as others and count no words; a source
    without words has target 0 and takes nothing. Repeated rows are sampled one by one: rows equal
    in id, source and size may be told apart by their order within a block only. Blocks
    are cut by a hash of id and size, so reruns agree. Narrow rows alone are shuffled; a
    source of any size is spread over as many blocks as its documents need.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col).cast("string")).alias("size"))
    sized = scratch.stored(rows, f"{work}/sizes")
    plan = scratch.stored(targets(sized, weights, max_repeats), f"{work}/targets")
    wanted = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_repeats)))).otherwise(0.0)
    key = F.xxhash64("doc_id", "size")
    rows = _with_plan(sized, plan)
    rows = rows.withColumn("wanted", wanted).withColumn("sure", F.floor("wanted").cast("int")).withColumn("p", F.col("wanted") - F.col("sure"))
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "n_docs", "sure", "p", key.alias("key"))
    done, left, level = [], rows.withColumn("n", F.col("n_docs")), 0
    while True:
        blocks = F.greatest(F.ceil(F.col("n") / block_rows), F.lit(1)).cast("long")
        placed = left.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("key", F.lit(level)), F.col("blocks")))
        schema = placed.schema
        flown = placed.groupBy("source", "block").applyInPandas(lambda g: _fly_block(g, bool(g["blocks"].iloc[0] == 1)), schema)
        flown = scratch.stored(flown, f"{work}/flight-{level}")
        done.append(flown.filter("p = 0 OR p = 1"))
        rest = flown.filter("p > 0 AND p < 1").drop("n", "blocks", "block")
        counts = rest.groupBy("source").agg(F.count("*").alias("n"))
        if rest.isEmpty():
            break
        left = _with_plan(rest, counts)
        level += 1
    settled = done[0]
    for more in done[1:]:
        settled = settled.unionByName(more)
    repeats = (F.col("sure") + F.col("p")).cast("int")
    return settled.select("doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"), (repeats * F.col("size")).cast("long").alias("taken"))


def _with_plan(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Add a source's columns to its rows; null matches null. One row per source, so a hot source can be split."""
    other = per_source.withColumnRenamed("source", "_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
