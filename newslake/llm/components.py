"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake import scratch


def _toward_minimum(links: DataFrame, keep_larger: bool) -> DataFrame:
    """One contraction of links (u > v).

    ``keep_larger``: every node joins its larger neighbours to its smallest one;
    else every node joins its smaller neighbours and itself to the smallest. Minima
    are partial aggregates; a hub's neighbours are only joined, so a skewed join splits them.
    """
    if keep_larger:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(low, "u")
    if keep_larger:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
    return moved.filter("u > v").distinct()


def components(links: DataFrame, work: str) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its smallest node.

    Each round is stored below ``work``, so a lost executor costs one round. The
    rounds grow with the logarithm of the longest chain. Loops and repeats are allowed.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    mark, i = None, 0
    while True:
        if i:
            edges = _toward_minimum(_toward_minimum(edges, True), False)
        edges = scratch.stored(edges, f"{work}/round-{i}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark, i = now, i + 1
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
