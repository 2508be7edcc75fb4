"""Counting and top-N with a total order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslake import scratch
from newslake.operators.dedup import sized_lookup


# Texts whose blanks lie further apart than this on average are split into words
# at once: scripts without blanks, or data, would give chunks that never repeat.
_LONG_CHUNK = 64


def count_chunks(
    df: DataFrame,
    text: Column,
    by: list[Column],
    min_chars: int,
    words: Callable[[Column], Column],
) -> DataFrame:
    """Blank-separated chunks of lower-case text with their number ``n`` per ``by``.

    First step of word counting: texts repeat the same chunks, so the costly
    word pattern ``words`` then runs once per distinct chunk instead of once per
    occurrence. Chunks under ``min_chars`` hold no word of that length.
    """
    lower = F.col("_text")
    blanks = F.length(lower) - F.length(F.replace(lower, F.lit(" "), F.lit("")))
    sparse = F.length(lower) > (blanks + 1) * _LONG_CHUNK
    chunks = F.when(sparse, words(lower)).otherwise(F.split(lower, " "))
    rows = df.select(*by, F.lower(text).alias("_text"))
    keys = [c for c in rows.columns if c != "_text"]
    rows = rows.select(*keys, F.explode(chunks).alias("chunk")).where(F.length("chunk") >= min_chars)
    return rows.groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("n"))


def top_counts(counts: DataFrame, term: str, n: int, count: str = "count") -> DataFrame:
    """The ``n`` most frequent of counted terms; equal counts are cut by term."""
    return counts.orderBy(F.desc(count), term).limit(n)


def top_counts_first_seen(
    counts: DataFrame, term: str, places: Callable[[DataFrame], DataFrame], n: int, count: str = "count"
) -> DataFrame:
    """The ``n`` most frequent of counted terms; equal counts are cut by ``first_seen``.

    Terms are counted alone first. Only those that reach the count at rank ``n`` are looked up again:
    ``places`` gives (term, first_seen) of the terms it is handed.
    """
    counts = scratch.stored(counts, f"{scratch.run_dir(counts.sparkSession, 'first-seen')}/counts")
    least = counts.orderBy(F.desc(count)).limit(n).agg(F.min(count)).first()[0]
    chosen = counts.where(F.col(count) >= F.lit(least))
    seen = places(sized_lookup(chosen.select(term), chosen.count()))
    return chosen.join(seen, term).orderBy(F.desc(count), "first_seen").limit(n).drop("first_seen")


def top_per_group(df: DataFrame, group: str, value: str, tie: str, n: int) -> DataFrame:
    """Rows ranked 1..n inside each group, with their ``rank``.

    Spark limits each group inside every map task before it shuffles, so a
    large group sends at most ``n`` rows per task.
    """
    w = Window.partitionBy(group).orderBy(F.desc(value), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
