"""Rolling metrics over event time: counts per source and most frequent words.

Windows are aligned, ``[start, start + length)``, and advance by ``slide``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import (
    MIN_SPEED_CHARS,
    is_speed_candidate,
    speed_tokens,
    title_and_content,
)
from newslake.operators.topn import count_chunks, top_per_group

WINDOW = "5 minutes"
SLIDE = "1 minute"
WATERMARK = "10 minutes"
TOP_WORDS = 10

# A block of time is this many windows long; its words are dealt out to so many parts by hash.
_BLOCK_WINDOWS, _BLOCK_PARTS = 12, 8
_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def _seconds(duration: str) -> int:
    return sum(int(n) * _UNIT_SECONDS[unit] for n, unit in re.findall(r"(\d+)\s*([a-z]+?)s?\b", duration.lower()))


def _over_windows(per_slot: DataFrame, window: str, slide: str) -> DataFrame:
    """Sum counts of whole slides over the windows that hold them."""
    over = F.window("slot", window, slide).alias("w")
    counts = per_slot.groupBy(over, "key").agg(F.sum("n").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), "key", "n")


def rolling_counts(
    df: DataFrame, key: str, ts: str = "ts", window: str = WINDOW, slide: str = SLIDE,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Rows per window and key: ``window_start, key, n``.

    A batch is counted per slide first, so that each row is not repeated for
    every window it falls in; ``window`` must be a multiple of ``slide``. A
    stream counts windows directly, behind the watermark.
    """
    if df.isStreaming:
        counts = (
            df.withWatermark(ts, watermark)
            .groupBy(F.window(ts, window, slide).alias("w"), F.col(key).alias("key"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
    else:
        slot = F.window(ts, slide)["start"].alias("slot")
        per_slot = df.groupBy(slot, F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        return _over_windows(per_slot, window, slide)
    return counts.select(F.col("w.start").alias("window_start"), "key", "n")


def _candidate_words(rows: DataFrame, text: Column, *keep: str) -> DataFrame:
    words = rows.select(*keep, F.explode(speed_tokens(text)).alias("mot"))
    return words.where(is_speed_candidate(F.col("mot")))


def word_counts(articles: DataFrame) -> DataFrame:
    """``mot, count`` of all candidate words of title and content; no stopwords are removed."""
    text = title_and_content(F.col("titre"), F.col("contenu"))
    chunks = count_chunks(articles, text, [], MIN_SPEED_CHARS, speed_tokens)
    words = _candidate_words(chunks, F.col("chunk"), "n")
    return words.groupBy("mot").agg(F.sum("n").alias("count"))


def rolling_word_counts(
    articles: DataFrame, ts: str = "ts", window: str = WINDOW, slide: str = SLIDE,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Candidate words per window: ``window_start, key, n``; see ``rolling_counts``."""
    text = title_and_content(F.col("titre"), F.col("contenu"))
    if articles.isStreaming:
        return rolling_counts(_candidate_words(articles, text, ts), "mot", ts, window, slide, watermark)
    # All of a word in the windows that start in one block of time is counted in one place, in which rows are
    # repeated for their windows. A text goes there as one row of words; a slide that windows of two blocks
    # hold goes to both.
    length, step = _seconds(window), _seconds(slide)
    block = f"{_BLOCK_WINDOWS * length} seconds"
    held = F.window("slot", f"{(_BLOCK_WINDOWS + 1) * length} seconds", block)["start"].alias("block")
    rows = articles.select(F.window(ts, slide)["start"].alias("slot"), text.alias("text"))
    part_of = lambda word: F.pmod(F.xxhash64(word), F.lit(_BLOCK_PARTS)).cast("int")
    long_enough = F.filter(speed_tokens(F.col("text")), lambda w: F.length(w) >= MIN_SPEED_CHARS)
    rows = rows.select(held, "slot", "text").select("block", "slot", long_enough.alias("words"))
    rows = rows.select("*", F.transform("words", part_of).alias("parts"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(_BLOCK_PARTS - 1))).alias("part"))
    own = F.filter("words", lambda w, i: F.get("parts", i) == F.col("part"))
    placed = rows.select(F.xxhash64("block", "part").alias("place"), "slot", F.array_join(own, " ").alias("words"))
    # What a task receives grows manifold when split and repeated, so tasks are many and small, to sort in memory.
    parts = _BLOCK_PARTS * int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.where("words <> ''").repartition(parts, "place")
    by = [F.col("place"), F.col("slot")]
    words = count_chunks(placed, F.col("words"), by, MIN_SPEED_CHARS, lambda c: F.split(c, " "))
    words = words.select("place", "slot", F.col("chunk").alias("key"), "n").where(is_speed_candidate(F.col("key")))
    back = f"make_interval(0, 0, 0, 0, 0, 0, {length - step})"
    starts = F.expr(f"sequence(slot - {back}, slot, make_interval(0, 0, 0, 0, 0, 0, {step}))")
    each = words.select("place", "key", "n", F.explode(starts).alias("window_start"))
    here = F.xxhash64(F.window("window_start", block)["start"], part_of(F.col("key"))) == F.col("place")
    each = each.withColumn("here", here).where("here")
    counts = each.groupBy("place", "window_start", "key").agg(F.sum("n").alias("n"))
    return counts.select("window_start", "key", "n")


def rolling_top(counts: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    """The ``n`` largest keys of each window: ``window_start, key, n, rank``.

    Not for a streaming frame: rank the closed windows of a micro-batch instead.
    """
    return top_per_group(counts, "window_start", "n", "key", n)
