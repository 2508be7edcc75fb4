"""From raw documents to token files: each stage works on what the one before it kept.

Every function takes (spark, docs, sf_dir) and gives a DataFrame; ``run`` stores each
result as Parquet in the shared folder and reads it for the next stage, whereupon the one
before and all that the stage stored go. All stages but the last keep the columns of
``documents``. Decisions are joined on a key of the row, not on ``doc_id``, so rows that
share an id and rows without one each have their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake import scratch
from newslake.llm import cube_mix, decontaminate, jaccard_join, queries, token_files
from newslake.llm.row_keys import ROW, with_row_keys


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Each row is scored by its own text: null and empty texts get the score of no evidence,
    repeated rows the same score. A score at the cut stays. An empty table gives no rows.
    """
    rows = queries.quality_scored(docs, spark, sf_dir)
    return rows.filter(F.col("quality_score") >= queries.QUALITY_CUT).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Of rows that share the smallest id one stays, whichever is read first; rows without an id
    come after all others. Rows without words (null, empty) are copies of nothing and stay. An
    empty table gives no rows.
    """
    work = scratch.run_dir(spark, "stage-copies")
    rows = with_row_keys(docs, work)
    found = jaccard_join.shingle_components(rows.select(ROW, "text"), f"{work}/join", id_col=ROW)
    found = scratch.stored(found.select(F.col("doc_id").alias(ROW), F.col("component_id").alias("group")), f"{work}/groups")
    scratch.drop_dir(spark, f"{work}/join")
    scratch.release(spark)
    groups = found.filter(F.col(ROW) != F.col("group")).select("group").distinct()
    members = found.join(groups, "group", "left_semi").join(rows.select(ROW, "doc_id"), ROW)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    kept = members.groupBy("group").agg(F.min(order)[ROW].alias(ROW))
    dropped = members.select(ROW).join(kept, ROW, "left_anti")
    return rows.join(dropped, ROW, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go.

    Each row is judged by its own text, whatever its id; null and empty texts hold nothing. An empty
    table of documents gives no rows, an empty benchmark drops none.
    """
    rows = with_row_keys(docs, scratch.run_dir(spark, "stage-benchmark"))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_passages(rows, benchmark, id_col=ROW).select(F.col("doc_id").alias(ROW)).distinct()
    return rows.join(found, ROW, "left_anti").select(*docs.columns)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; documents taken zero times go.

    Every row has a draw of its own, also where rows share an id or have none, so the words of
    a source are those that the mix counted. Null is a source like others. Documents without words
    are drawn like others and add none. An empty table gives no rows.
    """
    work = scratch.run_dir(spark, "stage-mix")
    rows = with_row_keys(docs, work)
    mix = cube_mix.mix_sources(rows, work, id_col=ROW)
    draws = mix.filter("repeats > 0").select(F.col("doc_id").alias(ROW), F.col("repeats").alias("_repeats"))
    copies = rows.join(draws, ROW).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_repeats"))))
    return copies.select(*docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left; gives (doc_id, start, n_tokens, ids_crc32) as read from them.

    Every row is written, null and empty texts as the end id alone, repeated rows repeatedly; rows
    without an id come first. An empty table gives no files and no rows.
    """
    return token_files.read_digests(queries.token_shards(docs, scratch.run_dir(spark, "stage-tokens")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good_quality),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_sources", mix_to_targets),
    ("token_output", write_token_files),
]

# Trained scores, set similarity and balanced sampling are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = scratch.run_dir(spark, "pipeline")
    before = None
    for name, stage in STAGES:
        docs = scratch.stored(stage(spark, docs, sf_dir), f"{work}/{name}")
        if before:
            scratch.drop_dir(spark, f"{work}/{before}")
            scratch.release(spark)
        before = name
    return docs
