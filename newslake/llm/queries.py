"""Registered queries over the training-data operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake import scratch
from newslake.llm import (
    cube_mix, decontaminate, jaccard_join, language_masks, line_runs, page_template, periodic_runs, quality_nbsvm, quality_rules, secret_owners, token_files, toxicity, whitening,
)
from newslake.llm.words import held_out

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def token_shards(docs: DataFrame, root: str) -> DataFrame:
    """Token files of ``docs`` by the public 50k byte-level tokenizer, ids of 16 bits, end id 0."""
    return token_files.write_tokens(docs, root, public_tokenizers.path(TOKENIZER))


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document, and its offending sentences as byte spans."""
    docs = _read(spark, sf, "documents")
    model = toxicity.train(docs, _read(spark, sf, "labels"), scratch.run_dir(spark, "toxicity"))
    rows = toxicity.scored(docs.select("doc_id", "text"), model)
    score = F.col("toxicity.score")
    return rows.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), F.col("toxicity.spans").alias("spans"))


def op2_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    return page_template.main_texts(_read(spark, sf, "pages"), scratch.run_dir(spark, "pages")).drop("blocks")


def op3_token_output(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's place, length and checksum, read from wavelet token files."""
    return token_files.read_digests(token_shards(_read(spark, sf, "documents"), scratch.run_dir(spark, "tokens")))


def op4_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Component of every document under 5-word shingle Jaccard similarity of 0.75."""
    return jaccard_join.shingle_components(_read(spark, sf, "documents"), scratch.run_dir(spark, "jaccard"))


def quality_scored(docs: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """``docs`` with the probability of good quality; the model learns from the folder's own tables."""
    model = quality_nbsvm.train(_read(spark, sf, "documents"), _read(spark, sf, "labels"))
    return quality_nbsvm.scored(docs, model, "quality_score")


QUALITY_CUT = 0.3


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document by language bitmasks of its n-grams."""
    docs = _read(spark, sf, "documents")
    rows = language_masks.tagged(docs.select("doc_id", "text"), language_masks.train(docs))
    return rows.select("doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op6_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document by naive Bayes support vectors."""
    rows = quality_scored(_read(spark, sf, "documents").select("doc_id", "text"), spark, sf)
    score = F.col("quality_score")
    return rows.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= QUALITY_CUT).cast("int").alias("predicted"))


def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in every document; a source counts as an owner, a document as a repository."""
    found = secret_owners.find_secrets(_read(spark, sf, "documents"), scratch.run_dir(spark, "secrets"))
    live = F.coalesce(F.size(F.filter("found", lambda s: s["live"])), F.lit(0)).cast("long")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", live.alias("n_live"))


def op8_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of every document the mix takes."""
    mix = cube_mix.mix_sources(_read(spark, sf, "documents"), scratch.run_dir(spark, "mix"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op9_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items found in documents, with the best window of each."""
    return decontaminate.find_passages(_read(spark, sf, "documents"), _read(spark, sf, "benchmark"))


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of every document and whether the rules, weighed together, keep it."""
    judged = quality_rules.judge(_read(spark, sf, "documents"), scratch.run_dir(spark, "rules"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"]
    return judged.select(*columns)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text), with the tail of every tenth document by checksum of its id repeating a part of itself.

    Rows without an id or without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", f"{quality_rules.BLANK}+"), "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w"), F.expr("h DIV 10")
    rows = rows.withColumns({"n": n, "a": F.when(n > 0, g % n).cast("int"), "parts": (3 + g % 8).cast("int")})
    rows = rows.withColumn("p", 1 + F.expr("CAST((n - a) DIV parts AS INT)"))
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n")), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of every document, with repeats planted by the rule of the query."""
    found = periodic_runs.find_runs(with_planted_repeats(_read(spark, sf, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.expr("1000 * best.length DIV -best.q").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of every document less those that three documents share, which the largest id keeps."""
    rows = line_runs.dedup_lines(_read(spark, sf, "documents"), scratch.run_dir(spark, "lines"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Whitened components of every embedding, a row for each; none where no vector varies."""
    vectors = whitening.whole_vectors(_read(spark, sf, "embeddings"))
    distinct = whitening.fit_list(vectors, scratch.run_dir(spark, "whitening"))
    columns = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = whitening.fit(distinct)
    if model is None:
        return spark.createDataFrame([], columns)
    error = whitening.identity_error(distinct, model)
    rows = whitening.whitened(vectors, model).select("vec_id", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), F.posexplode("whitened").alias("i", "whitened"))
    explained = F.element_at(F.array(*(F.lit(float(e)) for e in model.explained)), F.col("i") + 1)
    return rows.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"),
    )


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """All stages of the corpus pipeline over the whole table."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_html_extraction": op2_html_extraction,
    "op3_token_output": op3_token_output,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_language_id": op5_language_id,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_secret_scan": op7_secret_scan,
    "op8_mix_sources": op8_mix_sources,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_line_dedup": op12_line_dedup,
    "op13_embedding_whitening": op13_embedding_whitening,
    "pipeline": pipeline,
}

_LINE_KEY = """translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

ORACLES: dict[str, str] = {
    "op12_line_dedup": f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), numbered AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
), keyed AS (
    SELECT doc_id, line, pos, {_LINE_KEY} AS line_key FROM numbered
), shared AS (
    SELECT line_key, max(doc_id) AS holder FROM keyed WHERE length(line_key) >= 20
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT k.doc_id, k.line, k.pos, s.line_key IS NOT NULL AND s.holder <> k.doc_id AS dropped
    FROM keyed k LEFT JOIN shared s USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
}
