"""Bronze and Silver zones of the lake."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newslake import schemas
from newslake.functions.dates import day_from_path
from newslake.functions.text import object_id, trim_space
from newslake.operators.dedup import latest_per_key
from newslake.operators.upsert import read_versioned, upsert_partitions

_TEXT_OBJECTS = "array<string>"
_OBJECT_PATH = r"/(source=[^/]+/dt=[^/]+/(?:articles/[0-9a-f]{40}|\d{6}_\w+)\.json)$"


# -- object keys ---------------------------------------------------------------
def bronze_batch_key(source: Column, ingested_at: Column, batch_id: Column) -> Column:
    clock = F.replace(F.substring(ingested_at, 12, 8), F.lit(":"), F.lit(""))
    day = F.substring(ingested_at, 1, 10)
    return F.format_string("bronze/source=%s/dt=%s/%s_%s.json", source, day, clock, batch_id)


def _article_key(zone: str, source: Column, dt: Column, url: Column) -> Column:
    return F.format_string(f"{zone}/source=%s/dt=%s/articles/%s.json", source, dt, object_id(url))


def bronze_article_key(source: Column, dt: Column, url: Column) -> Column:
    return _article_key("bronze", source, dt, url)


def silver_article_key(source: Column, dt: Column, url: Column) -> Column:
    return _article_key("silver", source, dt, url)


def speed_article_key(dt: Column, url: Column) -> Column:
    return F.format_string("speed/dt=%s/%s.json", dt, object_id(url))


# -- JSON members --------------------------------------------------------------
def _is_object(text: Column) -> Column:
    return F.coalesce(text.startswith("{"), F.lit(False))


def _is_list(text: Column) -> Column:
    return F.coalesce(text.startswith("["), F.lit(False))


def _objects(list_text: Column) -> Column:
    """Elements of a JSON list, as JSON text."""
    return F.from_json(list_text, _TEXT_OBJECTS)


def article_json() -> Column:
    """The article columns of a row as JSON text; null fields are left out."""
    return F.to_json(F.struct(*schemas.ARTICLE.fieldNames()))


def _with_members(head: Column, **members: Column) -> Column:
    """Append members that already are JSON text to the object ``head``, unparsed."""
    parts = [F.expr("''")]
    for name, text in members.items():
        parts += [F.lit(f',"{name}":'), text]
    return F.concat(F.regexp_replace(F.to_json(head), r"\}$", ""), *parts, F.lit("}"))


# -- scraper output ------------------------------------------------------------
def read_scraper_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per scraper file: ``path``, ``meta`` and ``articles`` as JSON text.

    A file that is not an object with a list ``articles`` fails the job.
    """
    whole = spark.read.text(path, wholetext=True)
    payload = F.from_json("value", "meta string, articles string")
    rows = whole.select(F.col("_metadata.file_path").alias("path"), payload.alias("p"))
    listed = F.when(_is_list(F.col("p.articles")), F.col("p.articles")).otherwise(
        F.raise_error(F.concat(F.lit("no list 'articles' in "), F.col("path")))
    )
    meta = F.when(_is_object(F.col("p.meta")), F.col("p.meta")).otherwise(F.lit("{}"))
    return rows.select("path", meta.alias("meta"), listed.alias("articles"))


def scraped_articles(files: DataFrame) -> DataFrame:
    """Articles of scraper files with their position and their own JSON text.

    Elements that are no objects are dropped.
    """
    items = files.select("path", F.posexplode(_objects(F.col("articles"))).alias("pos", "json"))
    parsed = items.where(_is_object(F.col("json"))).withColumn(
        "article", F.from_json("json", schemas.ARTICLE)
    )
    return parsed.select("path", "pos", "json", "article.*")


def scrape_reports(files: DataFrame) -> DataFrame:
    """The decoded ``meta`` of each scraper file: counts and the details of invalid pages."""
    return files.select("path", F.from_json("meta", schemas.SCRAPE_META).alias("m")).select("path", "m.*")


# -- Bronze --------------------------------------------------------------------
def _envelope_head(source: Column, ingested_at: Column, *more: Column) -> Column:
    return F.struct(
        ingested_at.alias("ingested_at"), source.alias("source"), F.lit("bronze").alias("layer"), *more
    )


def bronze_envelopes(
    articles: DataFrame, source: Column, ingested_at: Column, seq: Column, json: Column
) -> DataFrame:
    """Single-article envelopes; rows without a url are skipped, nothing is validated.

    ``json`` is the article's JSON text, ``seq`` its place in the batch and
    ``ingested_at`` an ISO-8601 text, whose day becomes ``dt``.
    """
    has_url = F.coalesce(trim_space(F.col("url")), F.lit("")) != ""
    head = _envelope_head(source, ingested_at, seq.cast("long").alias("seq"))
    return articles.where(has_url).select(
        _with_members(head, article=json).alias("value"),
        source.alias("source"),
        F.substring(ingested_at, 1, 10).alias("dt"),
    )


def bronze_batches(payloads: DataFrame, source: Column, ingested_at: Column) -> DataFrame:
    """One envelope per scraper payload, keeping ``meta`` and every list element."""
    value = _with_members(
        _envelope_head(source, ingested_at), meta=F.col("meta"), articles=F.col("articles")
    )
    return payloads.select(
        value.alias("value"), source.alias("source"), F.substring(ingested_at, 1, 10).alias("dt")
    )


def write_bronze(envelopes: DataFrame, root: str) -> None:
    """Append envelopes under ``source=/dt=``; the payload keeps its own ``source``.

    Append-only: the last write per (source, dt, url) is picked when reading.
    """
    (
        envelopes.select("value", "source", "dt")
        .hint("rebalance", "source", "dt")
        .write.mode("append")
        .partitionBy("source", "dt")
        .text(root)
    )


def _lines(spark: SparkSession, root: str, path: str) -> DataFrame:
    """Lines under a zone with their partition values and file; none where nothing is stored."""
    schema = "value string, source string, dt string"
    try:
        found = spark.read.schema(schema).option("basePath", root).text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, file string")
    return found.select("value", "source", "dt", F.col("_metadata.file_path").alias("file"))


def read_bronze(
    spark: SparkSession, root: str, prefix: str = "", limit_keys: int = 0, today: str | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """Articles of the Bronze zone: ``bronze_key, pos, dt`` and the raw article.

    Both layouts are read in one scan. An envelope with a list ``articles``
    gives its object elements; otherwise ``layer = 'bronze'`` with an object
    ``article`` gives that one; anything else gives nothing. Of single-article
    envelopes with equal key the last one written counts. ``prefix`` narrows the
    scan to part of the tree, ``limit_keys`` to the first so many objects by
    key, and ``today`` is the day of objects outside any ``dt=`` folder. ``counts`` observes the
    scan: the ``objects`` read and the ``malformed`` ones, which are neither layout.
    """
    lines = _lines(spark, root, f"{root}/{prefix}".rstrip("/"))
    e = lines.withColumn("e", F.from_json("value", schemas.ENVELOPE_TEXT)).select(
        "source", "dt", "file", "e.ingested_at", "e.seq", "e.layer", "e.article", "e.articles", F.sha1("value").alias("line_id")
    )
    is_batch = _is_list(F.col("articles"))
    is_single = ~is_batch & F.coalesce(F.col("layer") == "bronze", F.lit(False)) & _is_object(F.col("article"))
    if counts is not None:
        e = e.observe(counts, F.count(F.lit(1)).alias("objects"), F.count_if(~(is_batch | is_single)).alias("malformed"))

    # Objects written one per file are named by their path, others by content.
    path_key = F.nullif(F.regexp_extract("file", _OBJECT_PATH, 1), F.lit(""))
    url = trim_space(F.coalesce(F.get_json_object("article", "$.url"), F.lit("")))
    # Batches of one source and stamp differ in their payload, which the line's hash covers.
    batch_id = F.substring("line_id", 1, 12)
    content_key = F.when(
        is_batch, bronze_batch_key(F.col("source"), F.col("ingested_at"), batch_id)
    ).when(is_single, bronze_article_key(F.col("source"), F.col("dt"), url))
    named = e.withColumn(
        "bronze_key",
        F.coalesce(F.concat(F.lit("bronze/"), path_key), content_key, F.col("file")),
    )
    if limit_keys > 0:
        first = named.select("bronze_key").distinct().orderBy("bronze_key").limit(limit_keys)
        named = named.join(first, "bronze_key", "left_semi")

    # Of single-article envelopes the last write counts; a batch that was written twice counts once.
    batch_line = F.when(is_batch, F.col("line_id")).alias("batch_line")
    found = named.where(is_single | is_batch).select(
        "bronze_key", batch_line, "dt", "ingested_at", "seq", "file", "line_id",
        F.when(is_single, F.col("article")).alias("article"), F.when(is_batch, F.col("articles")).alias("articles"),
    )
    found = latest_per_key(found, ["bronze_key", "batch_line"], ["ingested_at", "seq", "file", "line_id"])
    texts = F.when(F.col("article").isNotNull(), F.array("article")).otherwise(_objects(F.col("articles")))
    found = found.select("bronze_key", "dt", F.posexplode(texts).alias("pos", "text")).where(_is_object(F.col("text")))
    found = found.select("bronze_key", "pos", "dt", F.from_json("text", schemas.ARTICLE).alias("a"))
    found = found.select("bronze_key", "pos", "dt", "a.*")
    day = F.coalesce(day_from_path(F.col("bronze_key")), F.col("dt"))
    if today:
        day = F.coalesce(day, F.lit(today))
    return found.withColumn("dt", day)


# -- Silver --------------------------------------------------------------------
SILVER = (
    "bronze_key string, titre string, url string, date_publication string, categorie string, "
    "auteur string, contenu string, langue string, normalized_at string, ingested_at string, "
    "source string, dt string"
)
_SILVER_PARTITIONS = ["source", "dt"]


def write_silver(accepted: DataFrame, root: str) -> None:
    """Per-url replace under the article's own source and its Bronze day, committed at the end.

    ``accepted`` is read several times: pass a stored table, not a costly plan.
    """
    upsert_partitions(root, accepted, _SILVER_PARTITIONS, ["url"])


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """The Silver articles of the last committed write; none before the first one."""
    return read_versioned(spark, root, SILVER, _SILVER_PARTITIONS)


def read_silver_envelopes(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Decode Silver objects stored as JSON envelopes: articles, and objects without one."""
    envelope = F.from_json("value", schemas.SILVER_ENVELOPE_TEXT).alias("e")
    lines = _lines(spark, root, root).select(envelope, "dt", "file")
    filled = _is_object(F.col("e.article")) & (F.regexp_replace("e.article", r"\s", "") != "{}")
    good = lines.where(filled).withColumn("a", F.from_json("e.article", schemas.SILVER_ARTICLE))
    articles = good.select("e.bronze_key", "a.*", "e.ingested_at", "dt")
    return articles, lines.where(~filled).select("file")


def silver_envelope_json(accepted: DataFrame) -> DataFrame:
    """Silver rows as JSON envelopes with lineage, for consumers of the JSON layout."""
    article = F.struct(*[f.name for f in schemas.SILVER_ARTICLE.fields])
    body = F.struct(F.lit("silver").alias("layer"), "bronze_key", "ingested_at", article.alias("article"))
    return accepted.select(F.to_json(body).alias("value"), "source", "dt")
