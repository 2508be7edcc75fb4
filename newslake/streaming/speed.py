"""The speed path: decode, normalise and store events; publish rolling metrics.

Each sink writes a folder per query and micro-batch and overwrites it as a whole when
the batch is retried, so a restart neither loses nor repeats rows, and a second
query or a new checkpoint on the same folder leaves stored rows alone.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newslake import scratch
from newslake.functions.text import object_id
from newslake.operators.dedup import latest_per_key
from newslake.operators.language import LanguageModel
from newslake.plans.silver import add_language, normalize
from newslake.sources.events import dead_letters, event_articles, parse_events
from newslake.streaming.rolling import WATERMARK, WINDOW, rolling_counts, rolling_top, rolling_word_counts

EVERY = {"processingTime": "60 seconds"}


def speed_records(
    parsed: DataFrame, default_source: str, model: LanguageModel | None = None
) -> DataFrame:
    """Normalised articles of usable events. Nothing is validated or deduplicated.

    An article without a url is stored under an id made from its place in the log.
    """
    articles = add_language(normalize(event_articles(parsed), default_source), model)
    place = F.concat_ws("/", "kafka.topic", "kafka.partition", "kafka.offset")
    name = F.when(F.col("url") == "", place).otherwise(F.col("url"))
    return articles.select(
        F.lit("speed").alias("layer"), "kafka", "event_time",
        F.col("normalized_at").alias("processed_at"),
        "titre", "url", "date_publication", "categorie", "auteur", "contenu", "source", "langue",
        "normalized_at", object_id(name).alias("object_id"),
    )


_ARTICLE_TEXT = ("titre", "url", "date_publication", "categorie", "auteur", "contenu", "source", "langue")
_RUN = "run string, batch_id long"
_BROKER = "topic: string, partition: int, offset: long, timestamp: timestamp, key: string"
SPEED = (
    f"layer string, kafka struct<{_BROKER}>, event_time timestamp, processed_at string, "
    + ", ".join(f"{c} string" for c in _ARTICLE_TEXT)
    + f", normalized_at string, object_id string, {_RUN}, dt date"
)
DEAD_LETTERS = f"stage string, error string, topic string, partition int, offset long, value string, {_RUN}"
SOURCE_COUNTS = f"window_start timestamp, key string, n long, started string, {_RUN}"
OPEN_TEXTS = "event_time timestamp, titre string, contenu string, batch_id long"
LATEST = "latest timestamp, batch_id long"
TOP_WORDS = f"window_start timestamp, key string, n long, rank int, started string, {_RUN}"


def _query_id(spark: SparkSession) -> str:
    run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise RuntimeError("a micro-batch without a query id")
    return run


def _write_batch(df: DataFrame, zone: str, batch_id: int, *partitions: str) -> None:
    """One folder per query and micro-batch, replaced as a whole."""
    run = _query_id(df.sparkSession)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partitions).parquet(f"{zone}/run={run}/batch_id={batch_id}")


def _read_zone(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What all queries stored; no rows where nothing was stored yet."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def texts_once(parsed: DataFrame) -> DataFrame:
    """Parsed records with each text once: the value of an unusable record, the event of any other."""
    failed = F.col("error").isNotNull()
    texts = [F.when(failed, F.col("value")).alias("value"), F.when(~failed, F.col("event")).alias("event")]
    return parsed.select("key", "topic", "partition", "offset", "timestamp", "error", *texts)


def start_speed_zone(
    records: DataFrame,
    out: str,
    checkpoint: str,
    default_source: str = "unknown",
    model: LanguageModel | None = None,
    trigger: dict | None = None,
    today: str | None = None,
) -> StreamingQuery:
    """Store every event under ``out/speed`` and unusable ones under ``out/dead_letters``.

    The day is the day of processing, or ``today`` where given.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        parsed = texts_once(parse_events(batch)).persist()
        try:
            day = today or datetime.now(timezone.utc).strftime("%Y-%m-%d")
            good = speed_records(parsed, default_source, model).withColumn("dt", F.lit(day))
            _write_batch(good, f"{out}/speed", batch_id, "dt")
            _write_batch(dead_letters(parsed), f"{out}/dead_letters", batch_id)
        finally:
            parsed.unpersist()

    return (
        records.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY))
        .start()
    )


def read_speed(spark: SparkSession, out: str) -> DataFrame:
    """The Speed zone: per day and object the last write in log order."""
    stored = _read_zone(spark, f"{out}/speed", SPEED).withColumns(
        {"_partition": F.col("kafka.partition"), "_offset": F.col("kafka.offset")}
    )
    last = latest_per_key(stored, ["dt", "object_id"], ["_partition", "_offset", "run", "batch_id"])
    return last.drop("run", "batch_id", "_partition", "_offset")


def read_dead_letters(spark: SparkSession, out: str) -> DataFrame:
    """Unusable records of all queries, each place in the log once."""
    return _read_zone(spark, f"{out}/dead_letters", DEAD_LETTERS).drop("run", "batch_id").distinct()


def start_source_counts(
    records: DataFrame, out: str, checkpoint: str, default_source: str = "unknown",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Rolling counts per source, refreshed with every batch under ``out/source_counts``."""
    articles = normalize(event_articles(parse_events(records)), default_source)
    counts = rolling_counts(articles, "source", ts="event_time")
    started = datetime.now(timezone.utc).isoformat(timespec="microseconds")

    def report(batch: DataFrame, batch_id: int) -> None:
        ordered = batch.orderBy("window_start", F.desc("n"), "key").withColumn("started", F.lit(started))
        _write_batch(ordered, f"{out}/source_counts", batch_id)

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(report)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY))
        .start()
    )


def read_source_counts(spark: SparkSession, out: str) -> DataFrame:
    """The freshest count of each window and source: of the query started last, its last batch."""
    stored = _read_zone(spark, f"{out}/source_counts", SOURCE_COUNTS)
    last = latest_per_key(stored, ["window_start", "key"], ["started", "batch_id"])
    return last.select("window_start", "key", "n")


def start_top_words(
    records: DataFrame, out: str, checkpoint: str, n: int = 10, trigger: dict | None = None
) -> StreamingQuery:
    """The ``n`` most frequent words of each closed window under ``out/top_words``.

    A window closes once the watermark passes its end. The texts of open windows wait under
    ``out/top_words_open``, a folder per micro-batch, so that the words of a window are counted once, when it closes,
    and no count of a word is kept as state. A window that the batch before closed is ranked anew, so texts
    that come one batch late still count; later ones do not.
    """
    articles = normalize(event_articles(parse_events(records)), "unknown").select("event_time", "titre", "contenu")
    started = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    length, behind = F.expr(f"INTERVAL {WINDOW}"), F.expr(f"INTERVAL {WATERMARK}")

    def rank(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = f"run={_query_id(spark)}"
        zone, latest = f"{out}/top_words_open", f"{out}/top_words_latest"
        _write_batch(batch, zone, batch_id)
        mine = _read_zone(spark, f"{zone}/{run}/batch_id={batch_id}", OPEN_TEXTS)
        _write_batch(mine.agg(F.max("event_time").alias("latest")).coalesce(1), latest, batch_id)
        seen = _read_zone(spark, f"{latest}/{run}", LATEST).where(F.col("batch_id") <= batch_id)
        mark = F.max("latest") - behind
        before = F.max(F.when(F.col("batch_id") < batch_id - 1, F.col("latest"))) - behind
        closes = seen.agg(mark.alias("_now"), before.alias("_before"))
        waiting = _read_zone(spark, f"{zone}/{run}", OPEN_TEXTS).where(F.col("batch_id") <= batch_id).join(F.broadcast(closes))
        # Whole minutes, so that what is counted of a window is all of it.
        due = (F.col("event_time") < F.col("_now")) & (F.col("_before").isNull() | (F.col("event_time") > F.col("_before") - length))
        counts = rolling_word_counts(waiting.where(due).select("event_time", "titre", "contenu"), ts="event_time")
        end = F.col("window_start") + length
        closed = (end <= F.col("_now")) & (F.col("_before").isNull() | (end > F.col("_before")))
        counts = counts.join(F.broadcast(closes)).where(closed).select("window_start", "key", "n")
        _write_batch(rolling_top(counts, n).withColumn("started", F.lit(started)), f"{out}/top_words", batch_id)
        # Batches whose windows were all closed by the batch before the last are read no more.
        old = seen.join(F.broadcast(closes)).where((F.col("latest") + length <= F.col("_before")) & (F.col("batch_id") < batch_id - 1))
        for row in old.select("batch_id").collect():
            scratch.drop_dir(spark, f"{zone}/{run}/batch_id={row.batch_id}")

    return (
        articles.writeStream.foreachBatch(rank)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY))
        .start()
    )


def read_top_words(spark: SparkSession, out: str) -> DataFrame:
    """One ranking of each closed window: that of the query started last that closed it."""
    stored = _read_zone(spark, f"{out}/top_words", TOP_WORDS)
    place = F.struct("started", "run", "batch_id")
    last = stored.groupBy("window_start").agg(F.max(place).alias("_last")).withColumnRenamed("window_start", "_window")
    ranked = stored.join(last, (F.col("window_start") == F.col("_window")) & (place == F.col("_last")))
    return ranked.select("window_start", "key", "n", "rank")
