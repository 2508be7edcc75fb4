"""The event log: article events keyed by url, on Kafka or any other streaming source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newslake import schemas
from newslake.functions.text import trim_space

# -- fixed values: event type and stage name ------------------------------------
EVENT_TYPE = "article.scraped"
DECODE_STAGE = "deserialize_or_validate"
# -----------------------------------------------------------------------------


def kafka_options(servers: str, topic: str, starting: str = "latest", **more: str) -> dict[str, str]:
    """Reader options of a topic; the checkpoint of the query keeps the position."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        **more,
    }


def kafka_sink_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", **more}


def read_event_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Records of a topic with key and value as text (needs Spark's Kafka package)."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(
        F.col("key").cast("string"), F.col("value").cast("string"),
        "topic", "partition", "offset", "timestamp",
    )


def to_events(
    articles: DataFrame, source_file: str, event_time: Column, json: Column, keep: Sequence[str] = ()
) -> DataFrame:
    """``key`` (the trimmed url) and the JSON ``value`` of each article event.

    ``json`` is the article's JSON text, passed through unparsed. Rows without
    a url have an empty key and are not to be sent. ``keep`` names further
    columns to carry along.
    """
    head = F.struct(
        F.lit(EVENT_TYPE).alias("event_type"),
        event_time.alias("event_time"),
        F.lit(source_file).alias("source_file"),
    )
    value = F.concat(F.regexp_replace(F.to_json(head), r"\}$", ""), F.lit(',"article":'), json, F.lit("}"))
    key = F.coalesce(trim_space(F.col("url")), F.lit(""))
    return articles.select(key.alias("key"), value.alias("value"), *keep)


def publish(events: DataFrame, format: str, options: dict[str, str]) -> dict[str, int]:
    """Write keyed events to a sink; returns the numbers sent, failed and in total."""
    counts = Observation("publish")
    keyed = F.col("key") != ""
    counted = events.observe(
        counts, F.count(F.lit(1)).alias("total"), F.count_if(keyed).alias("sent")
    )
    counted.where(keyed).write.format(format).options(**options).mode("append").save()
    seen = counts.get
    return {"sent": seen["sent"], "failed": seen["total"] - seen["sent"], "total": seen["total"]}


def parse_events(records: DataFrame) -> DataFrame:
    """Add the decoded event and ``error``, null where the record is usable.

    A value must be one JSON object that holds an object ``article``. The value is read as
    the first of two elements of a list, the second being the value's own hash, which it cannot hold:
    whatever closes the list early or adds elements hides or moves it, so nothing may follow the object. White space may
    surround it, repeated members and non-finite numbers pass.
    """
    marker = F.md5(F.col("value").cast("binary"))
    listed = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit(',"'), marker, F.lit('"]')), "array<string>")
    with_list = records.withColumn("listed", listed)
    one = F.coalesce((F.size("listed") == 2) & (F.get("listed", F.lit(1)) == marker), F.lit(False))
    object_text = F.coalesce(F.ltrim("value", F.lit(" \t\r\n")).startswith("{"), F.lit(False))
    event = F.from_json(F.get("listed", F.lit(0)), schemas.EVENT_TEXT)
    with_event = with_list.withColumn("event", F.when(one & object_text, event))
    has_article = F.coalesce(F.col("event.article").startswith("{"), F.lit(False))
    error = (
        F.when(~one, "value is not JSON")
        .when(~object_text, "message value is not an object")
        .when(~has_article, "missing/invalid article")
    )
    return with_event.withColumn("error", error)


def event_articles(parsed: DataFrame) -> DataFrame:
    """Raw articles of usable events, with event time and broker fields.

    Event time comes from the envelope, else from the broker.
    """
    article = F.from_json("event.article", schemas.ARTICLE)
    broker = F.struct("topic", "partition", "offset", "timestamp", "key")
    written = F.try_to_timestamp("event.event_time")
    return parsed.where(F.col("error").isNull()).select(
        F.coalesce(written, F.col("timestamp")).alias("event_time"),
        broker.alias("kafka"),
        article.alias("a"),
    ).select("event_time", "kafka", "a.*")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select(
        F.lit(DECODE_STAGE).alias("stage"), "error", "topic", "partition", "offset", "value"
    )
