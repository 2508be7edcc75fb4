import datetime as dt
import json

from pyspark.sql import functions as F

from articles import LONG, SAMPLE
from newslake import schemas
from newslake.functions.text import object_id
from newslake.sources import events as E
from newslake.sources.lake import article_json
from newslake.streaming import rolling, speed

NOW = {"availableNow": True}
START = dt.datetime(2026, 5, 11, 10, 0)


def event(url, source="goud", minute=0, **changes):
    at = (START + dt.timedelta(minutes=minute)).isoformat() + "Z"
    article = {"titre": "Titre mot", "url": url, "contenu": LONG, "source": source, **changes}
    return json.dumps({"event_type": "article.scraped", "event_time": at, "source_file": "f", "article": article})


def records(spark, path, *batches):
    """Each batch of values becomes one file; offsets count through."""
    offset = 0
    for i, values in enumerate(batches):
        rows = []
        for v in values:
            rows.append(("k", v, "articles", 0, offset, START))
            offset += 1
        df = spark.createDataFrame(rows, schemas.KAFKA_RECORD)
        df.coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(schemas.KAFKA_RECORD).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_speed_zone_keeps_last_write_and_dead_letters(spark, tmp_path):
    first = [event("https://a.b/1"), "not json", event("", titre="sans url 1"), "[1]"]
    second = [event("https://a.b/1", titre="<b>Encore</b>"), '{"article": 5}', '{"x": 1}', event(None), event("pas une url", contenu="court")]
    stream = records(spark, tmp_path / "in", first, second)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ckpt")
    for _ in range(2):  # the second start finds nothing new
        speed.start_speed_zone(stream, out, checkpoint, trigger=NOW, today="2026-05-12").awaitTermination()
        stored = speed.read_speed(spark, out)
        # Nothing is validated, and articles without url do not replace each other.
        assert sorted(stored.select("url", "titre").collect()) == [
            ("", "Titre mot"), ("", "sans url 1"), ("https://a.b/1", "Encore"), ("pas une url", "Titre mot"),
        ]
    named = stored.where("url = 'https://a.b/1'").select("object_id", object_id(F.col("url")), "kafka.offset", "layer", "dt")
    (one,) = named.collect()
    assert one[0] == one[1] and one[2:] == (4, "speed", dt.date(2026, 5, 12))
    letters = speed.read_dead_letters(spark, out).select("offset", "error", "stage").collect()
    assert sorted((r.offset, r.error) for r in letters) == [
        (1, "value is not JSON"), (3, "message value is not an object"),
        (5, "missing/invalid article"), (6, "missing/invalid article"),
    ]


def test_stream_counts_equal_batch_counts(spark, tmp_path):
    values = [event(f"https://a.b/{i}", source=("x", "y", "")[i % 3], minute=i) for i in range(30)]
    stream = records(spark, tmp_path / "in", values[:10], values[10:20], values[20:])
    out = str(tmp_path / "out")
    speed.start_source_counts(stream, out, str(tmp_path / "ckpt"), trigger=NOW).awaitTermination()
    got = sorted(map(tuple, speed.read_source_counts(spark, out).select("window_start", "key", "n").collect()))

    batch = E.event_articles(E.parse_events(spark.read.schema(schemas.KAFKA_RECORD).parquet(str(tmp_path / "in"))))
    from newslake.plans.silver import normalize

    want = rolling.rolling_counts(normalize(batch, "unknown"), "source", ts="event_time")
    assert got == sorted(map(tuple, want.collect()))
    brute = {}
    for i in range(30):
        for back in range(5):
            key = (START + dt.timedelta(minutes=i - back), ("x", "y", "unknown")[i % 3])
            brute[key] = brute.get(key, 0) + 1
    assert got == sorted((*k, n) for k, n in brute.items())


def test_late_events_reach_the_zone_but_not_the_metrics(spark, tmp_path):
    old, new, late = event("https://a.b/1"), event("https://a.b/2", minute=60), event("https://a.b/3", source="late")
    # Spark drops rows behind the watermark that the batch before last has set.
    stream = records(spark, tmp_path / "in", [old], [new], [event("https://a.b/4", minute=61)], [late])
    out = str(tmp_path / "out")
    speed.start_speed_zone(stream, out, str(tmp_path / "c1"), trigger=NOW).awaitTermination()
    speed.start_source_counts(stream, out, str(tmp_path / "c2"), trigger=NOW).awaitTermination()
    assert speed.read_speed(spark, out).count() == 4
    assert {r.key for r in speed.read_source_counts(spark, out).collect()} == {"goud"}


def test_top_words_of_closed_windows(spark, tmp_path):
    words = [event("https://a.b/1", titre="alpha alpha beta", contenu="beta gamma"), event("https://a.b/2", titre="beta", contenu="")]
    closing = [event("https://a.b/3", titre="zeta", contenu="", minute=40)]
    stream = records(spark, tmp_path / "in", words, closing)
    out = str(tmp_path / "out")
    speed.start_top_words(stream, out, str(tmp_path / "ckpt"), n=2, trigger=NOW).awaitTermination()
    rows = speed.read_top_words(spark, out).where(F.col("window_start") == F.lit(START)).orderBy("rank")
    assert [(r.key, r.n, r.rank) for r in rows.collect()] == [("beta", 3, 1), ("alpha", 2, 2)]
    assert speed.read_top_words(spark, out).where("key = 'zeta'").count() == 0


def test_publish_counts_and_payload(spark, tmp_path):
    rows = spark.createDataFrame([tuple(a.values()) for a in SAMPLE] + [(None,) * 7], schemas.ARTICLE)
    events = E.to_events(rows, "f.json", F.lit("2026-05-11T10:00:00Z"), article_json())
    stats = E.publish(events, "parquet", {"path": str(tmp_path / "topic")})
    assert stats == {"sent": 2, "failed": 1, "total": 3}
    sent = {r.key: json.loads(r.value) for r in spark.read.parquet(str(tmp_path / "topic")).collect()}
    assert sent[SAMPLE[0]["url"]] == {
        "event_type": "article.scraped", "event_time": "2026-05-11T10:00:00Z", "source_file": "f.json",
        "article": SAMPLE[0],
    }
    assert "vérifier" in spark.read.parquet(str(tmp_path / "topic")).orderBy("key").first().value


def test_kafka_options():
    options = E.kafka_options("h:9092", "articles", "earliest", maxOffsetsPerTrigger="10")
    assert options["subscribe"] == "articles" and options["startingOffsets"] == "earliest"
    assert E.kafka_sink_options("h:9092", "articles")["kafka.acks"] == "all"


def test_nothing_may_follow_the_object(spark, tmp_path):
    """Values that close the list early, or add to it, are no events."""
    good = event("https://a.b/1")
    bad = ['{"article":{}}] trailing', '{"article":{"url":"u"}}],["x"', f"{good},{good}", f'{good},"end of value"', f'{good}]', f'{good},"end of value"]', "[" + good, good + "}"]
    rows = [(i, v) for i, v in enumerate([good, f"  {good}\n", *bad])]
    parsed = E.parse_events(spark.createDataFrame(rows, "offset int, value string"))
    got = {r.offset: r.error for r in parsed.select("offset", "error").collect()}
    assert got[0] is None and got[1] is None and all(got[i] for i in range(2, len(rows)))


def test_one_ranking_per_window_after_a_second_query(spark, tmp_path):
    """A second query over more records ranks the same windows anew; its ranking counts."""
    out, path = str(tmp_path / "out"), str(tmp_path / "log")
    first = [event("https://a.b/1", contenu="alpha alpha beta"), event("https://a.b/9", minute=40)]
    stream = records(spark, path, first)
    speed.start_top_words(stream, out, str(tmp_path / "one"), n=2, trigger=NOW).awaitTermination()
    more = [event("https://a.b/2", contenu="beta beta beta", minute=1), event("https://a.b/8", minute=41)]
    stream = records(spark, str(tmp_path / "log2"), first + more)
    speed.start_top_words(stream, out, str(tmp_path / "two"), n=2, trigger=NOW).awaitTermination()
    ranks = speed.read_top_words(spark, out).groupBy("window_start", "rank").count()
    assert ranks.where("count > 1").isEmpty() and not ranks.isEmpty()
    top = speed.read_top_words(spark, out).where(F.col("window_start") == F.lit(START)).orderBy("rank").first()
    assert (top.key, top.n) == ("beta", 4)


def test_words_are_shuffled_before_they_are_repeated_for_windows(spark):
    """One shuffle by word and block of time; windows across blocks and slides without a word are whole."""
    rows = [(START + dt.timedelta(minutes=m), f"w{m % 3} mot", "Mot, l'été 12 ab" if m % 2 else None) for m in (0, 1, 7, 56, 59, 60, 61, 63, 119, 121)]
    df = spark.createDataFrame(rows, "ts timestamp, titre string, contenu string")
    counts = rolling.rolling_word_counts(df)
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    brute = {}
    for at, titre, contenu in rows:
        for word in titre.split() + (["mot", "l'été"] if contenu else []):
            for back in range(5) if len(word) >= 3 else ():
                key = (at - dt.timedelta(minutes=back), word)
                brute[key] = brute.get(key, 0) + 1
    assert sorted(map(tuple, counts.collect())) == sorted((*k, n) for k, n in brute.items())


def test_top_words_keep_no_state_of_words(spark, tmp_path):
    """Open texts wait in a folder per batch; one batch late still counts, and closed batches go."""
    first, closing = event("https://a.b/1", titre="alpha", contenu=""), event("https://a.b/2", titre="zeta", contenu="", minute=60)
    late = event("https://a.b/3", titre="alpha", contenu="", minute=1)
    later = event("https://a.b/4", titre="beta beta beta", contenu="", minute=1)
    stream = records(spark, tmp_path / "in", [first], [closing], [late], [later])
    out, checkpoint = str(tmp_path / "out"), tmp_path / "ckpt"
    speed.start_top_words(stream, out, str(checkpoint), n=2, trigger=NOW).awaitTermination()
    assert not (checkpoint / "state").exists()
    rows = speed.read_top_words(spark, out).where(F.col("window_start") == F.lit(START)).collect()
    assert [(r.key, r.n, r.rank) for r in rows] == [("alpha", 2, 1)]
    assert {p.name for p in (tmp_path / "out" / "top_words_open").glob("*/*")} == {"batch_id=1", "batch_id=2", "batch_id=3"}


def test_speed_zone_keeps_each_text_once(spark):
    values = [event("https://a.b/1"), "not json", None]
    rows = [("k", v, "articles", 0, i, START) for i, v in enumerate(values)]
    parsed = speed.texts_once(E.parse_events(spark.createDataFrame(rows, schemas.KAFKA_RECORD)))
    assert "listed" not in parsed.columns
    got = {r.offset: (r.value, r.event is not None) for r in parsed.collect()}
    assert got == {0: (None, True), 1: ("not json", False), 2: (None, False)}
