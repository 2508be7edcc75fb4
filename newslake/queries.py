"""The registered queries: each takes (spark, folder of the test tables) and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake import schemas, scratch
from newslake.operators.dedup import latest_per_key
from newslake.operators.language import detect_language, load_profiles, train_lang_profiles
from newslake.operators.upsert import upsert
from newslake.functions.text import STOPWORDS, clean_text, object_id
from newslake.functions.dates import publication_day
from newslake.plans import gold as G
from newslake.plans import medallion as M
from newslake.plans import pages as P
from newslake.plans.serve import serve
from newslake.plans.silver import accepted, judge, rejected, rejects_by_reason, silver_counters
from newslake.sources import events as E
from newslake.sources import lake as L
from newslake.sources.warehouse import read_tables
from newslake.streaming import rolling, speed
from newslake.views import ARTICLES, DATED, LISTINGS, PAGES_META, PAGES_REFERENCES, RAW

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = "2024-02-01"
STAMP = "2024-02-01T00:00:00+00:00"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _view(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """One of the shared views over ``documents`` or ``pages``."""
    table = "pages" if "{pages}" in sql else "documents"
    return spark.sql(sql, **{table: _table(spark, sf, table)})


def articles(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, ARTICLES)


def raw_articles(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, RAW)


# -- Gold ----------------------------------------------------------------------
def top_keywords(spark, sf):
    return G.top_keywords(articles(spark, sf))


def top_keywords_first_seen(spark, sf):
    return G.top_keywords(articles(spark, sf), tie="first_seen")


def top_keywords_stopword_table(spark, sf):
    """The built-in words as a table, through the join."""
    groups = {**STOPWORDS, "any": sorted({w for ws in STOPWORDS.values() for w in ws})}
    rows = [(g, w) for g, words in groups.items() for w in words]
    stopwords = spark.createDataFrame(rows, "lang_group string, token string")
    return G.top_keywords(articles(spark, sf), stopwords=stopwords)


def top_topics(spark, sf):
    return G.top_topics(articles(spark, sf))


def top_topics_first_seen(spark, sf):
    return G.top_topics(articles(spark, sf), tie="first_seen")


def articles_per_day(spark, sf):
    return G.articles_per_day(articles(spark, sf), RUN_DATE)


def publication_days(spark, sf):
    day = F.coalesce(publication_day(F.col("date_publication")), F.to_date("dt"))
    return _view(spark, sf, DATED).select("doc_id", day.alias("date"))


def articles_per_source(spark, sf):
    return G.articles_per_source(articles(spark, sf))


def articles_per_theme(spark, sf):
    return G.articles_per_theme(articles(spark, sf))


def articles_per_country(spark, sf):
    return G.articles_per_country(articles(spark, sf), G.source_country(spark))


# -- Silver --------------------------------------------------------------------
def _judged(spark, sf):
    return judge(raw_articles(spark, sf), "inconnu", stamp=STAMP)


def silver_accepted(spark, sf):
    return accepted(_judged(spark, sf)).select(
        "bronze_key", "url", "titre", "categorie", "auteur", "contenu", "source",
        object_id(F.col("url")).alias("url_sha1"),
    )


def silver_rejects(spark, sf):
    errors = F.array_join("errors", ";").alias("errors")
    return rejected(_judged(spark, sf)).select("bronze_key", "pos", "url", errors)


def silver_judged_hot(spark, sf):
    """All verdicts with every repeated url treated as a hot key."""
    judged = judge(raw_articles(spark, sf), "inconnu", stamp=STAMP, parts=1_000_000)
    return judged.select("bronze_key", "pos", "url", F.array_join("errors", ";").alias("errors"))


def reject_reasons(spark, sf):
    return rejects_by_reason(rejected(_judged(spark, sf)))


def run_counters(spark, sf):
    return silver_counters(_judged(spark, sf))


# -- the lake --------------------------------------------------------------------
def bronze_latest(spark, sf):
    keyed = articles(spark, sf).select("source", "dt", object_id(F.col("url")).alias("url_sha1"), "doc_id")
    return latest_per_key(keyed, ["source", "dt", "url_sha1"], ["doc_id"])


def _stamp() -> Column:
    return F.concat("dt", F.lit("T10:00:00+00:00"))


def _write_both_layouts(spark, sf, root: str) -> None:
    """English articles one by one, all others in batches of a bounded size."""
    rows = articles(spark, sf).withColumn("json", L.article_json())
    english = rows.where(F.col("langue") == "en")
    L.write_bronze(
        L.bronze_envelopes(english, F.col("source"), _stamp(), F.col("doc_id"), F.col("json")), root
    )
    chunk = F.floor(F.col("doc_id") / 500)
    listed = F.array_join(F.sort_array(F.collect_list("json")), ",")
    payloads = (
        rows.where(F.col("langue") != "en")
        .groupBy("source", "dt", chunk.alias("chunk"))
        .agg(F.concat(F.lit("["), listed, F.lit("]")).alias("articles"))
        .withColumn("meta", F.to_json(F.struct("source", "chunk")))
    )
    L.write_bronze(L.bronze_batches(payloads, F.col("source"), _stamp()), root)


def scraper_files(spark, sf):
    """Articles written as scraper files of a bounded size, read back: files and articles per source."""
    root = f"{scratch.run_dir(spark, 'scraped')}/files"
    rows = articles(spark, sf).withColumn("json", L.article_json())
    listed = F.array_join(F.sort_array(F.collect_list("json")), ",")
    files = rows.groupBy("source", "dt", F.floor(F.col("doc_id") / 500).alias("chunk")).agg(
        F.concat(F.lit('{"meta":{"found_urls":'), F.count(F.lit(1)), F.lit('},"articles":['), listed, F.lit(',"no object"]}')).alias("value")
    )
    # A payload is a file of its own; folders per source and day alone are quick to make and to list.
    files = files.select("source", "dt", "value")
    committed_by_tasks = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
    files.write.options(maxRecordsPerFile=1, **committed_by_tasks).partitionBy("source", "dt").text(root)
    found = L.scraped_articles(L.read_scraper_files(spark, root))
    return found.groupBy("source").agg(F.count_distinct("path").alias("files"), F.count(F.lit(1)).alias("n"), F.sum(F.length("contenu")).alias("n_chars"))


def silver_envelopes(spark, sf):
    """Silver objects in their JSON layout, some without an article: articles per source, and the rejected."""
    root = f"{scratch.run_dir(spark, 'envelopes')}/silver"
    rows = articles(spark, sf).withColumns({"normalized_at": F.lit(STAMP), "ingested_at": F.lit(STAMP)})
    empty = F.when(F.col("doc_id") % 50 == 3, '{"layer":"silver","article":{ }}').when(F.col("doc_id") % 50 == 4, '{"layer":"silver"}')
    broken = rows.withColumn("value", empty).where("value IS NOT NULL").select("value", "source", "dt")
    whole = L.silver_envelope_json(rows.where(empty.isNull()))
    whole.unionByName(broken).hint("rebalance", "source", "dt").write.partitionBy("source", "dt").text(root)
    found, rejects = L.read_silver_envelopes(spark, root)
    n_chars = F.sum(F.length("contenu")).alias("n_chars")
    per_source = found.groupBy("source").agg(F.count(F.lit(1)).alias("n"), n_chars)
    return per_source.union(rejects.agg(F.lit("rejected"), F.count(F.lit(1)), F.lit(0).cast("long")))


def bronze_round_trip(spark, sf):
    root = f"{scratch.run_dir(spark, 'bronze')}/bronze"
    _write_both_layouts(spark, sf, root)
    found = L.read_bronze(spark, root)
    return found.groupBy("source", "dt").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("contenu")).alias("n_chars")
    )


def link_limit(spark, sf):
    """The first three links of every listing page."""
    return P.extract_links(_view(spark, sf, LISTINGS), n=3).select("page_id", "site", "pos", "link")


def limit_objects(spark, sf):
    root = f"{scratch.run_dir(spark, 'bronze')}/bronze"
    rows = articles(spark, sf).withColumn("json", L.article_json())
    L.write_bronze(
        L.bronze_envelopes(rows, F.col("source"), _stamp(), F.col("doc_id"), F.col("json")), root
    )
    return L.read_bronze(spark, root, limit_keys=25).select("bronze_key", "titre")


def silver_rewrite(spark, sf):
    """A first Silver write of all languages, then a second one of the French articles."""
    root = f"{scratch.run_dir(spark, 'silver')}/silver"
    rows = articles(spark, sf).withColumn("auteur", F.lit(None).cast("string"))
    last = scratch.stored(latest_per_key(rows, ["source", "dt", "url"], ["doc_id"]), f"{root}-rows")
    for run, part in (("first", last), ("second", last.where(F.col("langue") == "fr"))):
        stamps = {"normalized_at": F.lit(run), "ingested_at": F.lit(run)}
        L.write_silver(part.withColumns(stamps).drop("doc_id", "pos"), root)
    stored = L.read_silver(spark, root)
    return stored.groupBy("source", "dt", F.col("ingested_at").alias("run")).agg(
        F.count(F.lit(1)).alias("n")
    )


# -- pages -----------------------------------------------------------------------
def _pages(spark, sf):
    return _table(spark, sf, "pages").withColumn("site", F.lit("any"))


def page_titles(spark, sf):
    return P.extract_articles(_view(spark, sf, PAGES_REFERENCES)).select("page_id", "titre")


def page_bodies(spark, sf):
    return P.extract_articles(_pages(spark, sf)).select("page_id", "contenu")


def page_meta(spark, sf):
    pages = _view(spark, sf, PAGES_META)
    return P.extract_articles(pages).select("page_id", "date_publication", "categorie", "auteur")


def page_report(spark, sf):
    pages = _view(spark, sf, PAGES_META)
    return P.page_report(P.with_page_errors(P.extract_articles(pages)))


def page_invalid_details(spark, sf):
    pages = _view(spark, sf, PAGES_META)
    details = P.invalid_details(P.with_page_errors(P.extract_articles(pages)))
    return details.select("source", "url", F.array_join("errors", ";").alias("errors"))


def page_links(spark, sf):
    return P.extract_links(_pages(spark, sf), (P.ANY_LINK,)).select("page_id", "pos", "link")


def site_links(spark, sf):
    """Links of all shapes on pages of every site, under the site's own rules."""
    listings = _view(spark, sf, LISTINGS)
    return P.extract_links(listings).select("page_id", "site", "pos", "link")


# -- language --------------------------------------------------------------------
def language_accuracy(spark, sf):
    documents = _table(spark, sf, "documents")
    model = load_profiles(train_lang_profiles(documents))
    tagged = detect_language(documents, model, clean_text(F.col("text")))
    return tagged.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("langue") == F.col("lang")).alias("correct")
    )


def _even_profiles(spark, sf):
    return train_lang_profiles(_table(spark, sf, "documents").where(F.col("doc_id") % 2 == 0))


def language_profiles(spark, sf):
    """Trigram counts of the documents with even ids."""
    return _even_profiles(spark, sf).select("lang", F.col("bucket").cast("long").alias("bucket"), "n")


def language_tags(spark, sf):
    """Language of the documents with odd ids, learnt from the others."""
    odd = _table(spark, sf, "documents").where(F.col("doc_id") % 2 == 1)
    model = load_profiles(_even_profiles(spark, sf))
    return detect_language(odd, model, clean_text(F.col("text"))).select("doc_id", "langue")


# -- stream ----------------------------------------------------------------------
def speed_words(spark, sf):
    return rolling.word_counts(articles(spark, sf))


def rolling_source_counts(spark, sf):
    return rolling.rolling_counts(_table(spark, sf, "events"), "event_type")


def _timed(spark, sf):
    """Articles twenty seconds apart."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    at = start + F.make_dt_interval(secs=(F.col("doc_id") * 20).cast("decimal(18,6)"))
    return articles(spark, sf).withColumn("ts", at)


def rolling_top_words(spark, sf):
    return rolling.rolling_top(rolling.rolling_word_counts(_timed(spark, sf)))


def event_envelopes(spark, sf):
    rows = articles(spark, sf)
    events = E.to_events(rows, "articles.json", F.lit(STAMP), L.article_json())
    sent = events.where(F.col("key") != "")
    return sent.select(
        "key",
        F.get_json_object("value", "$.event_type").alias("event_type"),
        F.get_json_object("value", "$.source_file").alias("source_file"),
        F.get_json_object("value", "$.article.titre").alias("titre"),
    )


def _record_stream(spark, sf, run: str) -> DataFrame:
    """The articles as broker records in files, one value in fifty broken, read as a stream."""
    rows = _timed(spark, sf).withColumn("at", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    events = E.to_events(rows, "articles.json", F.col("at"), L.article_json(), ["doc_id", "at"])
    broken = F.when(F.col("doc_id") % 100 == 11, "not json").when(
        F.col("doc_id") % 100 == 61, F.lit('{"article": 5}')
    )
    records = events.select(
        "key",
        F.coalesce(broken, "value").alias("value"),
        F.lit("articles").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.to_timestamp("at").alias("timestamp"),
    )
    # The documents may lie in few row groups; the stream's tasks are dealt by the size of the files written here.
    records.hint("rebalance").write.parquet(f"{run}/records")
    return spark.readStream.schema(schemas.KAFKA_RECORD).parquet(f"{run}/records")


ALL_NOW = {"availableNow": True}


def _speed_run(spark, sf) -> str:
    run = scratch.run_dir(spark, "speed")
    records = _record_stream(spark, sf, run)
    speed.start_speed_zone(
        records, run, f"{run}/checkpoint", trigger=ALL_NOW, today=RUN_DATE
    ).awaitTermination()
    return run


def stream_speed_zone(spark, sf):
    stored = speed.read_speed(spark, _speed_run(spark, sf))
    return stored.select("object_id", "url", "source", "titre", F.col("kafka.offset").alias("offset"))


def stream_resume(spark, sf):
    """Half of the records, a stop, the rest; then a second query from the start into the same folder."""
    run = scratch.run_dir(spark, "resume")
    _record_stream(spark, sf, run)
    records = spark.read.schema(schemas.KAFKA_RECORD).parquet(f"{run}/records")
    log = lambda: spark.readStream.schema(schemas.KAFKA_RECORD).parquet(f"{run}/log")
    parts = records.where(F.col("offset") % 2 == 0), records.where(F.col("offset") % 2 == 1)
    for part in parts:
        part.write.mode("append").parquet(f"{run}/log")
        speed.start_speed_zone(log(), run, f"{run}/first", trigger=ALL_NOW, today=RUN_DATE).awaitTermination()
    speed.start_speed_zone(log(), run, f"{run}/second", trigger=ALL_NOW, today=RUN_DATE).awaitTermination()
    stored = speed.read_speed(spark, run)
    return stored.select("object_id", "url", "source", "titre", F.col("kafka.offset").alias("offset"))


def batch_dedup(spark, sf):
    """Verdicts over two batches of each source and stamp that share urls."""
    root = f"{scratch.run_dir(spark, 'batches')}/bronze"
    rows = articles(spark, sf).withColumn("json", L.article_json())
    listed = F.array_join(F.sort_array(F.collect_list("json")), ",")
    for part in (0, 1):
        batch = rows if part else rows.where(F.col("doc_id") % 3 == 0)
        payloads = batch.groupBy("source", "dt", F.floor(F.col("doc_id") / 500).alias("chunk")).agg(
            F.concat(F.lit("["), listed, F.lit("]")).alias("articles")
        ).withColumn("meta", F.to_json(F.struct("source", "chunk", F.lit(part).alias("part"))))
        L.write_bronze(L.bronze_batches(payloads, F.col("source"), _stamp()), root)
    judged = judge(L.read_bronze(spark, root), "inconnu", stamp=STAMP)
    return accepted(judged).groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("url").alias("urls"))


def stream_dead_letters(spark, sf):
    letters = speed.read_dead_letters(spark, _speed_run(spark, sf))
    return letters.groupBy("stage", "error").agg(F.count(F.lit(1)).alias("n"))


def _utc(windows: DataFrame) -> DataFrame:
    """Window starts as UTC clock times, whatever the session's zone."""
    start = F.to_utc_timestamp("window_start", F.current_timezone()).cast("timestamp_ntz")
    return windows.withColumn("window_start", start)


def stream_source_counts(spark, sf):
    run = scratch.run_dir(spark, "counts")
    records = _record_stream(spark, sf, run)
    speed.start_source_counts(records, run, f"{run}/checkpoint", trigger=ALL_NOW).awaitTermination()
    return _utc(speed.read_source_counts(spark, run))


def stream_top_words(spark, sf):
    run = scratch.run_dir(spark, "words")
    records = _record_stream(spark, sf, run)
    speed.start_top_words(records, run, f"{run}/checkpoint", trigger=ALL_NOW).awaitTermination()
    return _utc(speed.read_top_words(spark, run))


# -- warehouse and charts --------------------------------------------------------
def warehouse_upsert(spark, sf):
    """Theme counts of the first half of the articles; themes of the second half replace theirs.

    The second half calls one theme by a name of its own, so there are keys in both and in either.
    """
    rows = articles(spark, sf)
    current = G.articles_per_theme(rows.where(F.col("doc_id") % 2 == 0))
    renamed = F.when(F.col("categorie") == "Sport", "Sports").otherwise(F.col("categorie"))
    incoming = G.articles_per_theme(rows.where(F.col("doc_id") % 2 == 1).withColumn("categorie", renamed))
    return upsert(current, incoming, ["theme"])


def _chart(name: str) -> Query:
    def query(spark, sf):
        tables = G.gold_tables(articles(spark, sf), G.source_country(spark), RUN_DATE)
        return serve(name, tables)

    return query


def medallion_run(spark, sf):
    """A whole run over a fresh lake; rows written and rejected, rows of each table and of each language."""
    base = scratch.run_dir(spark, "medallion")
    lake, warehouse = f"{base}/lake", f"{base}/warehouse"
    rows = raw_articles(spark, sf).withColumn("json", L.article_json())
    # The zone's folder is the source of the listing, the payload keeps its own.
    folder = F.coalesce(F.nullif(F.trim("source"), F.lit("")), F.lit("autres"))
    L.write_bronze(
        L.bronze_envelopes(rows, folder, _stamp(), F.col("doc_id"), F.col("json")), f"{lake}/bronze"
    )
    run = M.new_run(f"gold/dt={RUN_DATE}/run_id=r1")
    model = load_profiles(_even_profiles(spark, sf))
    counts = M.run_medallion(spark, lake, warehouse, run, model=model)
    tables = read_tables(spark, warehouse)
    tagged = L.read_silver(spark, f"{lake}/silver").groupBy(F.concat(F.lit("langue="), F.coalesce("langue", F.lit("")))).agg(F.count(F.lit(1)))
    stages = spark.createDataFrame(
        [(k, counts[k]) for k in ("written", "rejected", "processed")], "table_name string, n long"
    )
    return stages.unionByName(serve("table_counts", tables)).union(tagged)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        top_keywords, top_keywords_first_seen, top_keywords_stopword_table,
        top_topics, top_topics_first_seen,
        articles_per_day, publication_days, articles_per_source, articles_per_theme, articles_per_country,
        silver_accepted, silver_rejects, silver_judged_hot, reject_reasons, run_counters,
        bronze_latest, scraper_files, silver_envelopes, bronze_round_trip, limit_objects, silver_rewrite,
        page_titles, page_bodies, page_meta, page_report, page_invalid_details, page_links, site_links, link_limit,
        language_accuracy, language_profiles, language_tags,
        speed_words, rolling_source_counts, rolling_top_words, event_envelopes,
        stream_speed_zone, stream_resume, batch_dedup, stream_dead_letters, stream_source_counts, stream_top_words,
        warehouse_upsert, medallion_run,
    )
}
QUERIES |= {
    f"chart_{name}": _chart(name)
    for name in ("daily", "source", "theme", "country", "keywords", "topics", "top_sources")
}
QUERIES["table_checks"] = _chart("table_counts")
