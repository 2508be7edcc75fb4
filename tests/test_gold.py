import datetime as dt

from articles import LONG, SAMPLE, raw
from newslake.plans import gold as G
from newslake.streaming.rolling import word_counts

DAY = dt.date(2026, 5, 11)


def sample(spark, lang="fr"):
    rows = [("k", i, "2026-05-11", *a.values()) for i, a in enumerate(SAMPLE)]
    schema = raw(spark).schema
    return spark.createDataFrame(rows, schema).selectExpr("*", f"'{lang}' AS langue")


def titled(spark, *titles, lang="fr"):
    df = raw(spark, *[("k", i, {"titre": t, "contenu": ""}) for i, t in enumerate(titles)])
    return df.selectExpr("*", f"cast({'null' if lang is None else repr(lang)} AS string) AS langue")


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_sample_articles(spark):
    a, countries = sample(spark), G.source_country(spark)
    assert tuples(G.articles_per_day(a, "2026-06-01")) == [(DAY, 2)]
    assert tuples(G.articles_per_source(a)) == [("hespress", 2)]
    assert tuples(G.articles_per_country(a, countries)) == [("Maroc", 2)]
    assert tuples(G.articles_per_theme(a)) == [("Politique", 1), ("Sport", 1)]
    words = tuples(G.top_keywords(a))
    assert words[:2] == [("article", 4), ("test", 4)] and ("rifier", 1) in words
    assert tuples(G.top_topics(a)) == [("test article", 2)]
    speed = word_counts(a).orderBy("mot").collect()
    counts = sorted(((r["mot"], r["count"]) for r in speed), key=lambda x: (-x[1], x[0]))
    assert counts[:4] == [("article", 4), ("test", 4), ("pour", 3), ("est", 2)]


def test_gold_tables_equal_the_single_queries(spark):
    a, countries = sample(spark), G.source_country(spark)
    tables = G.gold_tables(a, countries, "2026-06-01")
    assert tuples(tables["articles_par_jour"]) == tuples(G.articles_per_day(a, "2026-06-01"))
    assert tuples(tables["articles_par_source"]) == tuples(G.articles_per_source(a))
    assert tuples(tables["articles_par_theme"]) == tuples(G.articles_per_theme(a))
    assert tuples(tables["articles_par_pays"]) == tuples(G.articles_per_country(a, countries))


def test_day_falls_back_to_path_then_run(spark):
    df = raw(spark, ("k", 0, {"date_publication": "9 mai"}), ("k", 1, {"date_publication": None}))
    assert tuples(G.articles_per_day(df, "2026-06-01")) == [(dt.date(2026, 5, 10), 2)]
    no_path = df.selectExpr("date_publication", "cast(null AS string) AS dt")
    assert tuples(G.articles_per_day(no_path, "2026-06-01")) == [(dt.date(2026, 6, 1), 2)]


def test_country_of_source(spark):
    sources = [" Hespress ", "lemonde", None, "REUTERS", "bbc_arabic", "aljazeera", "goud"]
    df = raw(spark, *[("k", i, {"source": s}) for i, s in enumerate(sources)])
    got = tuples(G.articles_per_country(df, G.source_country(spark)))
    assert got == [("Maroc", 2), ("unknown", 2), ("Qatar", 1), ("UK", 1), ("USA", 1)]


def test_blank_theme_is_unknown(spark):
    df = raw(spark, *[("k", i, {"categorie": c}) for i, c in enumerate([None, " ", "A"])])
    assert tuples(G.articles_per_theme(df)) == [("unknown", 2), ("A", 1)]


def test_removed_word_closes_the_gap(spark):
    assert tuples(G.top_topics(titled(spark, "alpha avec gamma"))) == [("alpha gamma", 1)]
    assert tuples(G.top_topics(titled(spark, "alpha", "avec alpha", ""))) == []


def test_other_languages_drop_the_union_of_stopwords(spark):
    for lang in (None, "de"):
        assert tuples(G.top_keywords(titled(spark, "with avec rest", lang=lang))) == [("rest", 1)]


def test_ties(spark):
    df = titled(spark, "zebre zebre mouton", "mouton alpha, delta")
    assert tuples(G.top_keywords(df, 3)) == [("mouton", 2), ("zebre", 2), ("alpha", 1)]
    assert tuples(G.top_keywords(df, 3, tie="first_seen")) == [("zebre", 2), ("mouton", 2), ("alpha", 1)]
    joined = titled(spark, "delta-gamma alpha")
    assert tuples(G.top_keywords(joined, 2, tie="first_seen")) == [("delta", 1), ("gamma", 1)]
    topics = titled(spark, "zebre mouton alpha")
    assert tuples(G.top_topics(topics, 1)) == [("mouton alpha", 1)]
    assert tuples(G.top_topics(topics, 1, tie="first_seen")) == [("zebre mouton", 1)]


def test_stopword_table(spark):
    df = titled(spark, "alpha avec gamma")
    words = spark.createDataFrame([("fr", "gamma"), ("en", "alpha")], "lang_group string, token string")
    assert tuples(G.top_keywords(df, stopwords=words)) == [("alpha", 1), ("avec", 1)]


def test_repartitioning_changes_nothing(spark):
    df = raw(spark, *[("k", i, {"contenu": LONG * (i % 3 + 1)}) for i in range(20)]).selectExpr("*", "'fr' AS langue")
    assert tuples(G.top_keywords(df)) == tuples(G.top_keywords(df.repartition(5)))


def test_texts_with_few_blanks(spark):
    joined = "-".join(["alpha", "delta"] * 40)
    df = titled(spark, f"{joined} omega", "delta")
    assert tuples(G.top_keywords(df)) == [("delta", 41), ("alpha", 40), ("omega", 1)]
    first = tuples(G.top_keywords(titled(spark, joined), 2, tie="first_seen"))
    assert first == [("alpha", 40), ("delta", 40)]
