"""Silver to Gold: six aggregates over articles.

Input columns: ``titre, contenu, langue, source, categorie, date_publication,
dt``; ``bronze_key`` and ``pos`` too where ties are cut by first appearance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions.dates import publication_day
from newslake.functions.text import (
    MIN_BATCH_CHARS,
    batch_tokens,
    is_batch_candidate,
    is_stopword,
    language_group,
    or_default,
    title_and_content,
)
from newslake.operators.topn import count_chunks, top_counts, top_counts_first_seen

# -- fixed values: country of each source --------------------------------------
SOURCE_COUNTRY = (
    ("hespress", "Maroc"),
    ("akhbarona", "Maroc"),
    ("barlamane", "Maroc"),
    ("goud", "Maroc"),
    ("aljazeera", "Qatar"),
    ("bbc_arabic", "UK"),
    ("reuters", "USA"),
)
UNKNOWN = "unknown"
# -----------------------------------------------------------------------------

TOP_N = 50


def source_country(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCE_COUNTRY, "source string, pays string")


def _count() -> Column:
    return F.count(F.lit(1)).alias("nb_articles")


def _day(run_date: str) -> Column:
    """Publication day, else the day of the storage path, else the day of the run."""
    path_day = F.try_to_date(F.col("dt").cast("string"))
    return F.coalesce(publication_day(F.col("date_publication")), path_day, F.lit(run_date).cast("date"))


def article_cube(articles: DataFrame, run_date: str) -> DataFrame:
    """Article counts by day, source and theme: one scan of four narrow columns.

    The four count datasets are roll-ups of this small table.
    """
    keys = articles.select(
        _day(run_date).alias("date"),
        or_default(F.col("source"), UNKNOWN).alias("source"),
        or_default(F.col("categorie"), UNKNOWN).alias("theme"),
    )
    return keys.groupBy("date", "source", "theme").agg(_count())


def _roll_up(cube: DataFrame, key: str) -> DataFrame:
    return cube.groupBy(key).agg(F.sum("nb_articles").alias("nb_articles"))


def _ranked(counts: DataFrame, key: str) -> DataFrame:
    return counts.orderBy(F.desc("nb_articles"), key)


def articles_per_day(articles: DataFrame, run_date: str) -> DataFrame:
    return articles.groupBy(_day(run_date).alias("date")).agg(_count()).orderBy("date")


def articles_per_source(articles: DataFrame) -> DataFrame:
    source = or_default(F.col("source"), UNKNOWN).alias("source")
    return _ranked(articles.groupBy(source).agg(_count()), "source")


def articles_per_theme(articles: DataFrame) -> DataFrame:
    theme = or_default(F.col("categorie"), UNKNOWN).alias("theme")
    return _ranked(articles.groupBy(theme).agg(_count()), "theme")


def _with_country(per_source: DataFrame, countries: DataFrame) -> DataFrame:
    """Country of each source row through the lookup table; sources compare in lower case."""
    dim = countries.select(F.col("source").alias("_site"), "pays")
    joined = per_source.join(dim, F.lower("source") == F.col("_site"), "left")
    return joined.select(F.coalesce("pays", F.lit(UNKNOWN)).alias("pays"), "nb_articles")


def articles_per_country(articles: DataFrame, countries: DataFrame) -> DataFrame:
    """Counts by source first, so the lookup joins one row per source."""
    source = or_default(F.col("source"), UNKNOWN).alias("source")
    per_source = articles.groupBy(source).agg(_count())
    return _ranked(_roll_up(_with_country(per_source, countries), "pays"), "pays")


def _kept(tok: Column, group: Column, stopwords: DataFrame | None) -> Column:
    kept = is_batch_candidate(tok)
    return kept if stopwords is not None else kept & ~is_stopword(tok, group)


def _without(terms: DataFrame, term: str, stopwords: DataFrame | None) -> DataFrame:
    """Anti-join against a caller's stopword table ``(lang_group, token)``."""
    if stopwords is None:
        return terms
    words = stopwords.select("lang_group", F.col("token").alias(term))
    return terms.join(words, ["lang_group", term], "left_anti")


def top_keywords(
    articles: DataFrame, n: int = TOP_N, tie: str = "term", stopwords: DataFrame | None = None
) -> DataFrame:
    """Most frequent words of title and content.

    ``tie='term'`` cuts equal counts alphabetically, ``'first_seen'`` by first
    appearance in (bronze_key, pos, word position) order. The built-in stopwords
    are a constant set; ``stopwords`` replaces them by a table, where the group
    'any' holds the words for all other languages.
    """
    group = language_group(F.col("langue")).alias("lang_group")
    text = title_and_content(F.col("titre"), F.col("contenu"))
    chunks = count_chunks(articles, text, [group], MIN_BATCH_CHARS, batch_tokens)
    words = chunks.select("lang_group", "n", F.explode(batch_tokens(F.col("chunk"))).alias("mot_cle"))
    words = words.where(_kept(F.col("mot_cle"), F.col("lang_group"), stopwords))
    words = _without(words, "mot_cle", stopwords)
    counts = words.groupBy("mot_cle").agg(F.sum("n").alias("count"))
    if tie == "term":
        return top_counts(counts, "mot_cle", n)

    def places(chosen: DataFrame) -> DataFrame:
        token = F.posexplode(batch_tokens(text)).alias("word_pos", "mot_cle")
        tokens = articles.select("bronze_key", "pos", group, token).join(chosen, "mot_cle", "left_semi")
        tokens = tokens.where(_kept(F.col("mot_cle"), F.col("lang_group"), stopwords))
        tokens = _without(tokens, "mot_cle", stopwords)
        return tokens.groupBy("mot_cle").agg(F.min(F.struct("bronze_key", "pos", "word_pos")).alias("first_seen"))

    return top_counts_first_seen(counts, "mot_cle", places, n)


def _title_words(articles: DataFrame) -> DataFrame:
    """``words``: the title words that survive the filters, in order."""
    group = language_group(F.col("langue"))
    tokens = batch_tokens(F.coalesce("titre", F.lit("")))
    words = F.filter(tokens, lambda t: is_batch_candidate(t) & ~is_stopword(t, group))
    return articles.withColumn("words", words).where(F.size("words") >= 2)


def _adjacent_pairs(words: Column) -> Column:
    """Pairs of neighbours; a removed word has already closed its gap."""
    heads = F.slice(words, F.lit(1), F.size(words) - 1)
    return F.transform(heads, lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))


def top_topics(articles: DataFrame, n: int = TOP_N, tie: str = "term") -> DataFrame:
    """Most frequent title bigrams; ``tie`` as for ``top_keywords``."""
    titles, pairs = _title_words(articles), _adjacent_pairs(F.col("words"))
    total = F.count(F.lit(1)).alias("count")
    if tie == "term":
        topics = titles.select(F.explode(pairs).alias("sujet"))
        return top_counts(topics.groupBy("sujet").agg(total), "sujet", n)
    topics = titles.select("bronze_key", "pos", F.posexplode(pairs).alias("pair_pos", "sujet"))

    def places(chosen: DataFrame) -> DataFrame:
        found = topics.join(chosen, "sujet", "left_semi")
        return found.groupBy("sujet").agg(F.min(F.struct("bronze_key", "pos", "pair_pos")).alias("first_seen"))

    return top_counts_first_seen(topics.groupBy("sujet").agg(total), "sujet", places, n)


def gold_tables(
    articles: DataFrame, countries: DataFrame, run_date: str, n: int = TOP_N, cube: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The six datasets by name. A stored ``cube`` spares three scans."""
    cube = article_cube(articles, run_date) if cube is None else cube
    per_country = _with_country(_roll_up(cube, "source"), countries)
    return {
        "articles_par_jour": _roll_up(cube, "date").orderBy("date"),
        "articles_par_source": _ranked(_roll_up(cube, "source"), "source"),
        "mots_cles": top_keywords(articles, n),
        "top_sujets": top_topics(articles, n),
        "articles_par_theme": _ranked(_roll_up(cube, "theme"), "theme"),
        "articles_par_pays": _ranked(_roll_up(per_country, "pays"), "pays"),
    }
