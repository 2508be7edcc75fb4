"""Bronze to Silver: clean, validate, first valid copy per url, keep rejects with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake import scratch
from newslake.functions.text import clean_text, trim_space
from newslake.operators.dedup import later_copies, sized_lookup
from newslake.operators.language import LanguageModel, detect_language, language_sample

# -- fixed values: reject reasons, in rule order, and the rule limits ----------
NO_TITLE = "titre vide"
NO_DATE = "date manquante"
TOO_SHORT = "contenu trop court"
BAD_URL = "url invalide"
NO_URL = "url manquante"
DUPLICATE = "doublon url"
MIN_CONTENT_CHARS = 101
HTTP_URL = r"(?iU)^https?://[^\s/$.?#].[^\s]*$"
# -----------------------------------------------------------------------------


def normalize(raw: DataFrame, default_source: str, stamp: str | None = None) -> DataFrame:
    """Cleaned article fields; the publication date passes through as written.

    Serves batch and stream alike. ``stamp`` fixes ``normalized_at``; without it
    the query's own time is used. The language is added by ``add_language``.
    """
    now = F.lit(stamp) if stamp else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    source = F.nullif(clean_text(F.col("source")), F.lit(""))
    return raw.withColumns(
        {
            "titre": clean_text(F.col("titre")),
            "url": trim_space(F.coalesce("url", F.lit(""))),
            "categorie": F.when(F.col("categorie").isNotNull(), clean_text(F.col("categorie"))),
            "auteur": F.nullif(clean_text(F.col("auteur")), F.lit("")),
            "contenu": clean_text(F.col("contenu")),
            "source": F.coalesce(source, F.lit(default_source)),
            "normalized_at": now,
        }
    )


def failed_rules(titre: Column, date: Column, contenu: Column, url_ok: Column) -> Column:
    """All broken rules in order; an empty array means valid."""
    no_date = F.coalesce(trim_space(date), F.lit("")) == ""
    return F.array_compact(
        F.array(
            F.when(titre == "", NO_TITLE),
            F.when(no_date, NO_DATE),
            F.when(F.length(contenu) < MIN_CONTENT_CHARS, TOO_SHORT),
            F.when(~url_ok, BAD_URL),
        )
    )


def judge(
    raw: DataFrame,
    default_source: str,
    stamp: str | None = None,
    work_dir: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Normalised rows with ``errors``: the reasons of rejection, empty where accepted.

    ``raw`` holds ``bronze_key, pos, dt`` and the raw article. Rows without a
    url are out before anything else. The first valid row of a url in
    (bronze_key, pos) order is accepted; later rows are duplicates whatever
    their own faults; earlier ones keep their own reasons.

    The cleaned rows are stored below ``work_dir`` (by default a fresh folder of the shared one):
    all further steps read them, and repeated urls are settled over narrow columns alone.
    ``parts`` is that of ``join_repeated``.
    """
    work = work_dir or scratch.run_dir(raw.sparkSession, "judged")
    own = failed_rules(
        F.col("titre"), F.col("date_publication"), F.col("contenu"), F.col("url").rlike(HTTP_URL)
    )
    rows = normalize(raw, default_source, stamp).withColumn("own_errors", own)
    rows = scratch.stored(rows, f"{work}/normalized")
    narrow = rows.select(
        F.nullif("url", F.lit("")).alias("url"), "bronze_key", "pos", (F.size("own_errors") == 0).alias("valid")
    )
    later = later_copies(narrow, "url", ["bronze_key", "pos"], "valid", work, parts)
    later = sized_lookup(later, later.count()).select(
        F.col("_key").alias("_url"), F.col("bronze_key").alias("_bronze_key"), F.col("pos").alias("_pos"), F.lit(True).alias("_later")
    )
    # Placed by key and position too, so the rows of one url do not meet in one task.
    place = (F.col("bronze_key") == F.col("_bronze_key")) & (F.col("pos") == F.col("_pos")) & (F.col("url") == F.col("_url"))
    errors = (
        F.when(F.col("url") == "", F.array(F.lit(NO_URL)))
        .when(F.col("_later"), F.array(F.lit(DUPLICATE)))
        .otherwise(F.col("own_errors"))
    )
    found = rows.join(later, place, "left").withColumn("errors", errors)
    return found.drop("own_errors", "_url", "_bronze_key", "_pos", "_later")


def accepted(judged: DataFrame, ingested_at: str | None = None) -> DataFrame:
    stamp = F.lit(ingested_at) if ingested_at else F.col("normalized_at")
    return judged.where(F.size("errors") == 0).withColumn("ingested_at", stamp).drop("errors", "pos")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.size("errors") > 0).select("bronze_key", "pos", "url", "errors")


def to_silver(raw: DataFrame, default_source: str, **options) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of one judged frame; options as for ``judge``."""
    judged = judge(raw, default_source, **options)
    return accepted(judged), rejected(judged)


def add_language(articles: DataFrame, model: LanguageModel | None) -> DataFrame:
    """Add ``langue``; without a model an existing column stays, else it is null."""
    if model is None:
        if "langue" in articles.columns:
            return articles
        return articles.withColumn("langue", F.lit(None).cast("string"))
    return detect_language(articles, model, language_sample(F.col("titre"), F.col("contenu")))


def rejects_by_reason(rejects: DataFrame) -> DataFrame:
    reasons = rejects.select(F.explode("errors").alias("error"))
    return reasons.groupBy("error").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "error")


def silver_counters(judged: DataFrame) -> DataFrame:
    """One row: articles processed, rejected and written."""
    bad = F.size("errors") > 0
    return judged.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(bad).alias("rejected"),
        F.count_if(~bad).alias("written"),
    )
