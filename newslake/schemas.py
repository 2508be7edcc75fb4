"""Declared schemas. Nothing in the package infers a JSON schema."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ARTICLE = _strings(
    "titre", "url", "date_publication", "categorie", "auteur", "contenu", "source"
)

SILVER_ARTICLE = T.StructType(ARTICLE.fields + _strings("langue", "normalized_at").fields)

# Envelope members are kept as JSON text so that "is it a list / an object?"
# can be answered before the article schema is applied.
ENVELOPE_TEXT = T.StructType(
    _strings("ingested_at", "source", "layer", "meta", "article", "articles").fields
    + [T.StructField("seq", T.LongType())]
)

SILVER_ENVELOPE_TEXT = _strings("layer", "bronze_key", "ingested_at", "article")

SCRAPE_META = T.StructType(
    _strings("source", "listing_url", "scraped_at").fields
    + [
        T.StructField(n, T.IntegerType())
        for n in ("requested_max_articles", "found_urls", "valid_articles", "invalid_articles")
    ]
    + [
        T.StructField(
            "invalid_details",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("url", T.StringType()),
                        T.StructField("errors", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        )
    ]
)

EVENT_TEXT = _strings("event_type", "event_time", "source_file", "article")

KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# dataset name -> (key column, key type, value column)
GOLD_DATASETS: dict[str, tuple[str, T.DataType, str]] = {
    "articles_par_jour": ("date", T.DateType(), "nb_articles"),
    "articles_par_source": ("source", T.StringType(), "nb_articles"),
    "mots_cles": ("mot_cle", T.StringType(), "count"),
    "top_sujets": ("sujet", T.StringType(), "count"),
    "articles_par_theme": ("theme", T.StringType(), "nb_articles"),
    "articles_par_pays": ("pays", T.StringType(), "nb_articles"),
}


def gold_schema(name: str) -> T.StructType:
    key, key_type, value = GOLD_DATASETS[name]
    return T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField(value, T.LongType()),
            T.StructField("generated_at", T.TimestampType()),
        ]
    )


def warehouse_schema(name: str) -> T.StructType:
    key, key_type, value = GOLD_DATASETS[name]
    return T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField(value, T.LongType()),
            T.StructField("updated_at", T.TimestampType()),
        ]
    )
