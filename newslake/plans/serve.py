"""The chart queries over the warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_LIMIT = 10_000
PAGE_LENGTH = 20
TOP_SOURCES = 5


def daily_trend(tables: Mapping[str, DataFrame]) -> DataFrame:
    day = F.date_trunc("day", "date").cast("date").alias("date")
    totals = tables["articles_par_jour"].groupBy(day).agg(F.sum("nb_articles").alias("total"))
    return totals.orderBy("date").limit(ROW_LIMIT)


def _bars(table: DataFrame, key: str) -> DataFrame:
    totals = table.groupBy(key).agg(F.sum("nb_articles").alias("total"))
    return totals.orderBy(F.desc("total"), key).limit(ROW_LIMIT)


def _page(table: DataFrame, key: str) -> DataFrame:
    return table.select(key, "count").orderBy(F.desc("count"), key).limit(PAGE_LENGTH)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def top_sources(tables: Mapping[str, DataFrame]) -> DataFrame:
    rows = tables["articles_par_source"].select("source", "nb_articles")
    return rows.orderBy(F.desc("nb_articles"), "source").limit(TOP_SOURCES)


CHARTS = {
    "daily": daily_trend,
    "source": lambda t: _bars(t["articles_par_source"], "source"),
    "theme": lambda t: _bars(t["articles_par_theme"], "theme"),
    "country": lambda t: _bars(t["articles_par_pays"], "pays"),
    "keywords": lambda t: _page(t["mots_cles"], "mot_cle"),
    "topics": lambda t: _page(t["top_sujets"], "sujet"),
    "table_counts": table_counts,
    "top_sources": top_sources,
}


def serve(name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run one chart query by name."""
    return CHARTS[name](tables)
