"""One run over the lake: Bronze to Silver to Gold to the warehouse."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone
from hashlib import sha1

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newslake import scratch
from newslake.operators.language import LanguageModel
from newslake.plans import gold as G
from newslake.plans.pages import extract_articles, invalid_details, page_report, with_page_errors
from newslake.plans.silver import accepted, add_language, judge, rejected
from newslake.schemas import GOLD_DATASETS
from newslake.sources import warehouse as W
from newslake.sources.lake import (
    article_json,
    bronze_envelopes,
    read_bronze,
    read_silver,
    silver_article_key,
    write_bronze,
    write_silver,
)


@dataclass(frozen=True)
class Run:
    """Names and stamps of one run; all stages share them."""

    run_id: str
    run_date: str
    stamp: str

    @property
    def gold_prefix(self) -> str:
        return f"gold/dt={self.run_date}/run_id={self.run_id}"


def new_run(gold_prefix: str | None = None, now: datetime | None = None) -> Run:
    """A run named after the time, or after the ``name=value`` parts of a given Gold prefix."""
    now = now or datetime.now(timezone.utc)
    parts = dict(p.split("=", 1) for p in (gold_prefix or "").split("/") if "=" in p)
    try:
        day = date.fromisoformat(parts.get("dt", "")[:10]).isoformat()
    except ValueError:
        day = f"{now:%Y-%m-%d}"
    return Run(parts.get("run_id") or sha1(now.isoformat().encode()).hexdigest()[:12], day, now.isoformat())


def _append_manifest(spark: SparkSession, path: str, row: dict) -> None:
    spark.createDataFrame([row]).coalesce(1).write.mode("append").parquet(path)


def pages_to_bronze(pages: DataFrame, lake: str, run: Run) -> dict[str, int]:
    """Extract the articles of fetched pages and store the valid ones in Bronze.

    ``pages`` has ``url, html, site``. The report of each site and the details of
    invalid pages go to the manifests.
    """
    spark = pages.sparkSession
    work = f"{scratch.run_dir(spark, f'pages-{run.run_id}')}/checked"
    checked = with_page_errors(extract_articles(pages))
    checked.write.mode("overwrite").parquet(work)
    checked = spark.read.schema(checked.schema).parquet(work)

    valid = checked.where(F.size("errors") == 0).withColumn("json", article_json())
    envelopes = bronze_envelopes(valid, F.col("source"), F.lit(run.stamp), F.lit(0), F.col("json"))
    write_bronze(envelopes, f"{lake}/bronze")
    base = f"{lake}/manifests/pages"
    report = page_report(checked)
    report.write.mode("overwrite").parquet(f"{base}/reports/run_id={run.run_id}")
    invalid_details(checked).write.mode("overwrite").parquet(f"{base}/invalid/run_id={run.run_id}")
    totals = report.agg(*[F.sum(c).alias(c) for c in ("found", "valid", "invalid")]).first()
    return {c: totals[c] or 0 for c in ("found", "valid", "invalid")}


def bronze_to_silver(
    spark: SparkSession,
    lake: str,
    run: Run,
    default_source: str,
    model: LanguageModel | None = None,
    prefix: str = "",
    limit_keys: int = 0,
) -> dict[str, int]:
    """Judge the Bronze articles once, store them, then write Silver, rejects and manifest."""
    work = scratch.run_dir(spark, f"silver-{run.run_id}")
    scanned = Observation("bronze_scan")
    raw = read_bronze(spark, f"{lake}/bronze", prefix, limit_keys, today=run.run_date, counts=scanned)
    counts = Observation("bronze_to_silver")
    bad = F.size("errors") > 0
    judged = judge(raw, default_source, stamp=run.stamp, work_dir=work)
    judged.observe(
        counts, F.count_if(~bad).alias("written"), F.count_if(bad).alias("rejected")
    ).write.mode("overwrite").parquet(f"{work}/judged")
    judged = spark.read.schema(judged.schema).parquet(f"{work}/judged")

    good = add_language(accepted(judged), model)
    write_silver(good, f"{lake}/silver")
    base = f"{lake}/manifests/silver"
    keys = good.select(silver_article_key(F.col("source"), F.col("dt"), F.col("url")).alias("silver_key"))
    keys.write.mode("overwrite").parquet(f"{base}/written_keys/run_id={run.run_id}")
    rejected(judged).write.mode("overwrite").parquet(f"{base}/rejects/run_id={run.run_id}")
    done = {"written": counts.get["written"], "rejected": counts.get["rejected"]}
    _append_manifest(
        spark, f"{base}/runs",
        {"run_id": run.run_id, "started_at": run.stamp, "bronze_prefix": f"bronze/{prefix}", **done, **scanned.get},
    )
    return done


def silver_to_gold(
    spark: SparkSession, lake: str, run: Run, articles: DataFrame | None = None, n: int = G.TOP_N, rejected: int = 0
) -> dict[str, int]:
    """The six datasets of all Silver articles under the run's Gold prefix.

    ``rejected`` are the Silver objects without an article that the caller found beside ``articles``;
    the stored zone holds none.
    """
    articles = read_silver(spark, f"{lake}/silver") if articles is None else articles
    base = f"{lake}/{run.gold_prefix}"
    cube_path = f"{scratch.run_dir(spark, f'gold-{run.run_id}')}/cube"
    cube = G.article_cube(articles, run.run_date)
    cube.write.mode("overwrite").parquet(cube_path)
    cube = spark.read.schema(cube.schema).parquet(cube_path)
    tables = G.gold_tables(articles, G.source_country(spark), run.run_date, n, cube=cube)
    W.write_gold(tables, base, run.stamp)
    processed = cube.agg(F.sum("nb_articles")).first()[0] or 0
    _append_manifest(
        spark, f"{lake}/manifests/gold/runs",
        {
            "run_id": run.run_id, "generated_at": run.stamp, "silver_prefix": "silver/",
            "processed": processed, "rejected": rejected, "top_n_keywords": n,
            "gold_keys": [f"{run.gold_prefix}/{name}" for name in tables],
        },
    )
    return {"processed": processed}


def gold_to_warehouse(spark: SparkSession, lake: str, warehouse: str, run: Run) -> dict[str, int]:
    """All six datasets are opened before anything is written."""
    datasets = {name: W.read_gold(spark, f"{lake}/{run.gold_prefix}", name) for name in GOLD_DATASETS}
    return W.load_warehouse(spark, warehouse, datasets, run.stamp)


def run_medallion(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    run: Run,
    default_source: str = "hespress",
    model: LanguageModel | None = None,
    n: int = G.TOP_N,
) -> dict[str, int]:
    """All stages for one run id, all sources together; returns the counts of each stage."""
    silver = bronze_to_silver(spark, lake, run, default_source, model)
    gold = silver_to_gold(spark, lake, run, n=n)
    return {**silver, **gold, **gold_to_warehouse(spark, lake, warehouse, run)}
