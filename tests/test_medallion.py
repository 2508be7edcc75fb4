import datetime as dt

from pyspark.sql import functions as F

from articles import SAMPLE
from newslake import schemas
from newslake.operators.language import load_profiles, train_lang_profiles
from newslake.plans.medallion import new_run, pages_to_bronze, run_medallion
from newslake.schemas import GOLD_DATASETS
from newslake.sources import lake as L
from newslake.sources.warehouse import read_table


def write(spark, lake, rows, stamp):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schemas.ARTICLE)
    df = df.withColumn("json", L.article_json())
    envelopes = L.bronze_envelopes(df, F.lit("hespress"), F.lit(stamp), F.lit(0), F.col("json"))
    L.write_bronze(envelopes, f"{lake}/bronze")


def tables(spark, warehouse):
    out = {}
    for name, (key, _, value) in GOLD_DATASETS.items():
        out[name] = {r[key]: r[value] for r in read_table(spark, warehouse, name).collect()}
    return out


def test_runs_over_the_sample(spark, tmp_path):
    lake, warehouse = str(tmp_path / "lake"), str(tmp_path / "warehouse")
    labelled = spark.createDataFrame([(a["contenu"], "fr") for a in SAMPLE] + [("the with and of a test", "en")], "text string, lang string")
    model = load_profiles(train_lang_profiles(labelled))
    short = {**SAMPLE[0], "url": "https://www.hespress.com/x", "contenu": "court"}
    write(spark, lake, [*SAMPLE, short], "2026-05-11T12:00:00+00:00")
    for _ in range(2):
        run = new_run(now=dt.datetime(2026, 5, 12, 8, tzinfo=dt.timezone.utc))
        counts = run_medallion(spark, lake, warehouse, run, model=model)
        assert (counts["written"], counts["rejected"], counts["processed"]) == (2, 1, 2)
        got = tables(spark, warehouse)
        assert got["articles_par_jour"] == {dt.date(2026, 5, 11): 2}
        assert got["articles_par_source"] == {"hespress": 2} and got["articles_par_pays"] == {"Maroc": 2}
        assert got["articles_par_theme"] == {"Politique": 1, "Sport": 1}
        assert got["top_sujets"] == {"test article": 2}
        assert got["mots_cles"]["article"] == 4 and "dans" not in got["mots_cles"]
    assert {r.langue for r in L.read_silver(spark, f"{lake}/silver").collect()} == {"fr"}
    rejects = spark.read.parquet(f"{lake}/manifests/silver/rejects").collect()
    assert [(r.url, r.errors) for r in rejects] == [("https://www.hespress.com/x", ["contenu trop court"])]
    keys = spark.read.parquet(f"{lake}/manifests/silver/written_keys").collect()
    assert {r.silver_key for r in keys} == {
        "silver/source=hespress/dt=2026-05-11/articles/6a6b6dfae4d267f7d433fdb29085cbb36dcd9c44.json",
        "silver/source=hespress/dt=2026-05-11/articles/1f93351e3a8c7f8a01fcd4d92410a8e880625b59.json",
    }


def test_empty_lake(spark, tmp_path):
    counts = run_medallion(spark, str(tmp_path / "lake"), str(tmp_path / "w"), new_run())
    assert set(counts.values()) == {0}


def test_pages_to_bronze(spark, tmp_path):
    def page(body):
        return f"<h1>Titre</h1><time datetime='2026-05-11'>x</time><article><p>{body}</p></article>"

    rows = [("https://goud.ma/1", page("x" * 120), "goud"), ("https://goud.ma/2", page("court"), "goud")]
    pages = spark.createDataFrame(rows, "url string, html string, site string")
    run = new_run(now=dt.datetime(2026, 5, 12, tzinfo=dt.timezone.utc))
    lake = str(tmp_path)
    assert pages_to_bronze(pages, lake, run) == {"found": 2, "valid": 1, "invalid": 1}
    (stored,) = L.read_bronze(spark, f"{lake}/bronze").collect()
    assert (stored.url, stored.titre, stored.source, stored.dt) == ("https://goud.ma/1", "Titre", "goud", "2026-05-12")
    (bad,) = spark.read.parquet(f"{lake}/manifests/pages/invalid").collect()
    assert (bad.url, bad.errors) == ("https://goud.ma/2", ["contenu trop court"])


def test_manifests_count_malformed_and_rejected_objects(spark, tmp_path):
    lake, run = str(tmp_path / "lake"), new_run(now=dt.datetime(2026, 5, 12, tzinfo=dt.timezone.utc))
    write(spark, lake, SAMPLE, "2026-05-11T12:00:00+00:00")
    folder = tmp_path / "lake/bronze/source=hespress/dt=2026-05-11"
    (folder / "odd.txt").write_text('[1]\nnot json\n{"layer":"silver","article":{"url":"u"}}\n{"layer":"bronze","articles":[]}\n')
    run_medallion(spark, lake, str(tmp_path / "w"), run)
    (silver,) = spark.read.parquet(f"{lake}/manifests/silver/runs").collect()
    assert (silver.written, silver.rejected, silver.objects, silver.malformed) == (2, 0, 6, 3)
    (gold,) = spark.read.parquet(f"{lake}/manifests/gold/runs").collect()
    assert (gold.processed, gold.rejected) == (2, 0)
