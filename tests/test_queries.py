"""Every registered query against its SQL, and the shape of the main plans."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as entry_point  # noqa: E402
from compare import compare, oracle_connection  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_every_query_of_the_library_has_an_oracle():
    assert not set(entry_point.QUERIES) - set(ORACLES) and not set(ORACLES) - set(QUERIES)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["mot_cle", "count"] and df.count() == 50


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["top_keywords", "top_topics", "articles_per_country", "silver_accepted", "silver_rejects", "bronze_latest",
     "page_titles", "page_bodies", "page_links", "speed_words", "rolling_top_words", "event_envelopes"],
)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_n_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_keywords"](spark, SF))


def test_rank_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["rolling_top_words"](spark, SF))


def test_narrow_queries_read_narrow_columns(spark):
    text = plan(QUERIES["articles_per_source"](spark, SF))
    assert "ReadSchema: struct<source:string>" in text


def test_links_do_not_shuffle(spark):
    from newslake.plans import pages as P

    pages = spark.read.parquet(f"{SF}/pages.parquet").selectExpr("*", "'any' AS site")
    assert "Exchange" not in plan(P.extract_links(pages, (P.ANY_LINK,)))
    assert "Exchange" not in plan(P.extract_articles(pages))


def test_scraper_files_share_the_folders_of_source_and_day(spark):
    from newslake.scratch import shared_dir

    zone = Path(shared_dir(spark)) / "newslake"
    before = set(zone.glob("scraped-*"))
    n_files = sum(r.files for r in QUERIES["scraper_files"](spark, SF).collect())
    (run,) = set(zone.glob("scraped-*")) - before
    assert len(list(run.glob("files/source=*/dt=*/*.txt"))) == n_files
