import datetime as dt

import pytest

from newslake.plans.medallion import new_run
from newslake.plans.serve import serve
from newslake.schemas import GOLD_DATASETS
from newslake.sources import warehouse as W

DAY = dt.date(2026, 5, 11)


def gold(spark, shift=0, keywords=("a", "b")):
    made = {}
    for name, (key, _, value) in GOLD_DATASETS.items():
        keys = [DAY] if key == "date" else list(keywords)
        rows = [(k, i + 1 + shift) for i, k in enumerate(keys)]
        made[name] = spark.createDataFrame(rows, f"`{key}` {'date' if key == 'date' else 'string'}, `{value}` long")
    return made


def tables(spark, root):
    return {name: W.read_table(spark, root, name) for name in GOLD_DATASETS}


def test_load_keeps_missing_keys_and_is_idempotent(spark, tmp_path):
    root = str(tmp_path)
    assert W.read_table(spark, root, "mots_cles").count() == 0
    loaded = W.load_warehouse(spark, root, gold(spark), "2026-05-11T10:00:00Z")
    assert loaded["mots_cles"] == 2 and loaded["articles_par_jour"] == 1
    for _ in range(2):
        W.load_warehouse(spark, root, gold(spark, 10, ("b", "c")), "2026-05-11T11:00:00Z")
        rows = {r.mot_cle: (r["count"], r.updated_at.hour) for r in tables(spark, root)["mots_cles"].collect()}
        assert rows == {"a": (1, 10), "b": (11, 11), "c": (12, 11)}
    assert dict(W.read_table(spark, root, "mots_cles").dtypes)["count"] == "bigint"
    both = W.read_tables(spark, root)
    assert set(both) == set(GOLD_DATASETS) and both["mots_cles"].count() == 3


def test_failed_load_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    W.load_warehouse(spark, root, gold(spark), "2026-05-11T10:00:00Z")
    bad = gold(spark, 10)
    bad["articles_par_pays"] = spark.createDataFrame([(None, 1)], "pays string, nb_articles long")
    with pytest.raises(Exception, match="null key"):
        W.load_warehouse(spark, root, bad, "2026-05-11T11:00:00Z")
    twice = gold(spark, 10, ("a", "a"))
    with pytest.raises(ValueError, match="not unique"):
        W.load_warehouse(spark, root, twice, "2026-05-11T11:00:00Z")
    with pytest.raises(ValueError, match="missing datasets"):
        W.load_warehouse(spark, root, {"mots_cles": gold(spark)["mots_cles"]}, "2026-05-11T11:00:00Z")
    assert W.current_version(spark, root) == 1
    assert W.read_table(spark, root, "articles_par_jour").first().nb_articles == 1


def test_null_count_is_zero(spark, tmp_path):
    data = gold(spark)
    data["top_sujets"] = spark.createDataFrame([("x", None)], "sujet string, count long")
    W.load_warehouse(spark, str(tmp_path), data, "2026-05-11T10:00:00Z")
    assert W.read_table(spark, str(tmp_path), "top_sujets").first()["count"] == 0


def test_charts(spark, tmp_path):
    root = str(tmp_path)
    W.load_warehouse(spark, root, gold(spark, 0, [f"w{i:02d}" for i in range(30)]), "2026-05-11T10:00:00Z")
    t = tables(spark, root)
    assert [tuple(r) for r in serve("daily", t).collect()] == [(DAY, 1)]
    assert [r.total for r in serve("source", t).collect()] == list(range(30, 0, -1))
    assert [r["count"] for r in serve("keywords", t).collect()] == list(range(30, 10, -1))
    assert serve("topics", t).count() == 20
    assert [r.source for r in serve("top_sources", t).collect()] == ["w29", "w28", "w27", "w26", "w25"]
    assert {r.table_name: r.n for r in serve("table_counts", t).collect()} == {
        name: 1 if name == "articles_par_jour" else 30 for name in GOLD_DATASETS
    }


def test_run_names():
    run = new_run("gold/dt=2026-05-04/run_id=abc")
    assert (run.run_id, run.run_date, run.gold_prefix) == ("abc", "2026-05-04", "gold/dt=2026-05-04/run_id=abc")
    now = dt.datetime(2026, 5, 4, tzinfo=dt.timezone.utc)
    assert new_run(now=now).run_date == "2026-05-04" and len(new_run(now=now).run_id) == 12
