import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from articles import LONG, SAMPLE
from newslake.operators import dedup
from newslake.operators import upsert as U
from newslake.operators.dedup import latest_per_key
from newslake.operators.upsert import upsert
from newslake.sources import lake as L

STAMP = "2026-05-11T12:00:00+00:00"


def put(root: pathlib.Path, key: str, payload) -> None:
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload, ensure_ascii=False), "utf-8")


def bronze(spark, root, **options):
    found = L.read_bronze(spark, str(root / "bronze"), **options)
    return [(r.bronze_key, r.pos, r.dt, r.url) for r in found.orderBy("bronze_key", "pos").collect()]


def test_both_layouts_of_json_objects(spark, tmp_path):
    single = "bronze/source=goud/dt=2026-05-09/articles/" + "a" * 40 + ".json"
    batch = "bronze/source=goud/dt=2026-05-10/120000_abcdef123456.json"
    both = "bronze/source=goud/dt=2026-05-11/130000_abcdef123456.json"
    put(tmp_path, single, {"layer": "bronze", "source": "x", "article": {"url": "u1", "titre": "é"}})
    put(tmp_path, batch, {"layer": "bronze", "articles": [{"url": "u2"}, "x", 5, None, [1], {"url": "u3"}]})
    put(tmp_path, both, {"layer": "bronze", "articles": [], "article": {"url": "u4"}})
    put(tmp_path, single.replace("a" * 40, "b" * 40), {"layer": "silver", "article": {"url": "u5"}})
    put(tmp_path, single.replace("a" * 40, "c" * 40), {"article": {"url": "u6"}})
    put(tmp_path, single.replace("a" * 40, "d" * 40), "[1]")
    put(tmp_path, "bronze/_manifests/x.json", {"layer": "bronze", "article": {"url": "u7"}})
    assert bronze(spark, tmp_path) == [
        (single, 0, "2026-05-09", "u1"), (batch, 0, "2026-05-10", "u2"), (batch, 5, "2026-05-10", "u3"),
    ]
    assert bronze(spark, tmp_path, limit_keys=1) == [(single, 0, "2026-05-09", "u1")]
    # Objects without articles count towards the limit too.
    assert len(bronze(spark, tmp_path, limit_keys=4)) == 1
    assert len(bronze(spark, tmp_path, limit_keys=5)) == 3
    assert bronze(spark, tmp_path, prefix="source=goud/dt=2026-05-10")[0][3] == "u2"


def test_empty_lake(spark, tmp_path):
    assert bronze(spark, tmp_path) == []


def test_scraper_file_to_bronze_and_back(spark, tmp_path):
    file = {"meta": {"source": "hespress"}, "articles": [*SAMPLE, "x", {"titre": "sans url"}, {**SAMPLE[0], "titre": "Encore"}]}
    put(tmp_path, "in.json", json.dumps(file, ensure_ascii=False, indent=2))
    files = L.read_scraper_files(spark, str(tmp_path / "in.json"))
    found = L.scraped_articles(files)
    assert [r.pos for r in found.orderBy("pos").collect()] == [0, 1, 3, 4]

    root = str(tmp_path / "bronze")
    L.write_bronze(L.bronze_envelopes(found, F.lit("hespress"), F.lit(STAMP), F.col("pos"), F.col("json")), root)
    stored = {r.url: r for r in L.read_bronze(spark, root).collect()}
    assert {u: r.titre for u, r in stored.items()} == {SAMPLE[0]["url"]: "Encore", SAMPLE[1]["url"]: "Test Article 2"}
    row = stored[SAMPLE[1]["url"]]
    assert row.bronze_key == (
        "bronze/source=hespress/dt=2026-05-11/articles/1f93351e3a8c7f8a01fcd4d92410a8e880625b59.json"
    )
    assert {k: row[k] for k in SAMPLE[1]} == SAMPLE[1]

    L.write_bronze(L.bronze_batches(files, F.lit("goud"), F.lit(STAMP)), root)
    batch = L.read_bronze(spark, root, prefix="source=goud").orderBy("pos").collect()
    assert [r.pos for r in batch] == [0, 1, 3, 4]
    assert batch[0].bronze_key.startswith("bronze/source=goud/dt=2026-05-11/120000_")


@pytest.mark.parametrize("content", ['{"articles": {}}', '{"meta": {}}', "[]", '{"articles": "x"}'])
def test_bad_scraper_file_fails(spark, tmp_path, content):
    put(tmp_path, "in.json", content)
    with pytest.raises(Exception, match="no list 'articles'"):
        L.read_scraper_files(spark, str(tmp_path / "in.json")).collect()


def test_scrape_reports(spark, tmp_path):
    meta = {"source": "goud", "found_urls": 2, "valid_articles": 1, "invalid_details": [{"url": "u", "errors": ["titre vide"]}]}
    put(tmp_path, "in.json", {"meta": meta, "articles": []})
    (row,) = L.scrape_reports(L.read_scraper_files(spark, str(tmp_path / "in.json"))).collect()
    assert (row.source, row.found_urls, row.valid_articles, row.listing_url) == ("goud", 2, 1, None)
    assert [(d.url, d.errors) for d in row.invalid_details] == [("u", ["titre vide"])]


def test_empty_scraper_file(spark, tmp_path):
    put(tmp_path, "in.json", '{"meta": {"found_urls": 0}, "articles": []}')
    assert L.scraped_articles(L.read_scraper_files(spark, str(tmp_path / "in.json"))).count() == 0


def silver(spark, *rows):
    names = "bronze_key titre url date_publication categorie auteur contenu langue normalized_at ingested_at source dt"
    full = [("k", t, u, "d", None, None, LONG, None, "n", "i", s, d) for s, d, u, t in rows]
    return spark.createDataFrame(full, ", ".join(f"{n} string" for n in names.split()))


def test_silver_rewrite_replaces_only_its_own_urls(spark, tmp_path):
    root = str(tmp_path / "silver")
    L.write_silver(silver(spark, ("s", "2026-05-09", "a", "1"), ("s", "2026-05-09", "b", "1"), ("t", "2026-05-09", "b", "1")), root)
    second = silver(spark, ("s", "2026-05-09", "b", "2"), ("s", "2026-05-09", "n", "2"), ("s", "2026-05-10", "b", "2"))
    for _ in range(2):
        L.write_silver(second, root)
        got = {(r.source, r.dt, r.url): r.titre for r in L.read_silver(spark, root).collect()}
        assert got == {
            ("s", "2026-05-09", "a"): "1", ("s", "2026-05-09", "b"): "2", ("s", "2026-05-09", "n"): "2",
            ("t", "2026-05-09", "b"): "1", ("s", "2026-05-10", "b"): "2",
        }
        assert L.read_silver(spark, root).count() == 5


def test_silver_rewrite_reads_only_the_touched_partitions(spark, tmp_path):
    root = str(tmp_path / "silver")
    L.write_silver(silver(spark, ("s", "2026-05-09", "a", "1"), ("t", "2026-05-10", "b", "1")), root)
    touched = silver(spark, ("s", "2026-05-09", "x", "2"))
    before = U.read_versioned(spark, root, L.SILVER, ["source", "dt"], touched)
    assert [r.url for r in before.collect()] == ["a"]
    text = before._jdf.queryExecution().optimizedPlan().toString() + before._jdf.queryExecution().sparkPlan().toString()
    assert "dynamicpruning" in text
    L.write_silver(touched, root)
    # The other partition stays where its own load wrote it.
    assert {p.parent.parent.name for p in (tmp_path / "silver/data").rglob("dt=2026-05-10")} == {"version=1"}


def state(spark, root):
    return sorted((r.source, r.dt, r.url, r.titre) for r in L.read_silver(spark, root).collect())


def test_a_write_without_commit_changes_nothing(spark, tmp_path, monkeypatch):
    """A write that dies between data and commit leaves the old state; the next one replaces what it left."""
    root = str(tmp_path / "silver")
    assert state(spark, root) == []
    L.write_silver(silver(spark, ("s", "d1", "a", "1"), ("t", "d1", "b", "1")), root)
    before = state(spark, root)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(U, "commit_version", killed)
        with pytest.raises(RuntimeError, match="killed"):
            L.write_silver(silver(spark, ("s", "d1", "a", "2"), ("s", "d2", "c", "2")), root)
    assert (tmp_path / "silver/data/version=2").exists()
    assert state(spark, root) == before and U.current_version(spark, root) == 1
    L.write_silver(silver(spark, ("t", "d1", "b", "3")), root)
    assert state(spark, root) == [("s", "d1", "a", "1"), ("t", "d1", "b", "3")] and U.current_version(spark, root) == 2


def test_old_versions_are_dropped(spark, tmp_path):
    root = str(tmp_path / "silver")
    for i in range(4):
        L.write_silver(silver(spark, ("s", "d1", "a", str(i)), *([("t", "d1", "b", "0")] if i == 1 else [])), root)
    want = [("s", "d1", "a", "3"), ("t", "d1", "b", "0")]
    assert state(spark, root) == want
    assert U.drop_old_versions(spark, root, ["source", "dt"]) == 2
    assert state(spark, root) == want
    assert {p.name for p in (tmp_path / "silver/data").iterdir() if p.is_dir()} == {"version=2", "version=4"}


def test_silver_json_envelopes(spark, tmp_path):
    rows = silver(spark, ("s", "2026-05-09", "a", "1"))
    L.silver_envelope_json(rows).write.partitionBy("source", "dt").text(str(tmp_path / "silver"))
    for name, payload in (("x", {"layer": "silver", "article": {}}), ("y", {"layer": "silver"}), ("z", {"article": 5})):
        put(tmp_path, f"silver/source=s/dt=2026-05-09/{name}.json", payload)
    articles, broken = L.read_silver_envelopes(spark, str(tmp_path / "silver"))
    assert [(r.url, r.titre, r.dt) for r in articles.collect()] == [("a", "1", "2026-05-09")]
    assert broken.count() == 3


def test_upsert(spark):
    def table(**rows):
        return spark.createDataFrame(list(rows.items()), "k string, v int")

    def once(current):
        return upsert(current, table(b=3, c=4), ["k"])

    got = dict(map(tuple, once(table(a=1, b=2)).collect()))
    assert got == {"a": 1, "b": 3, "c": 4} == dict(map(tuple, once(once(table(a=1, b=2))).collect()))
    repeated = spark.createDataFrame([("b", 1, 2), ("b", 9, 3), ("b", 5, 1)], "k string, v int, o int")
    assert dict(map(tuple, upsert(table(a=1), repeated, ["k"], ["o"]).collect())) == {"a": 1, "b": 9}
    with pytest.raises(Exception, match="null key"):
        upsert(table(a=1), spark.createDataFrame([(None, 1)], "k string, v int"), ["k"]).collect()


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, o int, v string")
    assert sorted(map(tuple, latest_per_key(df, ["k"], ["o"]).collect())) == [("a", 3, "y"), ("b", 1, None)]
    assert sorted(map(tuple, latest_per_key(df.drop("v"), ["k"], ["o"]).collect())) == [("a", 3), ("b", 1)]


def test_latest_per_key_equals_brute_force(spark, monkeypatch):
    """One key with a third of the rows, null keys and orders, rows written twice."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else rng.choice([None, *map(str, range(150))])
        rows.append((key, rng.choice([None, "x", "y"]), f"file{rng.randrange(9)}", i, f"payload {i}"))
    rows += [rng.choice(rows) for _ in range(100)]
    want = {}
    for r in rows:
        place = (r[1] is not None, r[1] or "", r[2], r[3])
        if r[0] not in want or place > want[r[0]][0]:
            want[r[0]] = (place, r)
    df = spark.createDataFrame(rows, "k string, o string, f string, pos int, v string").repartition(5)
    for limit in (50_000, 0):
        monkeypatch.setattr(dedup, "BROADCAST_ROWS", limit)
        got = latest_per_key(df, ["k"], ["o", "f", "pos"])
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(r) for _, r in want.values())


def test_payload_is_in_no_sort(spark, tmp_path, monkeypatch):
    rows = [(f"u{i % 40}", i, "text " * 50) for i in range(200)]
    spark.createDataFrame(rows, "k string, o int, v string").write.parquet(str(tmp_path / "rows"))
    for limit in (50_000, 0):
        monkeypatch.setattr(dedup, "BROADCAST_ROWS", limit)
        last = latest_per_key(spark.read.parquet(str(tmp_path / "rows")), ["k"], ["o"])
        assert last.count() == 40
        plan = last._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan.replace("SortMergeJoin", "Sort")
