import random

import pytest
from pyspark.sql import functions as F

from articles import LONG, raw
from newslake import scratch
from newslake.plans.silver import (
    HTTP_URL, accepted, judge, normalize, rejected, rejects_by_reason, silver_counters, to_silver,
)


def verdicts(df):
    return {(r.bronze_key, r.pos): r.errors for r in df.collect()}


def errors(spark, **changes):
    return judge(raw(spark, ("k", 0, changes)), "d").first().errors


def test_content_boundary(spark):
    assert errors(spark, contenu="x" * 100) == ["contenu trop court"]
    assert errors(spark, contenu="x" * 101) == []
    assert errors(spark, contenu="<b>" + "x" * 99 + "</b>   y") == []
    assert errors(spark, contenu="x" * 50 + " " * 60) == ["contenu trop court"]


def test_all_errors_in_rule_order(spark):
    got = errors(spark, titre=" <b></b> ", date_publication=" ", contenu="court", url="ftp://x")
    assert got == ["titre vide", "date manquante", "contenu trop court", "url invalide"]


def test_missing_url_comes_before_everything(spark):
    for url in ("", " \xa0", None):
        assert errors(spark, url=url, titre=None) == ["url manquante"]


def test_url_rule(spark):
    cases = [
        ("https://a.b/c", True), ("HTTP://a.b", True), (" https://a.b/c ", True), ("http://ab", True),
        ("https:// a.b", False), ("https://a.b/ c", False), ("https://.a", False), ("http://a", False),
        # The rule lets the second character of the host be anything.
        ("https://a b", True), ("https://ab c", False), ("mailto:a@b", False), ("//a.b/c", False),
    ]
    df = raw(spark, *[("k", i, {"url": url}) for i, (url, _) in enumerate(cases)])
    got = normalize(df, "d").select("pos", F.col("url").rlike(HTTP_URL).alias("ok")).orderBy("pos")
    assert [r.ok for r in got.collect()] == [ok for _, ok in cases]
    assert errors(spark, url="mailto:a@b") == ["url invalide"]


def test_normalized_fields(spark):
    row = normalize(
        raw(spark, ("k", 0, {
            "titre": "<p>a</p>\xa0\tb", "categorie": " x\n y ", "auteur": " ", "source": "", "url": " u ",
            "date_publication": " brut ",
        })), "defaut", stamp="s",
    ).first()
    assert (row.titre, row.categorie, row.auteur, row.source, row.url) == ("a b", "x y", None, "defaut", "u")
    assert (row.date_publication, row.normalized_at) == (" brut ", "s")
    assert normalize(raw(spark, ("k", 0, {"categorie": None})), "d").first().categorie is None


def test_invalid_first_copy_does_not_block_a_valid_one(spark):
    df = raw(
        spark, ("a", 0, {"date_publication": None}), ("a", 1, {}), ("b", 0, {}), ("b", 1, {"titre": ""}),
    )
    want = {("a", 0): ["date manquante"], ("a", 1): [], ("b", 0): ["doublon url"], ("b", 1): ["doublon url"]}
    assert verdicts(judge(df, "d")) == want


def test_padded_urls_are_one_url(spark):
    df = raw(spark, ("a", 0, {"url": " https://a.b/c "}), ("b", 0, {}))
    assert verdicts(judge(df, "d")) == {("a", 0): [], ("b", 0): ["doublon url"]}


def test_rows_without_url_are_no_duplicates(spark):
    df = raw(spark, ("a", 0, {"url": ""}), ("b", 0, {"url": ""}))
    assert verdicts(judge(df, "d")) == {("a", 0): ["url manquante"], ("b", 0): ["url manquante"]}


def brute_force(rows):
    """The rule read row by row, in (key, pos) order."""
    seen, out = set(), {}
    for key, pos, changes in sorted(rows, key=lambda r: r[:2]):
        url = changes.get("url", "https://a.b/c").strip()
        own = [] if changes.get("titre", "x") else ["titre vide"]
        if url in seen:
            out[key, pos] = ["doublon url"]
        else:
            out[key, pos] = own
            if not own:
                seen.add(url)
    return out


@pytest.mark.parametrize("parts", [1, 3, None])
def test_dedup_equals_brute_force_with_one_dominant_url(spark, tmp_path, parts):
    rng = random.Random(parts)
    rows = []
    for i in range(400):
        url = "https://hot.example/x" if i % 3 == 0 else f"https://a.b/{rng.randrange(120)}"
        rows.append((f"k{rng.randrange(40):02d}", i, {"url": url, "titre": rng.choice(["", "t"])}))
    rng.shuffle(rows)
    want = brute_force(rows)
    df = raw(spark, *rows).repartition(7)
    assert verdicts(judge(df, "d", parts=parts, work_dir=str(tmp_path))) == want


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_repeated_keys_are_found_without_sorting_texts(spark, tmp_path):
    rows = [(f"k{i:03d}", i, {"url": "https://hot.example/x" if i % 3 == 0 else f"https://a.b/{i}"}) for i in range(300)]
    plans = []
    plain = scratch.stored

    def watched(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, path)

    scratch.stored = watched
    try:
        judged = judge(raw(spark, *rows), "d", work_dir=str(tmp_path))
    finally:
        scratch.stored = plain
    plans.append(executed(judged))
    assert not any("SortAggregate" in p for p in plans)
    # The texts are cleaned once and stored; no later plan touches them but the last, which does not sort.
    assert [("contenu" in p) for p in plans] == [True, False, False, False, True]
    assert "Sort " not in plans[-1] and "Exchange hashpartitioning" not in plans[-1]


def test_rows_without_url_stay_where_they_are(spark, tmp_path):
    """A third of the rows has no url; they are in no shuffle by key and stay evenly spread."""
    rows = [(f"k{i:04d}", i, {"url": "" if i % 3 else f"https://a.b/{i % 50}"}) for i in range(600)]
    judged = judge(raw(spark, *rows).repartition(6), "d", work_dir=str(tmp_path))
    sizes = [r["count"] for r in judged.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 2 * 600 / len(sizes)
    stored = spark.read.parquet(f"{tmp_path}/copies")
    assert stored.where("_key = '' OR _key IS NULL").isEmpty()


def test_accepted_and_rejected_cover_the_input(spark):
    df = raw(spark, ("a", 0, {}), ("a", 1, {}), ("a", 2, {"url": "x", "contenu": "y"}))
    good, bad = to_silver(df, "d", stamp="s")
    assert good.count() == 1 and bad.count() == 2
    assert good.first().contenu == LONG and good.first().ingested_at == "s"
    judged = judge(df, "d")
    assert tuple(silver_counters(judged).first()) == (3, 2, 1)
    assert [tuple(r) for r in rejects_by_reason(rejected(judged)).collect()] == [
        ("contenu trop court", 1), ("doublon url", 1), ("url invalide", 1),
    ]
    assert accepted(judged).count() == 1
