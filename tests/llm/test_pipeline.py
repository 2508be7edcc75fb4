"""The pipeline's stages row by row: null and repeated ids, exact draws, empty tables, and a whole run."""

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from newslake.llm import cube_mix
from newslake.llm.row_keys import with_row_keys

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"
WORDS = [f"w{i}" for i in range(3000)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], COLUMNS)


def stored(spark, rows, path):
    table(spark, rows).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def seen(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def test_row_keys_are_unique_and_repeat(spark, work):
    rows = [(i % 7, "same", None) for i in range(60)] + [(None, None, "s")] * 9
    docs = stored(spark, rows, f"{work}/docs")
    first, again = ({(r._row, r.doc_id) for r in with_row_keys(docs, f"{work}/{k}").collect()} for k in "ab")
    assert len(first) == 69 == len({k for k, _ in first}) and first == again
    made = with_row_keys(table(spark, rows), f"{work}/c")
    assert made.select("_row").distinct().count() == 69 and made.columns == [*docs.columns, "_row"]
    assert with_row_keys(docs.limit(0), f"{work}/d").count() == 0


@pytest.mark.parametrize("files", [True, False])
def test_one_of_each_group_of_copies(spark, work, files):
    a, b, c = prose(1, 120), prose(2, 90), prose(3, 60)
    near = a.replace(a.split()[60], "changed", 1)
    rows = [(5, a, "s"), (3, near, "s"), (3, near, "s"), (None, a, "t"), (3, b, "s"), (None, c, "u"), (None, c, "u"), (9, "", "s"), (9, "", "s"), (8, None, None), (None, None, None)]
    docs = stored(spark, rows, f"{work}/docs") if files else table(spark, rows)
    got = seen(P.keep_one_of_near_copies(spark, docs, ""))
    want = Counter([(3, near, "s"), (3, b, "s"), (None, c, "u"), (9, "", "s"), (9, "", "s"), (8, None, None), (None, None, None)])
    assert got == want


def test_contaminated_rows_go_whatever_their_id(spark, work):
    item = prose(7, 40)
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{work}/benchmark.parquet")
    bad, clean = f"{prose(8, 50)} {item} {prose(9, 20)}", prose(10, 80)
    rows = [(1, bad, "s"), (1, clean, "s"), (None, bad, "s"), (None, clean, "s"), (2, "", "s"), (3, None, None), (4, bad.upper(), "s")]
    got = seen(P.drop_contaminated(spark, stored(spark, rows, f"{work}/docs"), work))
    assert got == Counter([(1, clean, "s"), (None, clean, "s"), (2, "", "s"), (3, None, None)])


def test_mix_delivers_the_words_it_counted(spark, work):
    rng = random.Random(4)
    rows = [(None if i % 2 else i // 6, prose(i, rng.randrange(1, 60)), ["a", "b", None][i % 3]) for i in range(900)]
    rows += [(1, None, "a"), (2, "", "b"), (None, " \n", None)]
    docs = stored(spark, rows, f"{work}/docs")
    got = P.mix_to_targets(spark, docs, "").withColumn("size", cube_mix.word_count(F.col("text")))
    words = {r.source: r.n for r in got.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    sizes = docs.select("source", cube_mix.word_count(F.col("text")).alias("size"))
    for r in cube_mix.targets(sizes).collect():
        assert abs(words[r.source] - r.target) <= 0.01 * r.target
    most, inputs = seen(got), seen(docs)
    assert all(n <= 3 * inputs[k] for k, n in most.items())


def folder(spark, work, rows, labels, items):
    table(spark, rows).repartition(3).write.parquet(f"{work}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{work}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{work}/benchmark.parquet")


def test_whole_run(spark, work):
    junk = lambda i: " ".join(random.Random(i).choices(["BUY", "$$$", "###", "click"], k=60))
    good = [(i, prose(i, 100 + i % 37), "ab"[i % 2]) for i in range(200)]
    bad = [(1000 + i, junk(i), "a") for i in range(60)]
    item = prose(5000, 40)
    leaked = [(2000 + i, f"{prose(6000 + i, 60)} {item}", "b") for i in range(5)]
    copies = [(3000 + i, good[i][1], "b") for i in range(20)] + [(None, good[0][1], "a")]
    folder(spark, work, good + bad + leaked + copies, [(i, 1, 0) for i, _, _ in good] + [(i, 0, 0) for i, _, _ in bad], [(1, item)])
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in P.run(spark, work).collect())
    kept = {i for _, i, _ in got}
    texts = dict((i, t) for i, t, _ in good)
    assert kept <= set(texts) and len(kept) > 100
    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for start, doc, n in got:
        assert start == at and n == len(tokenizer.encode(texts[doc], add_special_tokens=False).ids) + 1
        at += n
    assert [i for _, i, _ in got] == sorted(i for _, i, _ in got)


def test_empty_tables(spark, work):
    folder(spark, work, [], [], [])
    assert P.run(spark, work).collect() == []
    docs = spark.read.parquet(f"{work}/documents.parquet")
    for _, stage in P.STAGES:
        assert stage(spark, docs, work).count() == 0
