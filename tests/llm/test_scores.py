"""Classifiers and language masks: held-out accuracy on separable rows, and odd rows."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newslake.llm import language_masks, quality_nbsvm, toxicity
from newslake.llm.words import held_out

CLEAN = "the river runs past a quiet village where people grow apples and keep bees in summer".split()
BAD = "vile idiot scum hateful trash moron".split()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        sentences = [" ".join(rng.choices(CLEAN, k=9)) for _ in range(6)]
        if i % 3 == 0:
            sentences[rng.randrange(6)] = " ".join(rng.choices(CLEAN, k=4) + rng.choices(BAD, k=4))
        rows.append((i, ". ".join(sentences) + ".", int(i % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, y int")
    labels = df.select("doc_id", F.col("y").alias("quality"), F.col("y").alias("toxic")).union(
        spark.createDataFrame([(None, 1, 1), (3, 7, None), (999_999, 0, 0)], "doc_id long, quality int, toxic int"))
    return df, labels


def accuracy(df, score):
    rows = df.filter(held_out()).select("y", score.alias("s")).collect()
    return sum((r.s >= 0.5) == bool(r.y) for r in rows) / len(rows)


def odd(df, score, documents):
    rows = df.select("doc_id", "text", score.alias("s")).collect()
    assert len(rows) == documents.count() and all(0 <= r.s <= 1 for r in rows)
    same = {}
    for r in rows:
        assert same.setdefault(r.text or "", r.s) == r.s
    return same


def test_quality(labelled, documents):
    docs, labels = labelled
    model = quality_nbsvm.train(docs, labels)
    assert accuracy(quality_nbsvm.scored(docs, model), F.col("score")) > 0.95
    odd(quality_nbsvm.scored(documents, model), F.col("score"), documents)
    assert quality_nbsvm.scored(documents.limit(0), model).count() == 0


def test_quality_without_labels(labelled, documents):
    docs, labels = labelled
    model = quality_nbsvm.train(docs.limit(0), labels.limit(0))
    odd(quality_nbsvm.scored(documents, model), F.col("score"), documents)


def test_toxicity_finds_documents_and_sentences(labelled, documents, work):
    docs, labels = labelled
    model = toxicity.train(docs, labels, work)
    rows = toxicity.scored(docs, model)
    assert accuracy(rows, F.col("toxicity.score")) > 0.95
    for r in rows.filter(held_out()).filter("y = 1").select("text", "toxicity.spans").collect():
        assert any(w in r.text[s.start : s.end] for s in r.spans for w in BAD)
    same = odd(toxicity.scored(documents, model), F.col("toxicity.score"), documents)
    assert same[""] == 0


def test_toxicity_without_labels(labelled, documents, work):
    docs, labels = labelled
    model = toxicity.train(docs.limit(0), labels.limit(0), work)
    odd(toxicity.scored(documents, model), F.col("toxicity.score"), documents)


def test_language(spark, documents):
    rng = random.Random(2)
    words = {"en": CLEAN, "fr": "le village où les gens gardent des abeilles pendant que la rivière coule".split(), "de": "das Dorf wo Leute Äpfel züchten und im Sommer Bienen halten".split()}
    rows = [(i, " ".join(rng.choices(words[lang], k=20)), lang) for i, lang in enumerate(list(words) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    masks = language_masks.train(docs)
    got = language_masks.tagged(docs, masks).filter(held_out()).select("lang", "language.lang").collect()
    assert sum(a == b for a, b in got) / len(got) > 0.95
    tagged = language_masks.tagged(documents, masks).select("text", F.col("language.lang").alias("l"), F.col("language.score").alias("s")).collect()
    assert len(tagged) == documents.count()
    for r in tagged:
        assert 0 <= r.s <= 1 and (r.l == "und") == (not any(c.isalpha() for c in r.text or ""))
    none = language_masks.tagged(documents, language_masks.train(docs.limit(0))).select("language.lang").distinct().collect()
    assert [r.lang for r in none] == ["und"]


def test_one_document_teaches_a_language(spark):
    rows = [(i, " ".join(random.Random(i).choices(CLEAN, k=20)), "en") for i in range(60)]
    lone = next(i for i in range(100, 200) if spark.range(i, i + 1).select(~held_out("id")).first()[0])
    rows.append((lone, "kieli on vanha ja kylä on pieni mutta joki juoksee", "fi"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_masks.tagged(docs, language_masks.train(docs)).filter(F.col("doc_id") == lone).select("language.*").first()
    assert got.lang == "fi" and got.score > 0


def slots(text):
    return [set(p.slot[p.sentence == k].tolist()) for p in toxicity.sentences(pa.array([text])) for k in range(len(p.doc_of))]


def test_whole_words_and_unspaced_scripts():
    """Every byte of a word takes part, and scripts without blanks have pieces and sentence ends."""
    assert slots("a" * 40 + "x") != slots("a" * 40 + "y")
    assert slots("a" * 40 + "x") == slots("A" * 40 + "X")
    five = slots("これは文です。次の文です！三つ目？四番目。最後")
    assert len(five) == 5 and all(len(s) > 2 for s in five)
    assert len(slots("वाक्य एक। वाक्य दो।")) == 2
    # The same run of characters gives the same pieces wherever it stands.
    near, far = slots("悪い言葉")[0], slots("これは長い文の中にある悪い言葉")[0]
    assert len(near & far) >= 2


def test_scores_by_hand(labelled, work, spark):
    """A document's score is one less the product of its sentences' chances of being clean."""
    docs, labels = labelled
    weights, bias = toxicity.train(docs, labels, work)
    for r in toxicity.scored(docs.filter("doc_id < 40"), (weights, bias)).select("text", "toxicity.score").collect():
        margins = [bias + sum(weights[s] for s in own) for own in slots(r.text)]
        clean = 1.0
        for m in margins:
            clean *= 1 - 1 / (1 + math.exp(-m))
        assert math.isclose(r.score, 1 - clean, rel_tol=1e-6, abs_tol=1e-9)


def test_training_holds_no_second_copy_of_the_rows():
    """The driver's memory beside the rows stays below their size; values are those of the scaled, normed rows."""
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, quality_nbsvm.SLOTS, 2000)).astype(np.int32) for _ in range(4000)]
    y = np.arange(len(rows)) % 3 // 2
    tracemalloc.start()
    quality_nbsvm.fit(rows, y, quality_nbsvm.SLOTS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(r.nbytes for r in rows)
    scale = rng.normal(size=quality_nbsvm.SLOTS)
    values = quality_nbsvm.Scaled(rows[:9], scale)
    assert all(np.array_equal(values[i], scale[r] / np.sqrt((scale[r] ** 2).sum())) for i, r in enumerate(rows[:9]))
