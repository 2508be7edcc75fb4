"""Targets against a direct resharing, balance and whole results of the sampling."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslake.llm import cube_mix as C


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def reshared(sizes):
    """Cap, then share the excess by weight again until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: C.WEIGHTS[i % 3] for i, s in enumerate(names)}
    capped, total = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped.update({s: 3.0 * sizes[s] for s in over})


def test_odd_rows(documents, work):
    got = C.mix_sources(documents, work).collect()
    rows = documents.collect()
    assert sorted([(r.doc_id, r.size) for r in got], key=str) == sorted([(r.doc_id, words(r.text)) for r in rows], key=str)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += words(r.text)
    want = reshared(sizes)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.repeats * r.size


@pytest.mark.parametrize("block_rows", [50, 10**6])
def test_each_source_comes_near_its_target(spark, work, block_rows):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.pareto(1.2) * 20 + 1), "s" + str(min(int(rng.exponential(2)), 6))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    mix = C.mix_sources(docs, f"{work}/1", block_rows=block_rows)
    per = mix.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("top")).collect()
    for r in per:
        assert abs(r.taken - r.target) <= max(20, 0.01 * r.target)
    again = C.mix_sources(docs.repartition(7), f"{work}/2", block_rows=block_rows)
    key = lambda df: sorted((r.doc_id, r.taken) for r in df.collect())
    assert key(mix) == key(again) and len(key(mix)) == 3000


def test_flight_keeps_totals_and_leaves_few_open():
    rng = np.random.default_rng(0)
    p, size = rng.random(500), rng.integers(0, 900, 500).astype(float)
    a = np.column_stack([np.ones(500), size])
    q = C.flight(p, a)
    assert np.allclose(p @ a, q @ a) and ((q > 0) & (q < 1)).sum() <= 2
    same = C.flight(np.full(9, 0.5), np.column_stack([np.ones(9), np.full(9, 4.0)]))
    assert ((same > 0) & (same < 1)).sum() <= 2


def test_empty_table(documents, work):
    assert C.mix_sources(documents.limit(0), work).count() == 0
