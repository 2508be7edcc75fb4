"""The join against all pairs, on odd rows and on planted families of copies."""

import random
import re

import numpy as np
import pytest

from newslake.llm import jaccard_join as J
from newslake.llm.components import components

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[k]) - both):
                parent[find(i)] = find(k)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted([(doc, len(sets[i]), low.get(find(i))) for i, (doc, _) in enumerate(rows)], key=str)


def result(df, work):
    return sorted([tuple(r) for r in J.shingle_components(df, work).collect()], key=str)


def test_odd_rows(documents, work):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(documents, work) == brute(rows)


@pytest.mark.parametrize("seed,edits", [(1, 3), (2, 8), (3, 14)])
def test_families_of_near_copies(spark, work, seed, edits):
    rng = random.Random(seed)
    rows = []
    passage = [f"p{i}" for i in range(60)]
    for family in range(12):
        base = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.randrange(40, 300))] + (passage if family % 2 else [])
        for _ in range(rng.randrange(1, 15)):
            own = list(base)
            for _ in range(rng.randrange(edits)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(df, work) == brute(rows)


def test_empty_table(documents, work):
    assert result(documents.limit(0), work) == []


def test_parity_bits_never_exceed_the_difference():
    rng = np.random.default_rng(0)
    for n in (5, 60, 700):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.unique(np.concatenate([a[n // 5 :], rng.integers(0, 2**63, n // 6).astype(np.uint64)]))
        x, y = J.parity_bits(np.unique(a)).view(np.uint64), J.parity_bits(b).view(np.uint64)
        if len(x) > len(y):
            x = x[: len(y)] ^ x[len(y) :]
        if len(y) > len(x):
            y = y[: len(x)] ^ y[len(x) :]
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_prefix_lemma_on_sizes():
    for size in range(1, 400):
        assert J.least_overlap(size) == -(-3 * size // 4) and J.least_overlap_as_shorter(size) >= J.least_overlap(size)


def test_components_of_chains_loops_and_hubs(spark, work):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (3, 2), (2, 3)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long"), work).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_slots_tell_row_keys_apart(spark):
    """Keys made of a file and a place fill the filter like plain numbers; the tasks read the slots that were set."""
    keys = [(f << 40) + p for f in range(1, 9) for p in range(500)] + [0, 7, -5, (1 << 62) + 3]
    on = J._slots(spark.createDataFrame([(k,) for k in keys], "id long"))
    assert on.sum() > 0.95 * len(keys)
    value = np.array(keys)
    assert on[((value & J._LOW) + (value >> J._LOW_BITS) * J._STRIDE) & (len(on) - 1)].all()


def test_members_too_far_apart_are_not_paired(spark, work, monkeypatch):
    """Sets that share the passage of a large group but differ too much meet none of its members; the links stay."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(149)]
    rows = []
    for edits in [1] * 60 + [5, 6] * 15:
        own = list(base)
        for at in rng.sample(range(4, 145, 6), edits):
            own[at] = f"x{len(rows)}y{at}"
        rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    counts, stored = {}, J.scratch.stored

    def counted(df, path):
        out = stored(df, path)
        counts[path.rpartition("/")[2]] = out.count()
        return out

    monkeypatch.setattr(J.scratch, "stored", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(df, work) == brute(rows)
    assert counts["pairs"] < len(rows)


def test_pairs_meet_on_few_shared_shingles(spark):
    """Two groups that share whole prefixes: a pair meets on its first shingles only; one that shares too few does not meet."""
    same = [(t, sid, 100, t, 4) for sid in range(20) for t in range(30)]
    few = [(1000 + t, sid, 100, t, 4) for sid in (20, 21) for t in range(3)]
    met = spark.createDataFrame(same + few, "token long, sid long, size int, pos int, matches byte")
    parts = spark.createDataFrame([(sid, sid % 2) for sid in range(20)], "sid long, component long")
    apart = J._apart(met, parts)
    assert J._shared_entries(apart).count() == 100 * 4
    pairs = {frozenset(r) for r in J._candidates(apart).collect()}
    assert pairs == {frozenset((a, b)) for a in range(0, 20, 2) for b in range(1, 20, 2)}


def test_stored_leaves_no_shuffle_files(spark, work):
    import time

    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for i in range(held.size()) if "shuffle_" in (n := held.apply(i).getName())}

    before, conf = files(), spark.conf.get(J.scratch._CLEANUP, None)
    df = spark.range(10_000).repartition(7, "id")
    rows = J.scratch.stored(df, f"{work}/x")
    late = time.time() + 20
    while left := files() - before:
        assert time.time() < late, left
        time.sleep(0.2)
    assert rows.count() == df.count() == 10_000 and spark.conf.get(J.scratch._CLEANUP, None) == conf
