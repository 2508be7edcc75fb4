"""Periodic runs against a reading of the definition, lag by lag."""

import hashlib
import random
import zlib

import pytest

from newslake.llm import periodic_runs, queries


def brute(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if length >= max(least, 2 * q):
                found.setdefault((s, length), q)
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def texts():
    rng = random.Random(7)
    out = [["a"] * 200, ["a"] * 11, ["a"] * 12, list("abcabc") * 9, fibonacci(400), [], ["x"]]
    out.append([str(bin(i).count("1") % 2) for i in range(512)])
    for letters in (2, 3, 5):
        out += [[rng.choice("abcde"[:letters]) for _ in range(rng.randrange(150))] for _ in range(60)]
    for _ in range(40):
        unit = [rng.choice("abcdefghij") for _ in range(rng.randrange(1, 40))]
        out.append([rng.choice("abc") for _ in range(30)] + (unit * 9)[: rng.randrange(10, 200)] + [rng.choice("abc") for _ in range(30)])
        nested = (["a"] * rng.randrange(3, 20) + unit[:3]) * rng.randrange(1, 6)
        out.append(nested + ["a"] * 9 + nested)
    return out


@pytest.mark.parametrize("least", [12, 2, 7])
def test_runs_of_all_texts(spark, least):
    rows = [(i, " \n".join(w)) for i, w in enumerate(texts())]
    got = {r.doc_id: r for r in periodic_runs.find_runs(spark.createDataFrame(rows, "doc_id long, text string"), least).collect()}
    for (i, _), words in zip(rows, texts()):
        want = brute(words, least)
        assert [tuple(r) for r in got[i].runs] == want, words
        assert got[i].n_words == len(words) and got[i].collapsed == collapsed(words, want)


def test_odd_rows(spark, documents):
    rows = periodic_runs.find_runs(documents).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(r.doc_id) for r in documents.collect())
    empty = [r for r in rows if r.doc_id in (4, 5, 8)]
    assert all((r.n_words, r.runs, r.collapsed) == (0, [], "") for r in empty)
    assert periodic_runs.find_runs(documents.limit(0)).count() == 0


def test_long_text_of_one_word(spark):
    rows = spark.createDataFrame([(1, "é " * 100_000), (2, "x" * 300_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.find_runs(rows).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 100_000, 1)] and got[1].collapsed == "é"
    assert got[2].runs == [] and got[2].collapsed == "x" * 300_000


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query(spark, work):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["one", "two", "three", "Ünü"]) for _ in range(rng.randrange(0, 90)))) for i in range(150)]
    rows += [(None, "one " * 20), (200, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{work}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc, text in rows:
        words = (text or "").split()
        words = words if doc is None else planted(doc, words)
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        milli = (1000 * best[1] // best[2],) if best else (None,)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        want.append((doc, len(runs), *(best or (None,) * 3), *milli, sha(lines), sha(collapsed(words, runs))))
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, work).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
