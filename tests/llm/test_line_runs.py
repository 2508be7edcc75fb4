"""Line deduplication against a reading of the rule and against its SQL."""

import hashlib
import random

import duckdb
import pytest

from newslake.llm import line_runs, queries

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(BLANKS).translate(LOWER)


def brute(rows, least=3, chars=20):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    last = {k: max((d for d in ids if d is not None), default=None) for k, ids in holders.items()}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < chars or len(holders[key(x)]) < least or last[key(x)] == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def table():
    rng = random.Random(2)
    common = [f"A common line of the page, number {i}" for i in range(12)] + ["É" * 20, "é" * 20, "short", "x" * 19, "x" * 20, "  padded line of text here\r"]
    rows = []
    for i in range(240):
        lines = [rng.choice(common) if rng.random() < 0.6 else f"own line {i} {j} of this very document" for j in range(rng.randrange(8))]
        rows.append((i, "\n".join(x.upper() if rng.random() < 0.2 and x.isascii() else x for x in lines)))
    rows += [(300 + i, "Every hot document holds this line\n" + ("own " * 9) + str(i)) for i in range(160)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "\x1cnot a blank of the rule" + "\n" + "tail line of twenty chars\n")]
    rows += [(7, rows[7][1]), (7, "\n".join(common)), (None, "\n".join(common)), (None, common[0]), (-4, "\n".join(common * 3))]
    rows.append((504, "\n".join(f"row {i % 700} of a long table of lines" for i in range(20_000))))
    rows += [(505, rows[-1][1]), (506, rows[-1][1])]
    return rows


@pytest.mark.parametrize("batches,least", [(4, 3), (1, 3), (6, 2)])
def test_lines_of_a_table(spark, work, batches, least):
    rows = table()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, pos string")
    got = line_runs.dedup_lines(docs, work, min_docs=least, batches=batches).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, least)


@pytest.mark.parametrize("lines", [12, 10**6])
def test_runs_are_compacted_and_dropped(spark, work, lines):
    runs = line_runs.LineRuns(spark, f"{work}/runs", lines, fan=2)
    before = len(spark.catalog.listTables())
    for top in (40, 30, 20, 10):
        rows = [(top - i, 1, 1) for i in range(2)] + [(top, 2, top)]
        runs.add(spark.createDataFrame(rows, "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert [(r.h1, r.h2, r.top) for r in runs.settled().collect()] == [(1, 1, 40)]
    # The third batch found its key settled by the first two; the fourth found it in the third's level only.
    assert runs.settled().first().n == 4
    runs.drop()
    assert len(spark.catalog.listTables()) == before


def test_plan_is_native(spark, work, documents):
    plan = line_runs.dedup_lines(documents, work)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark, documents, work):
    got = [tuple(r) for r in line_runs.dedup_lines(documents, work).collect()]
    assert sorted(got, key=str) == brute([(r.doc_id, r.text) for r in documents.collect()])
    assert line_runs.dedup_lines(documents.limit(0), f"{work}/empty").count() == 0


def test_query_and_sql(spark, work):
    rows = [r for r in table() if r[0] is not None and r[0] != 7]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{work}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op12_line_dedup(spark, work).collect())
    want = [(d, n, m, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, m in brute(rows)]
    assert got == sorted(want)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{work}/documents.parquet/*.parquet'")
    assert sorted(con.execute(queries.ORACLES["op12_line_dedup"]).fetchall()) == got
