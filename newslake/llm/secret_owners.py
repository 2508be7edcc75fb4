"""Secret candidates judged by who else holds them.

Each candidate is known by a hash of its value. Over the whole corpus the hash is counted
by distinct owners and repositories: a value that many owners copied is an example from
documentation; one that a single owner holds, in one place or in many, looks live. Values of a
general shape (long, mixed, high entropy) become spans only on that evidence.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake import scratch
from newslake.llm.words import cut, text_buffers

KINDS = ("assign", "access", "hex", "key")
# Fixed patterns of the base kinds.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEADS = (b"password", b"passwd", b"secret", b"token", b"api")
LEAST = {"assign": 8, "access": 16, "hex": 32, "key": 20}
KEY_ENTROPY = 3.5
MAX_OWNERS = 1

_HEX, _KEY = np.zeros(256, bool), np.zeros(256, bool)
_HEX[[*b"0123456789abcdef"]] = True
_KEY[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True
_TO_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def long_runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs within documents, of ``least`` bytes or more."""
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = offsets[:-1][offsets[:-1] < len(inside)]
    before[edge] = False
    after[edge[edge > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def _all(body: bytes, head: bytes) -> Iterator[int]:
    at = body.find(head)
    while at >= 0:
        yield at
        at = body.find(head, at + 1)


def entropy(value: bytes) -> float:
    """Shannon entropy in bits per byte."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def find_candidates(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, bytes]]:
    """(document, kind, start, end, value) in bytes of the piece; base kinds as their patterns match.

    Patterns are tried where their fixed heads occur, from the left, and never inside the
    match before; that gives the leftmost non-overlapping matches. Too short ones still
    consume their text.
    """
    body = raw.tobytes()
    lower = body.translate(_TO_LOWER)
    found = []

    def matches(kind: int, pattern, heads: list[int], least: int, group: int) -> None:
        taken = 0
        for at in heads:
            doc = int(np.searchsorted(offsets, at, "right")) - 1
            if at >= taken and (m := pattern.match(body, at, int(offsets[doc + 1]))):
                taken = m.end()
                if len(m[group]) >= least:
                    found.append((doc, kind, m.start(), m.end(), m[group]))

    matches(0, ASSIGN, sorted(at for head in _HEADS for at in _all(lower, head)), LEAST["assign"], 2)
    matches(1, ACCESS, list(_all(body, b"AKIA")), LEAST["access"], 0)
    for kind, inside in ((2, _HEX[raw]), (3, _KEY[raw])):
        for a, b in zip(*long_runs(inside, offsets, LEAST[KINDS[kind]])):
            value = body[a:b]
            if kind == 3 and not (re.search(rb"[0-9]", value) and re.search(rb"[a-z]", value) and re.search(rb"[A-Z]", value) and entropy(value) >= KEY_ENTROPY):
                continue
            found.append((int(np.searchsorted(offsets, a, "right")) - 1, kind, int(a), int(b), value))
    base = sorted((x[2], x[3]) for x in found if x[1] < 3)
    begins = [a for a, _ in base]
    reach = list(itertools.accumulate((b for _, b in base), max))

    def overlaps(start: int, end: int) -> bool:
        """Whether a base span that begins before ``end`` reaches beyond ``start``."""
        n = bisect.bisect_left(begins, end)
        return n > 0 and reach[n - 1] > start

    return sorted(x for x in found if x[1] < 3 or not overlaps(x[2], x[3]))


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.binary())])
_ROW = pa.schema([("doc_id", pa.int64()), ("owner", pa.string()), ("repository", pa.string()), ("base", pa.string()), ("found", pa.list_(_SPAN))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_buffers(batch.column(3))
        found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        for a, b in cut(offsets):
            own = offsets[a : b + 1] - offsets[a]
            part = raw[offsets[a] : offsets[b]]
            points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
            for doc, kind, start, end, value in find_candidates(part, own):
                first, last = (int(points[x] - points[own[doc]]) for x in (start, end))
                found[a + doc].append({"kind": kind, "start": first, "end": last, "value": hashlib.blake2b(value, digest_size=16).digest()})
        base = [spans_text([(s["kind"], s["start"], s["end"]) for s in row if s["kind"] < 3]) for row in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(base, pa.string()), pa.array(found, pa.list_(_SPAN))], schema=_ROW
        )


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end by start, then kind as listed, joined by commas."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2])))


def find_secrets(
    docs: DataFrame, work: str, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id",
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans, found) of every row.

    ``found`` lists (kind, start, end, owners, repositories, live) of all candidates in code
    points; ``spans`` is the text of the base spans and of the general ones that look live: held
    by at most ``max_owners`` owners, in however many repositories of theirs. A null owner
    or repository counts as one of its own. Null and empty texts have no spans; repeated rows
    keep one result each and count as one repository.

    Counts are combined in the map tasks and first by (value, owner, repository), so a value
    in a third of all documents is spread; its verdict reaches them by a join that can be split.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[
        F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(n) for n, c in (("owner", owner_col), ("repository", repository_col))
    ], text(text_col).alias("text"))
    schema = "doc_id long, owner string, repository string, base string, found array<struct<kind: int, start: long, end: long, value: binary>>"
    scanned = scratch.stored(rows.mapInArrow(_scan, schema).withColumn("row", F.monotonically_increasing_id()), f"{work}/candidates")

    each = scanned.filter("size(found) > 0").select("row", "owner", "repository", F.explode("found").alias("c")).select("row", "owner", "repository", "c.*")
    verdicts = (
        each.groupBy("value", "owner", "repository").agg(F.lit(1).alias("one"))
        .groupBy("value", "owner").agg(F.count("*").alias("n"))
        .groupBy("value").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    )
    live = F.col("owners") <= max_owners
    span = F.struct("start", "kind", "end", "owners", "repositories", live.alias("live"))
    judged = each.join(verdicts, "value").groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("judged"))
    told = scanned.drop("owner", "repository", "found").join(judged, "row", "left")
    shown = F.filter("judged", lambda s: (s["kind"] < 3) | s["live"])
    names = F.array(*map(F.lit, KINDS))
    label = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    count = lambda k: F.coalesce(F.size(F.filter("judged", lambda s: s["kind"] == k)), F.lit(0))
    none = F.col("judged").isNull()
    return told.select(
        "doc_id", *[F.when(none, 0).otherwise(count(k)).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)], "base",
        F.when(none, "").otherwise(F.array_join(F.transform(shown, label), ",")).alias("spans"), F.col("judged").alias("found"),
    )
