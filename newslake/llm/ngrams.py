"""Hashed byte n-grams of whole texts, and samples of labelled rows to fit on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.words import U, cut, held_out, mix, text_buffers


def distinct_ngrams(texts: pa.Array, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row of each entry, slot of each entry) for whole documents, in pieces.

    Each document has each slot once, in ascending order. N-grams are runs of UTF-8 bytes
    within one document; their hash is cut to ``bits``.
    """
    raw, offsets = text_buffers(texts)
    for a, b in cut(offsets):
        own = offsets[a : b + 1] - offsets[a]
        part = raw[offsets[a] : offsets[b]].astype(np.uint64)
        rows = np.repeat(np.arange(b - a, dtype=np.uint64) << U(32), np.diff(own))
        keys = []
        for size in sizes:
            n = len(part) - size + 1
            if n <= 0:
                continue
            gram = np.full(n, size, np.uint64)
            for i in range(size):
                gram = gram << U(8) | part[i : i + n]
            inside = rows[:n] == rows[size - 1 :]
            keys.append((mix(gram) >> U(64 - bits) | rows[:n])[inside])
        keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
        yield a, (keys >> U(32)).astype(np.int64), (keys & U(0xFFFFFFFF)).astype(np.int64)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, y) of at most ``max_rows`` labelled documents outside the held-out fold.

    The rows with the smallest hashes of their ids, so the choice does not hang on the
    layout of the table. Labels other than 0 and 1 are left out; a document labelled
    both ways takes the more frequent label, 1 if even. The chosen ids are bounded by
    ``max_rows`` and are sent to the scan, which shuffles no text of other rows. Of several
    texts under one id the smallest is taken.
    """
    key = F.col(id_col).cast("long")
    chosen = (
        labels.select(key.alias("_id"), F.col(label).cast("int").alias("_y")).filter("_id IS NOT NULL AND _y IN (0, 1)")
        .filter(~held_out("_id")).groupBy("_id").agg((F.avg("_y") >= 0.5).cast("int").alias("y"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    )
    texts = docs.select(key.alias("_id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("y").alias("y"))
    return found.select(F.col("_id").alias("doc_id"), "text", "y")
