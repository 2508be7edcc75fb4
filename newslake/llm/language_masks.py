"""Language identification with bit-sliced n-gram filters.

All languages share one table of ``2 ** BITS`` rows; a row holds one bit per language.
Adding an n-gram to a language's Bloom filter sets its bit in HASHES rows, so the bitwise
and of an n-gram's rows is the mask of all languages whose filter contains it: one
lookup asks all filters. A text's score per language is the number of its n-grams with
that bit, less the hits expected by chance from the filter's fill.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.words import U, cut, held_out, mix, text_buffers

BITS = 17
HASHES = 3
SIZES = (2, 3, 4)
#: An n-gram belongs to a language if this share of its sample documents has it.
MIN_SHARE = 0.05
MAX_TRAIN_ROWS = 3_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[*range(65), *range(91, 97), *range(123, 128)]] = True  # all of ASCII but letters


def grams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bounds, n-gram hashes) of whole documents, in text order with repeats.

    N-grams are runs of bytes of lower-cased words, all other ASCII being one mark between words.
    Runs of that mark alone, and runs over several marks in a row, say nothing and are left out.
    """
    raw, offsets = text_buffers(texts)
    for a, b in cut(offsets):
        own = offsets[a : b + 1] - offsets[a]
        part = _LOWER[raw[offsets[a] : offsets[b]]]
        if len(part) > 1:
            marked = (part[:-1] == 0xC3) & (part[1:] >= 0x80) & (part[1:] <= 0x9E) & (part[1:] != 0x97)
            part[1:][marked] += 32
        space = _SPACE[part]
        doc = np.repeat(np.arange(b - a, dtype=np.int64), np.diff(own))
        again = np.zeros(len(part), bool)
        again[1:] = space[1:] & space[:-1] & (doc[1:] == doc[:-1])
        letters = np.where(space, 32, part)[~again].astype(np.uint64)
        doc, space = doc[~again], space[~again]
        hashes, rows = [], []
        for size in SIZES:
            n = len(letters) - size + 1
            if n <= 0:
                continue
            gram = np.full(n, size, np.uint64)
            for i in range(size):
                gram = gram << U(8) | letters[i : i + n]
            keep = doc[:n] == doc[size - 1 :]
            hashes.append(mix(gram[keep]))
            rows.append(doc[:n][keep])
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        yield a, rows, hashes


def _rows_of(hashes: np.ndarray, bits: int = BITS) -> list[np.ndarray]:
    """Table rows of each hash: slices of one 64-bit value."""
    return [(hashes >> U(64 - bits * (k + 1)) & U((1 << bits) - 1)).astype(np.int64) for k in range(HASHES)]


class Masks:
    """The table (rows x words of 64 languages), its fill per language, and the names."""

    def __init__(self, table: np.ndarray, names: list[str], prior: int):
        self.table, self.names, self.prior = table, names, prior
        bits = np.unpackbits(table.view(np.uint8), axis=1, bitorder="little")[:, : len(names)] if len(names) else np.zeros((1, 0))
        self.chance = bits.mean(0) ** HASHES

    def hits(self, rows: np.ndarray, hashes: np.ndarray, docs: int) -> np.ndarray:
        """Per document and language: n-grams found, corrected for chance, as a share of all."""
        at = _rows_of(hashes)
        mask = self.table[at[0]]
        for k in range(1, HASHES):
            mask = mask & self.table[at[k]]
        total = np.maximum(np.bincount(rows, minlength=docs), 1)[:, None]
        found = np.empty((docs, len(self.names)))
        for i in range(len(self.names)):
            on = (mask[:, i // 64] >> U(i % 64) & U(1)).astype(bool)
            found[:, i] = np.bincount(rows[on], minlength=docs)
        return np.clip((found / total - self.chance) / np.maximum(1 - self.chance, 1e-9), 0, 1)


def train(docs: DataFrame, max_rows: int = MAX_TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Masks:
    """Filters from at most ``max_rows`` documents per language outside the held-out fold.

    The documents with the smallest hashes of their ids are taken. Per-document distinct
    n-grams are counted in Spark by language; those of MIN_SHARE of the language's documents
    enter its filter. Null languages and null ids teach nothing.
    """
    from pyspark.sql import Window

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = rows.filter("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL").filter(~held_out("doc_id"))
    # Ranked in parts of each language first: the last ranking sees at most max_rows of every part.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chosen = known.select("lang", "doc_id", F.pmod(F.hash("doc_id"), F.lit(parts)).alias("part"))
    for group in (["lang", "part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id"))
        chosen = chosen.withColumn("place", place).filter(F.col("place") <= max_rows)
    chosen = chosen.select("lang", "doc_id")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    taken = {lang: min(n, max_rows) for lang, n in sizes.items()}
    code = {lang: i for i, lang in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array([code[x] for x in batch.column(1).to_pylist()], np.int64)
            for first, row, hashes in grams(batch.column(0)):
                order = np.lexsort((hashes, row))
                row, hashes = row[order], hashes[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
                lang, hashes = langs[first + row[new]], hashes[new]
                order = np.lexsort((hashes, lang))
                lang, hashes = lang[order], hashes[order]
                head = np.flatnonzero(np.concatenate([[True], (lang[1:] != lang[:-1]) | (hashes[1:] != hashes[:-1])])) if len(lang) else np.zeros(0, np.int64)
                n = np.diff(np.append(head, len(lang)))
                yield pa.RecordBatch.from_arrays([pa.array(lang[head].astype(np.int32)), pa.array(hashes[head].view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    sample = known.join(F.broadcast(chosen), ["lang", "doc_id"]).select("text", "lang")
    # Two documents must agree on an n-gram, but for languages of which few were learnt.
    least = {x: max(2.0, MIN_SHARE * n) if n >= 2 / MIN_SHARE else 1.0 for x, n in taken.items()}
    need = F.element_at(F.array(*[F.lit(least[x]) for x in names]), F.col("lang") + 1) if names else F.lit(1.0)
    counted = sample.mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    own = counted.filter(F.col("n") >= need).select("lang", "gram").toArrow() if names else None
    width = max(1, -(-len(names) // 64))
    table = np.zeros((1 << BITS, width), np.uint64)
    if own is not None:
        lang, gram = own["lang"].to_numpy(), own["gram"].to_numpy().view(np.uint64)
        for at in _rows_of(gram):
            np.bitwise_or.at(table, (at, lang // 64), U(1) << (lang % 64).astype(np.uint64))
    prior = max(range(len(names)), key=lambda i: (sizes[names[i]], -i)) if names else 0
    return Masks(table, names, prior)


def tagged(docs: DataFrame, masks: Masks, name: str = "language", text_col: str = "text") -> DataFrame:
    """``docs`` with a struct (lang, score): the language with most corrected hits and its share of all.

    Texts that are null or hold no letter are ``und`` with score 0. If no n-gram is in any filter,
    or for equal scores, the more frequent language of the training rows comes first, then code-point
    order; without any training language all are ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((masks.table, masks.names, masks.prior))

    @F.arrow_udf("lang string, score double")
    def language(texts: pa.Array) -> pa.Array:
        own = Masks(*shared.value)
        best, score = np.full(len(texts), own.prior), np.zeros(len(texts))
        for first, rows, hashes in grams(texts):
            if not len(rows) or not own.names:
                continue
            docs_ = int(rows.max()) + 1
            hits = own.hits(rows, hashes, docs_)
            total = hits.sum(1)
            ranked = hits.copy()
            ranked[:, own.prior] += 1e-12
            best[first : first + docs_] = ranked.argmax(1)
            score[first : first + docs_] = np.where(total > 0, hits.max(1) / np.maximum(total, 1e-12), 0)
        names = pa.array([*own.names, "und"], pa.string())
        return pa.StructArray.from_arrays([names.take(pa.array(np.minimum(best, len(own.names)))), pa.array(np.clip(score, 0, 1))], names=["lang", "score"])

    # A letter is decided by Spark, in the scan: Java's \\p{L}.
    text = F.col(text_col).cast("string")
    lettered = F.coalesce(text.rlike("\\p{L}"), F.lit(False))
    guess = language(text)
    return docs.withColumn(name, guess).withColumn(
        name, F.struct(F.when(lettered, F.col(f"{name}.lang")).otherwise("und").alias("lang"), F.when(lettered, F.col(f"{name}.score")).otherwise(0.0).alias("score"))
    )
