"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact check.

For each item length ``n`` (in words), windows of ``n`` words (shorter documents: all they have) get a 64-bit SimHash of
their weighted 5-word shingles. Fingerprints are cut into eight blocks of eight bits.
Two fingerprints within 23 bits differ by at most two bits in some block, so looking up
each block of a window in tables that list every item within two bits of that block's
value returns all items within the radius. Candidates are then compared exactly: sum of
smaller over sum of larger shingle weights, weights being occurrences.

Windows without any shingle of the benchmark have similarity zero to every item and
are not fingerprinted; this loses nothing and keeps the work to the text plus the hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.words import SHINGLE_WORDS, U, pieces, sequence_hash, sequence_hashes, shingles, window_hashes

BLOCKS = 8
BLOCK_DISTANCE = 2
RADIUS = BLOCKS * (BLOCK_DISTANCE + 1) - 1
#: Items held by a task at once; larger benchmarks go through the documents in further blocks.
ITEMS_AT_ONCE = 20_000
_FILTER_BITS = 22

_NEAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= BLOCK_DISTANCE


def simhash(values: np.ndarray, weights: np.ndarray | None = None) -> np.uint64:
    """Bit i is set where the weights of the shingles with that bit exceed those without."""
    bits = (values[:, None] >> np.arange(64, dtype=np.uint64) & U(1)).astype(np.int32) * 2 - 1
    total = (bits * (1 if weights is None else weights[:, None])).sum(0)
    return np.packbits(total > 0, bitorder="little").view(np.uint64)[0]


def window_simhashes(values: np.ndarray, width: int) -> np.ndarray:
    """SimHash of every run of ``width`` shingles, by differences of running sums."""
    bits = (values[:, None] >> np.arange(64, dtype=np.uint64) & U(1)).astype(np.int32) * 2 - 1
    sums = np.zeros((len(values) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return np.packbits(sums[width:] - sums[:-width] > 0, axis=1, bitorder="little").view(np.uint64)[:, 0]


@dataclass
class Length:
    """The items of one length: ids, shingles, fingerprints and the block tables."""

    ids: np.ndarray
    shingles: list[tuple[np.ndarray, np.ndarray]]
    prints: np.ndarray

    def __post_init__(self):
        blocks = self.prints[:, None].view(np.uint8).reshape(len(self.ids), BLOCKS)
        # tables[b][v]: which items are within BLOCK_DISTANCE of value v in block b.
        self.tables = [np.packbits(_NEAR[:, blocks[:, b]], axis=1) for b in range(BLOCKS)]

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius."""
        windows, items = [], []
        step = max(1, (1 << 22) // len(self.ids))
        for i in range(0, len(prints), step):
            own = prints[i : i + step]
            blocks = own[:, None].view(np.uint8).reshape(len(own), BLOCKS)
            found = self.tables[0][blocks[:, 0]]
            for b in range(1, BLOCKS):
                found = found | self.tables[b][blocks[:, b]]
            window, item = np.nonzero(np.unpackbits(found, axis=1, count=len(self.ids)))
            close = np.bitwise_count(own[window] ^ self.prints[item]) <= RADIUS
            windows.append(window[close] + i)
            items.append(item[close])
        return np.concatenate(windows), np.concatenate(items)


class Items:
    """A block of benchmark items, ready for lookups."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        by_length: dict[int, list] = {}
        lengths_of: dict[int, set[int]] = {}
        at = 0
        for piece in pieces(pa.array(texts, pa.string())):
            for row, values in shingles(piece):
                n = int(piece.counts[row - piece.first])
                if n:
                    distinct, count = np.unique(values, return_counts=True)
                    by_length.setdefault(n, []).append((ids[row], distinct, count, simhash(distinct, count)))
                    for v in distinct.tolist():
                        lengths_of.setdefault(v, set()).add(n)
        self.lengths = {
            n: Length(np.array([r[0] for r in rows], np.int64), [(r[1], r[2]) for r in rows], np.array([r[3] for r in rows], np.uint64))
            for n, rows in by_length.items()
        }
        self.known = np.array(sorted(lengths_of), np.uint64)
        self.known_lengths = [sorted(lengths_of[v]) for v in self.known.tolist()]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.known >> U(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.short = [n for n in self.lengths if n < SHINGLE_WORDS]

    def hits(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of benchmark shingles and their places in ``known``."""
        maybe = np.flatnonzero(self.filter[(values >> U(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(maybe) or not len(self.known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.known, values[maybe]), len(self.known) - 1)
        real = self.known[place] == values[maybe]
        return maybe[real], place[real]


def similarity(a: tuple[np.ndarray, np.ndarray], values: np.ndarray) -> float:
    """Sum of smaller over sum of larger occurrence counts."""
    known, weights = a
    other, counts = np.unique(values, return_counts=True)
    at = np.minimum(np.searchsorted(other, known), len(other) - 1)
    both = int(np.where(other[at] == known, np.minimum(weights, counts[at]), 0).sum())
    return both / (int(weights.sum()) + int(counts.sum()) - both)


def _spans(starts: np.ndarray, n_windows: int, width: int) -> Iterator[tuple[int, int]]:
    """Ranges of window starts that cover a hit, merged."""
    lo, hi = np.maximum(starts - width + 1, 0), np.minimum(starts + 1, n_windows)
    keep = lo < hi
    lo, hi = lo[keep], hi[keep]
    if len(lo):
        new = np.concatenate([[True], lo[1:] > np.maximum.accumulate(hi)[:-1]])
        for a, b in zip(lo[new], np.append(hi[np.flatnonzero(new)[1:] - 1], hi[-1])):
            yield int(a), int(b)


def search(items: Items, words: np.ndarray, values: np.ndarray, threshold: float) -> list[tuple[int, int, int, float, int]]:
    """(item, first word, words, similarity, Hamming distance) of the best window per item.

    ``values`` are the document's 5-word shingles in order; ties go to the first window.
    """
    best: dict[int, tuple] = {}

    def offer(length: Length, n: int, prints: np.ndarray, first: int, shingle_runs) -> None:
        for w, k in zip(*length.near(prints)):
            s = similarity(length.shingles[k], shingle_runs(w))
            item = int(length.ids[k])
            if s >= threshold and (item not in best or (-s, first + w) < (-best[item][3], best[item][1])):
                best[item] = (item, int(first + w), n, s, int(np.bitwise_count(prints[w] ^ length.prints[k])))

    if len(words) >= SHINGLE_WORDS:
        at, place = items.hits(values)
        by_length: dict[int, list[int]] = {}
        for position, p in zip(at.tolist(), place.tolist()):
            for n in items.known_lengths[p]:
                if n >= SHINGLE_WORDS:
                    by_length.setdefault(n, []).append(position)
        for n, starts in by_length.items():
            width = n - SHINGLE_WORDS + 1
            if len(values) < width:
                # Shorter than the item: the document is one window, if it is long enough to reach the threshold.
                if len(values) >= threshold * width:
                    offer(items.lengths[n], len(words), window_simhashes(values, len(values)), 0, lambda w: values)
                continue
            for a, b in _spans(np.array(starts), len(values) - width + 1, width):
                # Very long spans go in steps, so memory does not follow the text.
                for i in range(a, b, 1 << 14):
                    part = values[i : min(b, i + (1 << 14)) + width - 1]
                    offer(items.lengths[n], n, window_simhashes(part, width), i, lambda w, p=part, c=width: p[w : w + c])
    for n in items.short:
        if len(words) >= n:
            runs = np.array([sequence_hash(words[i : i + n]) for i in _short_starts(items, words, n)], np.uint64)
            for i, run in zip(_short_starts(items, words, n), runs):
                offer(items.lengths[n], n, np.array([simhash(np.array([run]))]), i, lambda w, r=run: np.array([r]))
    return list(best.values())


def _short_starts(items: Items, words: np.ndarray, n: int) -> np.ndarray:
    """Windows of fewer than five words that equal an item: their one shingle must be known."""
    return items.hits(sequence_hashes(words, n))[0]


def find_passages(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, items_at_once: int = ITEMS_AT_ONCE,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, similarity, distance) for each passage found.

    One row per row of ``docs`` and item whose best window of the item's length reaches
    the threshold. A-Z is lower-cased. Items without words (null, empty) match nothing;
    items under five words match as whole sequences; a document shorter than an item is one
    window, with ``n_words`` the words it has. Repeated documents repeat their
    rows; rows without an id are searched too. Equal items are found each. An empty table
    gives no rows. Items are sent to the tasks in blocks of bounded size, so a larger
    benchmark means further passes, not larger tasks.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.filter("item_id IS NOT NULL").distinct()
    schema = "doc_id long, item_id long, first_word long, n_words int, similarity double, distance int"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32()]

    def finder(shared):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value)
            for batch in batches:
                keys, out = batch.column(0), []
                for piece in pieces(batch.column(1)):
                    runs, bounds = window_hashes(piece.words, SHINGLE_WORDS), piece.bounds
                    touched = _touched(items, piece, runs, bounds)
                    for i in touched:
                        a, b = bounds[i], bounds[i + 1]
                        for found in search(items, piece.words[a:b], runs[a : max(a, b - SHINGLE_WORDS + 1)], threshold):
                            out.append((keys[piece.first + int(i)].as_py(), *found))
                if out:
                    columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "first_word", "n_words", "similarity", "distance"])

        return find

    found = None
    low = None
    while True:
        rest = rows if low is None else rows.filter(F.struct("item_id", "text") > F.struct(F.lit(low[0]), F.lit(low[1])))
        block = rest.orderBy("item_id", "text").limit(items_at_once).collect()
        if not block and found is not None:
            return found
        shared = spark.sparkContext.broadcast(([r.item_id for r in block], [r.text for r in block]))
        part = texts.mapInArrow(finder(shared), schema)
        found = part if found is None else found.union(part)
        if len(block) < items_at_once:
            return found
        low = block[-1]


def _touched(items: Items, piece, runs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Documents of a piece with a benchmark shingle, or with any word if there are short items."""
    if items.short:
        return np.flatnonzero(piece.counts > 0)
    at, _ = items.hits(runs)
    doc = np.searchsorted(bounds, at, "right") - 1
    return np.unique(doc[at + SHINGLE_WORDS <= bounds[doc + 1]])
