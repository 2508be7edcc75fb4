"""Words and word shingles of Arrow text batches, as whole-array numpy work.

A word is ``[^\\x20\\x09-\\x0D]+``. Hashes are 64-bit: a word's is a sum of random
byte values times powers of an odd base, a shingle's a mix of its words' hashes.
All work runs over pieces of about a megabyte, so memory follows the longest
single text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20
SHINGLE_WORDS = 5
WORD = "[^\\x20\\x09-\\x0D]+"

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(_BASE))
_POS = mix(np.arange(1, 65, dtype=np.uint64) * U(0xD1342543DE82EF95)) | U(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse."""
    return tuple(
        np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]))
        for b in (U(_BASE), U(pow(_BASE, -1, 1 << 64)))
    )


@dataclass
class Piece:
    """Some whole documents of a batch: rows ``first`` to ``first + len(counts)``.

    ``starts`` and ``ends`` are byte positions of the words in ``raw``, ``words``
    their mixed hashes, ``counts`` the words of each document.
    """

    first: int
    raw: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    counts: np.ndarray

    @property
    def bounds(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.counts)])


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document offsets of a string array; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def cut(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text has a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def pieces(texts: pa.Array, lower: bool = True) -> Iterator[Piece]:
    """Word positions and hashes; ``lower`` maps A-Z to a-z first."""
    raw, offsets = text_buffers(texts)
    # Made anew for each batch: tables kept in a module would outlive their tasks.
    up, down = powers(min(PIECE_BYTES, len(raw)))
    for a, b in cut(offsets):
        own = offsets[a : b + 1] - offsets[a]
        part = raw[offsets[a] : offsets[b]]
        part = _LOWER[part] if lower else part
        inside = ~_BLANK[part]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edge = own[:-1][own[:-1] < len(part)]
        before[edge] = False
        after[edge[edge > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        if len(part) >= len(up):
            up, down = powers(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        counts = np.diff(np.searchsorted(starts, own))
        yield Piece(a, part, own, starts, ends, words, counts)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += words[i : i + n] * _POS[i % 64]
    return mix(total)


def sequence_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words taken as a whole short text; kept apart from shingles."""
    total = np.full(len(words) - size + 1, size, np.uint64) * U(_BASE)
    for i in range(size):
        total += words[i : i + len(total)] * _POS[i]
    return mix(total)


def sequence_hash(words: np.ndarray) -> np.uint64:
    """The same of one whole short sequence."""
    return sequence_hashes(words, len(words))[0]


def shingles(piece: Piece, size: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle hashes in text order) of each document, repeats included.

    A document with fewer words than ``size`` has its whole sequence as one
    shingle; one without words has none.
    """
    runs, bounds = window_hashes(piece.words, size), piece.bounds
    for i, n in enumerate(piece.counts):
        at = bounds[i]
        if n >= size:
            yield piece.first + i, runs[at : at + n - size + 1]
        elif n:
            yield piece.first + i, np.array([sequence_hash(piece.words[at : at + n])], np.uint64)
        else:
            yield piece.first + i, np.zeros(0, np.uint64)


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """True where crc32 of the id as text leaves no remainder; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))
