"""Periodic runs of words: stretches that repeat with a period, found by seed and extension.

A run with period q matches itself q words further on over a stretch of at least
max(min_words - q, q) words, the overlap that its length guarantees. Lags are dealt into
bands; the grams of a band are half as long as the overlap its lags guarantee, so every
such stretch holds one gram that starts at a multiple of their length. These grams seed:
each is paired with the equal grams of its document whose distance lies in the band,
which makes at most two pairs per word and band whatever the text repeats. Seeds
are sorted by lag and place; for each lag the furthest word covered so far suppresses
the seeds that an earlier extension has passed. What is left is extended to both sides.

Grams are named by whole numbers, longer ones by the names of their halves, so
equality is exact and no hash decides. A gram that occurs once has no name, and in plain
text hardly any gram of six words has one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.words import Piece, pieces

MIN_WORDS = 12

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def word_names(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Names of the words of a piece with a nameless separator behind each document, and the documents' first places."""
    lengths = piece.ends - piece.starts
    letters = np.zeros(len(piece.raw) + 1, np.int8)
    np.add.at(letters, piece.starts, 1)
    np.add.at(letters, piece.ends, -1)
    body = np.ascontiguousarray(piece.raw[np.cumsum(letters[:-1]).astype(bool)])
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    names = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    names[np.bincount(names, minlength=1)[names] < 2] = -1
    firsts = piece.bounds[:-1] + np.arange(len(piece.counts))
    spaced = np.full(len(names) + len(firsts), -1, np.int64)
    spaced[np.arange(len(names)) + np.repeat(np.arange(len(firsts)), piece.counts)] = names
    return spaced, firsts


def _longer(names: np.ndarray, step: int) -> np.ndarray:
    """Names of the grams made of one gram and another that starts ``step`` words later; -1 where they occur once."""
    out = np.full(len(names), -1, np.int64)
    if step >= len(names):
        return out
    at = np.flatnonzero((names[:-step] >= 0) & (names[step:] >= 0))
    codes, _ = pd.factorize(names[at] * len(names) + names[at + step])
    repeated = np.bincount(codes, minlength=1)[codes] > 1
    out[at[repeated]] = codes[repeated]
    return out


def _seeds(names: np.ndarray, doc: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of grams at multiples of ``size`` and equal ones of their document ``low`` to ``high`` - 1 words on."""
    n = len(names)
    blocks = np.arange(0, n, size)
    blocks = blocks[names[blocks] >= 0]
    wanted = np.zeros(n, bool)
    wanted[names[blocks]] = True
    found = np.flatnonzero(names >= 0)
    found = found[wanted[names[found]]]
    keys = np.sort(names[found] * (2 * n) + found)
    base = names[blocks] * (2 * n) + blocks
    first = np.searchsorted(keys, base + low)
    many = np.searchsorted(keys, base + np.minimum(high, n)) - first
    place = np.repeat(blocks, many)
    order = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
    other = keys[np.repeat(first, many) + order] % (2 * n)
    same = doc[place] == doc[other]
    return place[same], (other - place)[same]


def _extended(levels: list[tuple[int, np.ndarray]], n: int, size: int, place: np.ndarray, lag: np.ndarray):
    """(start, end, lag) of the matching stretches around seeds, each stretch once."""
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    covered = np.concatenate([[-1], place[:-1] + size])
    fresh = (place != covered) | (lag != np.concatenate([[-1], lag[:-1]]))
    heads = np.flatnonzero(fresh)
    last = np.concatenate([heads[1:], [len(place)]]) - 1
    start, end, lag = place[heads], place[last] + size, lag[heads]
    # A neighbouring gram of this size does not match, so each shorter one is tried once.
    for short, names in reversed(levels):
        left = start - short
        name = names[np.maximum(left, 0)]
        start = np.where((left >= 0) & (name >= 0) & (name == names[np.maximum(left, 0) + lag]), left, start)
        there = np.minimum(end + lag, n - 1)
        name = names[there]
        end = np.where((end + lag < n) & (name >= 0) & (name == names[np.minimum(end, n - 1)]), end + short, end)
    return start, end, lag


def runs_of(names: np.ndarray, firsts: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs in a row of word names, by start and period."""
    doc = np.repeat(np.arange(len(firsts)), np.diff(np.concatenate([firsts, [len(names)]])))
    size = (-(-min_words // 2) + 1) // 2
    levels, width = [(1, names)], 1
    while 2 * width <= size:
        levels.append((2 * width, _longer(levels[-1][1], width)))
        width *= 2
    if width < size:
        levels.append((size, _longer(levels[-1][1], size - width)))
    found, low = [np.zeros((0, 3), np.int64)], 1
    while (levels[-1][1] >= 0).any():
        size, names = levels[-1]
        place, lag = _seeds(names, doc, size, low, 4 * size)
        if len(place):
            start, end, lag = _extended(levels[:-1], len(names), size, place, lag)
            runs = np.column_stack([start, end - start + lag, lag])
            found.append(runs[runs[:, 1] >= np.maximum(min_words, 2 * lag)])
        low = 4 * size
        levels.append((2 * size, _longer(names, size)))
    runs = np.concatenate(found)
    # A stretch seen with several periods has the smallest; the others are its multiples.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.concatenate([[True], (np.diff(runs[:, :2], axis=0) != 0).any(1)])[: len(runs)]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _kept_texts(piece: Piece, kept: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    bounds = piece.bounds
    upto = np.concatenate([[0], np.cumsum(kept)])
    docs = upto[bounds]
    starts = piece.starts[kept]
    lengths = (piece.ends - piece.starts)[kept] + 1
    last = docs[1:][docs[1:] > docs[:-1]] - 1
    lengths[last] -= 1
    ends = np.cumsum(lengths)
    raw = np.concatenate([piece.raw, np.zeros(1, np.uint8)])
    spot = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
    body = raw[spot]
    joints = np.ones(len(ends), bool)
    joints[last] = False
    body[ends[joints] - 1] = 32
    offsets = np.concatenate([[0], ends])[docs].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(piece.counts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))).cast(pa.string())


def _piece_rows(piece: Piece, min_words: int) -> tuple[pa.Array, pa.Array]:
    """Lists of runs and collapsed texts of the documents of a piece."""
    names, firsts = word_names(piece)
    runs = runs_of(names, firsts, min_words) if len(names) else np.zeros((0, 3), np.int64)
    drops = np.zeros(len(names) + 1, np.int64)
    np.add.at(drops, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drops, runs[:, 0] + runs[:, 1], -1)
    words = np.delete(np.cumsum(drops[:-1]), firsts + piece.counts)
    doc = np.searchsorted(firsts, runs[:, 0], "right") - 1
    offsets = np.searchsorted(doc, np.arange(len(firsts) + 1)).astype(np.int32)
    fields = [pa.array(v) for v in (runs[:, 0] - firsts[doc], runs[:, 1], runs[:, 2])]
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, fields=list(_RUN)))
    return lists, _kept_texts(piece, words == 0)


def _find(min_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column(1), lower=False):
            ids = batch.column(0).slice(piece.first, len(piece.counts))
            yield pa.RecordBatch.from_arrays([ids, pa.array(piece.counts.astype(np.int64)), *_piece_rows(piece, min_words)], schema=_SCHEMA)


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    ``runs`` are (start, length, period) by start and period: stretches of at least
    ``min_words`` words and two periods, with their smallest period, that no neighbouring
    word extends. ``collapsed`` is the text's words without those that a run holds after
    its first period, joined by one space. Null and empty texts have no words, no runs and an
    empty ``collapsed``; rows of one id are read one by one, also without an id; an empty table
    gives no rows; other columns are not read. Nothing is shuffled. Memory
    follows the longest text: about 8 bytes per word and doubling of the longest repeat.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        lambda b: _find(min_words, b), "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
