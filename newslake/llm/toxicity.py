"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's score is a logistic function of its features; a document is toxic unless
all of its sentences are clean: P = 1 - product(1 - p). The weights are trained from
document labels alone through this noisy-or, so credit goes to the sentences that carry
it, and the same scores then point out the offending sentences.

Features are the distinct word pieces of a sentence, hashed to a table of fixed size:
each whole word and its beginnings of four and five letters, so inflected and compounded
forms share evidence. In scripts written without blanks, whose characters take three bytes
or more, the runs of three characters of a word are pieces too. Pieces are first weighed by how much more often they occur in
toxic documents, over all labelled rows of the training sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake import scratch
from newslake.llm.ngrams import labelled_sample
from newslake.llm.words import U, cut, mix, powers, text_buffers

BITS = 18
STEMS = (4, 5)
MAX_TRAIN_ROWS = 12_000
ROUNDS = 60
LEAST_Z = 3
_SLOTS = 1 << BITS

# Bytes of words: ASCII letters and digits, and all of other scripts.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[10, 33, 46, 63]] = True  # line feed ! . ?
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
#: Letters of a word that are hashed one by one; what follows is hashed as a whole.
_HEAD = 32
# Ends of sentences in other scripts: ideographic full stop, wide full stop ! ?, danda, Arabic question mark.
_WIDE_ENDS = tuple(c.encode() for c in "。．！？।؟")


@dataclass
class Part:
    """Sentences of some whole documents: (sentence, slot) entries, each once per sentence."""

    first: int
    docs: int
    sentence: np.ndarray
    slot: np.ndarray
    doc_of: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def sentences(texts: pa.Array) -> Iterator[Part]:
    """Sentences end after ``. ! ?`` or a line feed and with the document; only those with a word count.

    ``begin`` and ``end`` are byte positions within the document's UTF-8 text.
    """
    raw, offsets = text_buffers(texts)
    for a, b in cut(offsets):
        own = offsets[a : b + 1] - offsets[a]
        part = _LOWER[raw[offsets[a] : offsets[b]]]
        # The second byte of capital Latin letters with marks lies 32 below the small one.
        if len(part) > 1:
            marked = (part[:-1] == 0xC3) & (part[1:] >= 0x80) & (part[1:] <= 0x9E) & (part[1:] != 0x97)
            part[1:][marked] += 32
        ends_here = _ENDS[part]
        inside = _INSIDE[part]
        for mark in _WIDE_ENDS:
            _mark(part, mark, inside, ends_here)
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edge = own[:-1][own[:-1] < len(part)]
        before[edge] = False
        after[edge[edge > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        stops = np.union1d(np.flatnonzero(ends_here) + 1, own[1:])
        place = np.searchsorted(stops, starts, "right")
        used, sentence = np.unique(place, return_inverse=True)
        doc_of = np.searchsorted(own, starts, "right") - 1
        heads = np.flatnonzero(np.diff(sentence, prepend=-1)) if len(starts) else np.zeros(0, np.int64)
        docs = doc_of[heads]
        stop = stops[used] if len(used) else np.zeros(0, np.int64)
        keys = []
        width = ends - starts
        sums = np.zeros(len(starts), np.uint64)
        longest = int(width.max()) if len(width) else 0
        # One letter of all words at a time; words fall out as they end.
        alive = np.arange(len(starts))
        for i in range(min(longest, _HEAD)):
            alive = alive[width[alive] > i]
            sums[alive] = (sums[alive] + part[starts[alive] + i]) * U(_BASE) + U(i + 1)
            if i + 1 in STEMS:
                longer = alive[width[alive] > i + 1]
                keys.append(_keys(sums[longer] ^ U(i + 1), sentence[longer]))
        long = np.flatnonzero(width > _HEAD)
        if len(long):
            sums[long] ^= _range_hashes(part, starts[long] + _HEAD, ends[long])
        keys.append(_keys(sums, sentence))
        keys.append(_wide_keys(part, starts, ends, sentence))
        keys = np.unique(np.concatenate(keys))
        yield Part(a, b - a, (keys >> U(32)).astype(np.int64), (keys & U(0xFFFFFFFF)).astype(np.int64), docs, starts[heads] - own[docs], stop - own[docs])


def _mark(part: np.ndarray, mark: bytes, inside: np.ndarray, ends_here: np.ndarray) -> None:
    """Take the bytes of a mark out of words and end a sentence at its last byte."""
    if len(part) < len(mark) or not (part == mark[0]).any():
        return
    at = np.flatnonzero(np.logical_and.reduce([part[i : len(part) - len(mark) + 1 + i] == b for i, b in enumerate(mark)]))
    for i in range(len(mark)):
        inside[at + i] = False
    ends_here[at + len(mark) - 1] = True


def _range_hashes(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges of any length, from sums of the bytes times powers of an odd base."""
    up, down = powers(len(part))
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + U(1)) * up[: len(part)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _wide_keys(part: np.ndarray, starts: np.ndarray, ends: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """Keys of the runs of three characters in words that hold characters of three bytes or more."""
    wide = np.concatenate([[0], np.cumsum(part >= 0xE0)])
    words = np.flatnonzero(wide[ends] > wide[starts])
    if not len(words):
        return np.zeros(0, np.uint64)
    heads = np.flatnonzero((part & 0xC0) != 0x80)
    tails = np.append(heads[1:], len(part))
    first, last = np.searchsorted(heads, starts[words]), np.searchsorted(heads, ends[words])
    many = np.maximum(last - first - 2, 0)
    at = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return _keys(_range_hashes(part, heads[at], tails[at + 2]) ^ U(3), sentence[np.repeat(words, many)])


def _keys(hashes: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    return (sentence.astype(np.uint64) << U(32)) | (mix(hashes) >> U(64 - BITS))


def noisy_or(margins: np.ndarray, doc_of: np.ndarray, docs: int) -> np.ndarray:
    """Log of the probability that no sentence is toxic, per document."""
    return -np.bincount(doc_of, np.logaddexp(0, margins), docs)


def evidence(slot: np.ndarray, ones: np.ndarray, both: np.ndarray, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots that take part, and their first weights, from how many documents have them.

    A slot needs five documents and a log ratio between the classes LEAST_Z standard errors from
    zero: rare pieces that fall into one class by chance would only be learnt by heart.
    """
    ratio = np.log((ones + 0.5) / (toxic + 1)) - np.log((both - ones + 0.5) / (clean + 1))
    spread = np.sqrt(1 / (ones + 0.5) + 1 / (both - ones + 0.5))
    use = (both >= 5) & (np.abs(ratio) >= LEAST_Z * spread)
    weights = np.zeros(_SLOTS)
    weights[slot[use]] = np.clip(ratio[use], -3, 3)
    mask = np.zeros(_SLOTS, bool)
    mask[slot[use]] = True
    return mask, weights


def fit(sentence: np.ndarray, slot: np.ndarray, doc_of: np.ndarray, y: np.ndarray, weights: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps of adaptive length on the noisy-or likelihood.

    ``doc_of`` has an entry for every sentence, also for those without a slot that takes part.
    Weights decay gently; both classes weigh the same. One class alone gives a constant.
    """
    docs, n = len(y), len(doc_of)
    bias = -6.0
    if not docs or y.min() == y.max():
        return np.zeros(_SLOTS), (5.0 if docs and y.max() else -20.0)
    weights = weights.copy()
    toxic, clean = (y == 1).sum(), (y == 0).sum()
    balance = np.where(y == 1, docs / (2 * toxic), docs / (2 * clean))
    g2, b2 = np.full(_SLOTS, 1e-8), 1e-8
    for _ in range(rounds):
        margins = np.bincount(sentence, weights[slot], n) + bias
        p = 1 / (1 + np.exp(-np.clip(margins, -30, 30)))
        clear = noisy_or(np.clip(margins, -30, 30), doc_of, docs)
        # d log P / d margin of a toxic document's sentence is p (1 - P) / P, of a clean one's -p.
        odds = 1 / np.expm1(np.clip(-clear, 1e-6, 50))
        push = np.where(y == 1, np.minimum(odds, 1e3), -1.0)[doc_of] * p * balance[doc_of] / docs
        g = np.bincount(slot, push[sentence], _SLOTS) - 1e-5 * weights
        gb = push.sum()
        g2, b2 = 0.9 * g2 + g * g, 0.9 * b2 + gb * gb
        weights += np.where(weights != 0, 0.15 * g / np.sqrt(g2 + 1e-12), 0)
        bias += 0.15 * gb / np.sqrt(b2)
    return weights, float(bias)


def train(
    docs: DataFrame, labels: DataFrame, work: str, label: str = "toxic", max_rows: int = MAX_TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[np.ndarray, float]:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold.

    Word pieces are counted in Spark first; only those that take part reach the driver.
    """
    sample = scratch.stored(labelled_sample(docs, labels, label, max_rows, id_col, text_col), f"{work}/sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(2).to_numpy()
            for part in sentences(batch.column(1)):
                pairs = np.unique(part.doc_of[part.sentence] * _SLOTS + part.slot)
                slot, of = np.unique(pairs % _SLOTS, return_inverse=True)
                ones = np.bincount(of, y[part.first + pairs // _SLOTS], len(slot)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(ones), pa.array(np.bincount(of, minlength=len(slot)))], names=["slot", "ones", "n"])

    counted = sample.select("doc_id", "text", "y").mapInArrow(count, "slot long, ones long, n long")
    counted = counted.groupBy("slot").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n")).toArrow()
    total = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    mask, weights = evidence(*[counted[c].to_numpy() for c in ("slot", "ones", "n")], total.get(1, 0), total.get(0, 0))
    shared = docs.sparkSession.sparkContext.broadcast(mask)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sentences(batch.column(1)):
                own = batch.slice(part.first, part.docs)
                places = np.searchsorted(part.doc_of, np.arange(part.docs + 1))
                on = shared.value[part.slot]
                sentence, slot = part.sentence[on], part.slot[on]
                entries = np.searchsorted(sentence, places).astype(np.int32)
                local = sentence - places[part.doc_of[sentence]]
                lists = [pa.ListArray.from_arrays(pa.array(entries), pa.array(x.astype(np.int32))) for x in (local, slot)]
                columns = [own.column(0), own.column(2), pa.array(np.diff(places).astype(np.int32)), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "y", "sentences", "sentence", "slot"])

    found = sample.select("doc_id", "text", "y").mapInArrow(features, "doc_id long, y int, sentences int, sentence array<int>, slot array<int>")
    found = found.toArrow().sort_by("doc_id")
    sizes = found["sentences"].to_numpy().astype(np.int64)
    local, slot = found["sentence"].combine_chunks(), found["slot"].combine_chunks()
    first = np.repeat(np.cumsum(sizes) - sizes, np.diff(local.offsets.to_numpy()))
    sentence = first + local.flatten().to_numpy()
    return fit(sentence, slot.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(found)), sizes), found["y"].to_numpy(), weights)


def scored(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.5, name: str = "toxicity", text_col: str = "text") -> DataFrame:
    """``docs`` with a struct (score, spans): the noisy-or of all sentences, and the toxic ones.

    ``spans`` are (start, end, score) of the sentences that reach ``threshold``, in bytes
    of the UTF-8 text, end exclusive. Texts without a word (null, empty) score 0. Other
    columns stay and are not read; repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    @F.arrow_udf("score double, spans array<struct<start: long, end: long, score: double>>")
    def toxicity(texts: pa.Array) -> pa.Array:
        weights, bias = shared.value
        scores, found, counts = np.zeros(len(texts)), [], np.zeros(len(texts), np.int64)
        for part in sentences(texts):
            margins = np.bincount(part.sentence, weights[part.slot], len(part.doc_of)) + bias
            rows = slice(part.first, part.first + part.docs)
            scores[rows] = -np.expm1(noisy_or(margins, part.doc_of, part.docs))
            p = 1 / (1 + np.exp(-np.clip(margins, -700, 700)))
            hot = np.flatnonzero(p >= threshold)
            counts[rows] = np.bincount(part.doc_of[hot], minlength=part.docs)
            found.append((part.begin[hot], part.end[hot], p[hot]))
        columns = [np.concatenate(c) if c else np.zeros(0) for c in zip(*found)] or [np.zeros(0)] * 3
        values = pa.StructArray.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, span)], fields=list(span))
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return pa.StructArray.from_arrays([pa.array(np.clip(scores, 0, 1)), pa.ListArray.from_arrays(ends, values)], names=["score", "spans"])

    return docs.withColumn(name, toxicity(F.col(text_col).cast("string")))
