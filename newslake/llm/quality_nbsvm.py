"""Naive Bayes support vectors: a linear quality classifier over n-gram indicators.

Indicators of byte n-grams (hashed to a table of fixed size) and of runs of one word are scaled by the log ratio
of their smoothed shares in the two classes. A linear model with hinge loss is fitted on
the scaled, length-normed vectors by dual coordinate descent: each step solves one dual
variable exactly and keeps the weights as the sum of the examples. Margins become
probabilities by a logistic curve fitted on examples the model did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.ngrams import distinct_ngrams, labelled_sample
from newslake.llm.words import pieces

SIZES = (1, 3)
BITS = 17
RUNS = (2, 3, 5)
MAX_TRAIN_ROWS = 10_000
_BLOCK = 256


SLOTS = (1 << BITS) + len(RUNS)


def indicators(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row, slot) of the byte n-grams and of n-grams of one word repeated RUNS times."""
    for (first, row, slot), piece in zip(distinct_ngrams(texts, SIZES, BITS), pieces(texts, lower=False)):
        owner = np.repeat(np.arange(len(piece.counts)), piece.counts)
        again = (piece.words[1:] == piece.words[:-1]) & (owner[1:] == owner[:-1])
        upto = np.concatenate([[0], np.cumsum(again)])
        rows, slots = [row], [slot]
        for k, run in enumerate(RUNS):
            full = np.flatnonzero(upto[run - 1 :] - upto[: len(upto) - run + 1] == run - 1) if len(upto) >= run else []
            found = np.unique(owner[full]) if len(full) else np.zeros(0, np.int64)
            rows.append(found)
            slots.append(np.full(len(found), (1 << BITS) + k))
        row, slot = np.concatenate(rows), np.concatenate(slots)
        order = np.argsort(row, kind="stable")
        yield first, row[order], slot[order]


@dataclass
class Model:
    """Weight of each slot, its squared scale (for the norm), and the curve."""

    weights: np.ndarray
    squares: np.ndarray
    slope: float
    shift: float


def log_ratios(rows: list[np.ndarray], y: np.ndarray, slots: int, smooth: float = 1.0) -> np.ndarray:
    """log of each slot's share among the indicators of class 1 over that of class 0."""
    share = []
    for label in (1, 0):
        own = [r for r, v in zip(rows, y) if v == label]
        count = np.zeros(slots, np.int64)
        for i in range(0, len(own), _BLOCK):
            count += np.bincount(np.concatenate(own[i : i + _BLOCK]), minlength=slots)
        share.append(np.log((smooth + count) / (len(own) + 2 * smooth)))
    return share[0] - share[1]


class Scaled:
    """Values of each row: the scales of its slots over their length, made when asked for, as all of them take much memory."""

    def __init__(self, rows: list[np.ndarray], scale: np.ndarray):
        self.rows, self.scale = rows, scale
        self.lengths = [max(np.sqrt((scale[r] ** 2).sum()), 1e-9) for r in rows]

    def __getitem__(self, i: int) -> np.ndarray:
        return self.scale[self.rows[i]] / self.lengths[i]


def dual_coordinate_descent(rows, values, sign, slots: int, cost: float = 1.0, rounds: int = 20, seed: int = 7) -> np.ndarray:
    """Weights of min 1/2 |w|^2 + cost * sum max(0, 1 - sign * w.x); the last weight is the bias."""
    w, alpha = np.zeros(slots + 1), np.zeros(len(rows))
    norms = np.array([values[i] @ values[i] + 1.0 for i in range(len(rows))])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            value = values[i]
            gradient = sign[i] * (w[rows[i]] @ value + w[slots]) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                w[rows[i]] += step * value
                w[slots] += step
                alpha[i] = new
                worst = max(worst, abs(step))
        if worst < 1e-3 * cost:
            break
    return w


def logistic_curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the most likely curve, by Newton steps on smoothed targets."""
    ones, zeros = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, float(np.log((ones + 1) / (zeros + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * a, (p - target).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * margins**2).sum() + 1e-3, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 0.0)), float(b)


def fit(rows: list[np.ndarray], y: np.ndarray, slots: int, blend: float = 0.25) -> Model:
    """Four fifths of the rows fit the weights, the rest the curve. One class alone gives its prior."""
    if not len(rows) or y.min() == y.max():
        ones = int(y.sum()) if len(y) else 0
        return Model(np.zeros(slots + 1), np.zeros(slots), 0.0, float(np.log((ones + 1) / (len(y) - ones + 1))))
    test = np.arange(len(rows)) % 5 == 0
    train = np.flatnonzero(~test)
    own = [rows[i] for i in train]
    scale = log_ratios(own, y[train], slots)
    sign = np.where(y == 1, 1.0, -1.0)
    w = dual_coordinate_descent(own, Scaled(own, scale), sign[train], slots)
    used = np.abs(w[:slots][w[:slots] != 0])
    w[:slots] = (1 - blend) * (used.mean() if len(used) else 0.0) + blend * w[:slots]
    values = Scaled(rows, scale)
    margins = np.array([w[r] @ values[i] + w[slots] for i, r in enumerate(rows)])
    slope, shift = logistic_curve(margins[test], y[test])
    return Model(np.append(w[:slots] * scale, w[slots]), scale**2, slope, shift)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, max_rows, id_col, text_col)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, row, slot in indicators(batch.column(1)):
                last = row[-1] + 1 if len(row) else 0
                ends = np.searchsorted(row, np.arange(last + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(slot.astype(np.int32)))
                own = batch.slice(first, last)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(2), lists], names=["doc_id", "y", "slots"])

    found = sample.mapInArrow(features, "doc_id long, y int, slots array<int>").toArrow().sort_by("doc_id")
    lists = found["slots"].combine_chunks()
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    rows = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    return fit(rows, found["y"].to_numpy(), SLOTS)


def scored(docs: DataFrame, model: Model, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with a probability of class 1 from the whole text, in one column.

    Null and empty texts have no n-grams and get the curve's value at the bias. Repeated
    rows get equal scores. All other columns stay as they are and are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.squares))
    slope, shift = model.slope, model.shift

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        weights, squares = shared.value
        bias, total, square = weights[-1], np.zeros(len(texts)), np.zeros(len(texts))
        for first, row, slot in indicators(texts):
            if len(row):
                n = row[-1] + 1
                total[first : first + n] = np.bincount(row, weights[slot], n)
                square[first : first + n] = np.bincount(row, squares[slot], n)
        margin = total / np.maximum(np.sqrt(square), 1e-9) + bias
        return pa.array(1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30))))

    return docs.withColumn(name, probability(F.col(text_col).cast("string")))
