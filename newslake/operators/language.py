"""Language tagging by character trigrams.

Training sums trigram counts per language with Spark; each task first reduces
its rows to one count per language and bucket. Tagging adds the log weights of a
text's trigrams, which are whole numbers, so their sum does not depend on the order, and takes
the best language. It is a map-side step without a
shuffle and the package's only Python one: it works on Arrow batches with numpy
arrays, many times faster than building a string per trigram.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import clean_text

MIN_SAMPLE_CHARS = 20
#: Bounds the weight table that tasks hold; a profile table of more languages is refused.
MAX_LANGUAGES = 256
#: Log weights are kept in thousandths.
WEIGHT_SCALE = 1000
_BUCKET_BITS = 15
_BUCKETS = 1 << _BUCKET_BITS
_BLANK = ord(" ")

# Tasks get these functions by value, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def language_sample(titre: Column, contenu: Column) -> Column:
    """``titre. contenu``, cleaned."""
    text = F.concat(F.coalesce(titre, F.lit("")), F.lit(". "), F.coalesce(contenu, F.lit("")))
    return clean_text(text)


def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _buckets(text: str, letters: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams of lower-case letters; other runs count as one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = letters[codes]
    if not letter.any():
        return np.empty(0, dtype=np.uint32)
    keep = letter | np.concatenate(([False], letter[:-1]))
    words = np.where(letter, codes, _BLANK)[keep]
    padded = np.concatenate(([_BLANK], words, [_BLANK])).astype(np.uint32)
    mixed = (
        padded[:-2] * np.uint32(0x9E3779B1)
        ^ padded[1:-1] * np.uint32(0x85EBCA6B)
        ^ padded[2:] * np.uint32(0xC2B2AE35)
    )
    return mixed * np.uint32(0x27D4EB2F) >> np.uint32(32 - _BUCKET_BITS)


def train_lang_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Trigram counts ``lang, bucket, n`` of rows with a known language: a small table to store."""
    rows = labelled.where(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), clean_text(F.col(text)).alias("text")
    )
    letters = labelled.sparkSession.sparkContext.broadcast(_letters())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, sample in zip(batch["lang"], batch["text"]):
                total = counts.setdefault(name, np.zeros(_BUCKETS, dtype=np.int64))
                total += np.bincount(_buckets(sample, letters.value), minlength=_BUCKETS)
        for name, total in counts.items():
            used = np.flatnonzero(total)
            yield pd.DataFrame({"lang": name, "bucket": used, "n": total[used]})

    partial = rows.mapInPandas(count, "lang string, bucket long, n long")
    return partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # bucket x language, whole numbers


def load_profiles(profiles: DataFrame) -> LanguageModel:
    """Log weights from a profile table; its size is bounded by languages times buckets."""
    limit = MAX_LANGUAGES * _BUCKETS
    rows = profiles.select("lang", "bucket", "n").limit(limit + 1).toPandas()
    languages = tuple(sorted(rows["lang"].unique()))
    if len(rows) > limit or len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.ones((_BUCKETS, len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    counts[rows["bucket"], rows["lang"].map(place)] += rows["n"]
    return LanguageModel(languages, np.round(WEIGHT_SCALE * np.log(counts / counts.sum(axis=0))).astype(np.int64))


def detect_language(
    df: DataFrame, model: LanguageModel, sample: Column, into: str = "langue"
) -> DataFrame:
    """Add the language tag; null for samples under 20 characters or without letters."""
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.weights, _letters()))

    @F.pandas_udf("string")
    def tag(samples: pd.Series) -> pd.Series:
        languages, weights, letters = shared.value

        def best(text: str | None) -> str | None:
            if text is None or len(text) < MIN_SAMPLE_CHARS:
                return None
            buckets = _buckets(text, letters)
            if not len(buckets):
                return None
            return languages[int(weights[buckets].sum(axis=0).argmax())]

        return samples.map(best)

    return df.withColumn(into, tag(sample))
