"""Weak supervision of quality rules, in DataFrame expressions alone.

Each rule votes good (1), bad (-1) or abstains (0). Votes of all documents are counted by
pattern, of which there are at most 3 to the number of rules. Expectation maximisation
over these counts estimates the share of good documents and, for each rule, how often
its vote is right for good and for bad ones. The posterior probability of a document's
pattern, not the passing of every rule, decides whether it is kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake import scratch

BLANK = "[\\x20\\x09-\\x0D]"
SYMBOL = "[#*$%&|<>]"
WINDOW = 8
ROUNDS = 100

_BLANK_CHARS = " \t\n\u000b\u000c\r"


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_distinct, n_upper) of whole texts.

    Null texts measure like empty ones: all zero. Windows are compared by 64-bit hashes.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id",
        F.array_remove(F.split("text", f"{BLANK}+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_BLANK_CHARS)) != "").alias("lines"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
    )
    last = F.size("words") - WINDOW + 1
    rows = rows.select(
        "doc_id", "n_symbols", "n_upper",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(last > 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).alias("runs"),
    )
    # Most texts repeat no window and stop here; the others sort their windows by hash.
    rows = rows.withColumn("ranked", F.when(
        F.size(F.array_distinct("runs")) < F.size("runs"),
        F.array_sort(F.transform("runs", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )).drop("runs")
    twice = F.filter("ranked", lambda x, k: (F.get("ranked", k - 1)["h"] == x["h"]) | (F.get("ranked", k + 1)["h"] == x["h"]))
    rows = rows.withColumn("places", F.array_sort(F.transform(twice, lambda x: x["i"]))).drop("ranked")
    # A repeated window covers its words up to the next repeated one.
    covered = F.transform("places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW))))
    repeat = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeat.alias("n_repeat_words"), "n_lines", "n_distinct", "n_upper"
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes by name over the measures. Wordless texts get abstentions where a rate has no base."""
    n, has = F.col("n_words"), F.col("n_words") > 0
    rate = lambda c, base="n_words": F.col(c) / F.when(F.col(base) > 0, F.col(base))
    never = F.lit(False)
    pick = lambda x, good, bad: F.coalesce(_vote(F.coalesce(good, never), F.coalesce(bad, never)), F.lit(0))
    repeat, symbol, length = rate("n_repeat_words"), rate("n_symbols"), rate("word_chars")
    upper, lines, variety = rate("n_upper", "word_chars"), rate("n_dup_lines", "n_lines"), rate("n_distinct")
    return {
        "length": pick(n, n >= 40, n < 20),
        "repeats": pick(repeat, repeat <= 0.1, repeat > 0.3),
        "symbols": pick(symbol, symbol <= 0.03, symbol > 0.1),
        "lines": pick(lines, has & (F.col("n_dup_lines") == 0), lines > 0.3),
        "word_length": pick(length, (length >= 3.0) & (length <= 9.0), (length < 2.0) | (length > 12.0)),
        "capitals": pick(upper, upper <= 0.1, upper > 0.3),
        "variety": pick(variety, (variety >= 0.35) | (n > 400), (variety < 0.25) & (n <= 400)),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]]]:
    """Log odds of good before any vote, and (weight of a good vote, weight of a bad vote) per rule.

    ``patterns`` are (votes, documents). Starts from rules that are right nine times in ten; two
    documents of each kind are added to every count, so no share becomes 0 or 1. Abstentions
    say nothing. Ends when no share moves by 1e-9.
    """
    patterns = sorted(patterns)
    k = len(patterns[0][0]) if patterns else 0
    prior, right = 0.8, [(0.9, 0.9)] * k
    for _ in range(rounds):
        good = bad = 0.0
        tally = [[0.0, 0.0, 0.0, 0.0] for _ in range(k)]
        for votes, n in patterns:
            log_odds = _log_odds(prior, right, votes)
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, log_odds))))
            good, bad = good + n * p, bad + n * (1 - p)
            for t, v in zip(tally, votes):
                if v:
                    t[0] += n * p * (v > 0)
                    t[1] += n * p
                    t[2] += n * (1 - p) * (v < 0)
                    t[3] += n * (1 - p)
        before = (prior, *right)
        prior = (good + 2) / (good + bad + 4)
        # A rule is never held to be worse than a coin.
        right = [(max((a + 1.8) / (b + 2), 0.5), max((c + 1.8) / (d + 2), 0.5)) for a, b, c, d in tally]
        now = (prior, *right)
        if all(abs(x - y) < 1e-9 for p_, q_ in zip(before, now) for x, y in zip(_flat(p_), _flat(q_))):
            break
    weights = [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in right]
    return math.log(prior / (1 - prior)), weights


def _flat(x) -> tuple:
    return x if isinstance(x, tuple) else (x,)


def _log_odds(prior: float, right: list[tuple[float, float]], votes: tuple[int, ...]) -> float:
    total = math.log(prior / (1 - prior))
    for (g, b), v in zip(right, votes):
        if v:
            total += math.log(g / (1 - b)) if v > 0 else math.log((1 - g) / b)
    return total


def judge(docs: DataFrame, work: str, cut: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures of every row with base_failed, posterior and kept.

    base_failed: under 20 words, or over 30 % of them in repeated windows; such rows are never
    kept. The others are kept if the posterior of good quality reaches ``cut``. Repeated
    rows count and are judged one by one; an empty table gives no rows.
    """
    votes = rules()
    rows = measured(docs, id_col, text_col)
    rows = scratch.stored(rows.withColumns({f"vote_{k}": v for k, v in votes.items()}), f"{work}/votes")
    names = [f"vote_{k}" for k in votes]
    counted = rows.groupBy(*names).count().collect()
    start, weights = estimate([(tuple(r[:-1]), r[-1]) for r in counted])
    odds = F.lit(start)
    for name, (good, bad) in zip(names, weights):
        odds = odds + F.when(F.col(name) > 0, good).when(F.col(name) < 0, bad).otherwise(0.0)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    posterior = 1 / (1 + F.exp(-odds))
    return rows.withColumns({"base_failed": failed, "posterior": posterior, "kept": ~failed & (posterior >= cut)})
