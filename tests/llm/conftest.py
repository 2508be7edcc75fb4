import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))


@pytest.fixture(scope="session")
def documents(spark):
    """Small rows with every odd case: nulls, empty and long texts, ties, repeats, a clashing extra column."""
    body = " ".join(f"word{i % 97} and{i % 13}" for i in range(120))
    near = body.replace("word50", "other", 1)
    texts = [
        (1, body, "en", "a"), (2, near, "en", "a"), (3, body, "en", "b"), (4, "", "en", None), (5, None, "fr", "b"),
        (6, "two words", "en", "c"), (7, "Two WORDS", None, "c"), (8, "\n \t", "en", "c"), (None, body, "en", "a"),
        (9, "é ñ 日本 — <|endoftext|> don't stop", "es", ""), (9, "é ñ 日本 — <|endoftext|> don't stop", "es", ""),
        (10, " ".join(f"w{i}" for i in range(30_000)), "en", "a"),
    ]
    return spark.createDataFrame(
        [(*t, 0, "x", 7) for t in texts], "doc_id long, text string, lang string, source string, n_chars long, size string, _id int"
    )


@pytest.fixture()
def work(tmp_path):
    return str(tmp_path / "work")
