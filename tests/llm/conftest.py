import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices("aeioulnrst", k=rng.randint(3, 9))) for _ in range(words)]


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (doc_id, text) pairs."""

    def made(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t) if t else None) for i, t in rows], COLUMNS)

    return made


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    long = " ".join(prose(5, 30_000)) + "x" * 50_000 + " " * 30 + "日本語\n" * 200
    copy = " ".join(prose(6, 300))
    rows = [
        (1, copy, "en", "a", 5), (2, copy, "en", "a", 5), (2, copy, "en", "a", 5), (2, "other words here", None, None, None),
        (None, copy, "en", None, None), (None, None, None, None, None), (None, None, None, None, None), (3, None, "fr", "b", 0),
        (4, "", "de", "b", 0), (4, "", "de", "b", 0), (5, long, "en", "a", 1), (6, long, "en", "c", 1), (7, "\n\t  ,.", "es", "c", 7),
        (8, "a", "en", "c", 1), (9, "<|endoftext|> ÀÉ ▁ 😀 don't", "en", "c", 1), (-3, copy + " tail", "en", "c", 1),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    clash = "uid node root set digest shingles hash place shard slot part row bucket found language posterior accepted size ids"
    return df.selectExpr("*", *(f"'x' as `{c}`" for c in [*clash.split(), "n_words", "n_cut", "spans", "Items", "_host", "a.b"]))
