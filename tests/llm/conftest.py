import pytest

ODD = "doc_id long, text string, lang string, source string, n_chars long, group string, score double, file string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, special strings, clashing column names."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    long = " ".join(f"{w}{i}" for i in range(4000) for w in words.split()[i % 7 :])
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "s1", 43, "g", 0.5, "f"),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "s1", 0, "g", 0.5, "f"),
        (4, long, "en", "s2", len(long), "g", 0.5, "f"),
        (5, "same text\n\ntwice  over\t now", "en", "s1", 5, "g", 0.5, "f"),
        (5, "same text\n\ntwice  over\t now", "en", "s1", 5, "g", 0.5, "f"),
        (6, " lead and trail \n ÉÀ straße Σίσυφος x<|endoftext|>y <|startoftext|> z ", "de", "s1", 5, "g", 0.5, "f"),
        (7, "another text under a repeated id", "fr", None, 5, "g", 0.5, "f"),
        (7, "a third text under a repeated id", None, "s3", 5, "g", 0.5, "f"),
        (None, "no id here", "en", "s1", 5, "g", 0.5, "f"),
        (9, "   ́combining 漢字かな 12345 ... !!!", "en", "s1", 5, "g", 0.5, "f"),
        (10, "x" * 50_000, "en", "s1", 5, "g", 0.5, "f"),
    ]
    return spark.createDataFrame(rows, ODD).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD)
