import pytest

LONG = "alpha beta gamma delta epsilon " * 4000


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty and very long texts, ties, repeated rows and clashing extra columns."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the bank of the river today", "en", "web", 75, "a", 1),
        (1, "The quick brown fox jumps over the lazy dog near the bank of the river today", "en", "web", 75, "a", 1),
        (2, "the QUICK brown fox jumps over the lazy dog near the bank of the river today", "en", "web", 75, "b", 2),
        (3, None, None, None, None, None, None),
        (4, "", "en", "web", 0, "c", 3),
        (5, LONG, "en", "books", len(LONG), "d", 4),
        (6, "  \t\n ", "en", None, 6, "e", 5),
        (7, 'key token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ñandú 漢字 🙂', "es", "code", 60, "f", 6),
        (8, "MIT License.\nPermission is hereby unrelated. Licensed under CC BY-NC 4.0.", "en", "code", 70, "g", 7),
        (None, "a document without an id", "en", "web", 24, "h", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, size int").withColumnRenamed("score", "spans")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
