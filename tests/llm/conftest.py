import pytest


@pytest.fixture
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    line = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, line + "\n" + "alpha beta gamma delta epsilon zeta", "en", "a", 1),
        (2, line.replace("seven", "SEVEN") + "\n" + "alpha beta gamma delta epsilon eta", "en", "a", 2),
        (3, "alpha beta gamma delta zeta", None, None, None),
        (4, None, "de", "b", 3),
        (5, "", "de", "b", 4),
        (None, line, "en", "c", 5),
        (6, " ".join(f"w{i}" for i in range(3000)), "en", "c", 6),
        (7, " ".join(f"w{i}" if i != 1500 else "other" for i in range(3000)), "en", "c", 7),
        (8, "12345 67 !!", "en", "c", 8),
        (8, "12345 67 !!", "en", "c", 8),
        (9, "aaaa" * 500, "en", "c", 9),
        (10, "\n\n \t\n", "en", "c", 10),
    ]
    return spark.createDataFrame([r + ("x", "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, _doc string, _h string")
