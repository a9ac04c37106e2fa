import pytest

#: Texts with every awkward case: null, empty, blank, very long, repeated, other scripts.
LONG = " ".join(f"word{i % 977} thing{i % 1013}" for i in range(30_000))
TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "The quick brown fox jumps over the lazy dog near the old river bank today",
    "The quick brown fox jumps over the lazy dog near the old river bank today",
    "THE quick brown fox jumps over the lazy dog near the old river bank today",
    "l'été à la plage, 漢字 \x00 🙂 １２３",
    LONG,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, n long, row string"


@pytest.fixture
def awkward(spark):
    """Documents with nulls in every column, repeated rows, and columns named like helpers."""
    rows = [(i, t, "en", "s", len(t or ""), "x", 1, "y") for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "no id here", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
