import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, chunk string, at string"


@pytest.fixture
def table(spark):
    """Documents of (doc_id, text) rows, with columns of other meaning and clashing names."""

    def make(rows):
        return spark.createDataFrame([(i, t, None, "s", None, 7, "x", "y") for i, t in rows], COLUMNS)

    return make


@pytest.fixture
def awkward():
    """Nulls, empty and blank texts, ties, repeated rows, short and very long texts, texts beyond ASCII."""
    long = "".join(f"word{i * 7919 % 5000} " for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "Aa"), (5, "aA"), (5, "aA"), (6, "É"), (7, "é"), (None, "aa"), (8, long), (9, long + "end"), (10, "one two three"),
        (11, "one two three"), (12, "x" * 3000), (13, "日本語 テキスト 🙂" * 20), (14, "日本語 テキスト 🙂" * 20 + "!"), (-5, "tail"),
    ]
