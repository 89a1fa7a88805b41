import pytest


@pytest.fixture
def documents(spark):
    """Rows with nulls, empty and long texts, repeats, and further columns with clashing names."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", 0.5, 1, len(t or "")) for i, t in rows],
                                     "doc_id long, text string, lang string, score double, part int, n_chars long")
    return make


ODD = [(1, None), (2, ""), (3, "one"), (4, "the same text twice over here"), (4, "the same text twice over here"),
       (5, "the same text twice over here"), (None, "a text without an id"), (7, "ab " * 30_000), (8, " \n\t "),
       (9, "It's 3.14  and\n\nmore é 日本語 <|endoftext|>")]


@pytest.fixture
def odd(documents):
    return documents(ODD)
