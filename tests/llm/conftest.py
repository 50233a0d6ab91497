import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score string, _id string"

LONG = "alpha beta gamma delta epsilon zeta eta theta " * 4000

ROWS = [
    (1, "one two three four five six seven", "en", "a"),
    (2, "One  two three\tfour five six seven", "en", "a"),  # equal but for white space and case
    (3, "one two three four five six seven", "en", None),
    (4, None, None, None),
    (5, "", "en", "b"),
    (6, " \t\n", "en", "b"),
    (7, "word", "en", "b"),
    (7, "word", "en", "b"),  # a repeated row
    (None, "no id here but a text of some words", "en", "c"),
    (None, None, None, "c"),
    (8, LONG, "en", "a"),
    (9, LONG + "omega", "en", "a"),
    (10, "naïve café Σίσυφος 漢字 😀 <|endoftext|> end\x00\x1c", "fr", "c"),
]


@pytest.fixture(scope="session")
def hard(spark):
    """Nulls in every column, empty and very long texts, repeated rows, extra columns with the operators' own names."""
    rows = [(i, t, lang, s, len(t or ""), 5, "x", "y") for i, t, lang, s in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)

