import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep string, bucket int"

P = "The quick brown fox jumps over the lazy dog while seven wizards watch the silent river flow past their small stone house"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    texts = [None, "", "   ", "a", "A", P, P.upper(), P + " again", "x " + P, P, "é" * 60, "ab " * 8000, "z" * 70_000, "\n".join(["same line here"] * 30), "token = 'abcdEFGH1234ijkl' and mail a.b@c.de, 10.0.0.1", "\x00 \x1c　odd spaces"]
    rows = [(i, t, None, "s", None, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[5]], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
