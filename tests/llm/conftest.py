import pytest

LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, a very long one, repeated rows, ties, extra columns with names that operators use themselves."""
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, LONG), (5, "same words here again and again"), (6, "same words here again and again"), (7, "日本語 🙂 <|endoftext|> naïve É"), (7, "日本語 🙂 <|endoftext|> naïve É"), (None, "no id at all")]
    return spark.createDataFrame([(i, t, "x", "y", 0, 1.5, "z") for i, t in rows], "doc_id long, text string, key string, class string, ids int, x double, source string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
