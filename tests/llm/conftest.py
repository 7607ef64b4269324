import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, a clashing extra column."""
    long = " ".join(f"word{k * 7919 % 1000} and" for k in range(4000))
    passage = "a passage of well over one hundred bytes that stands in several of these texts, é and ü included, twice at least. "
    rows = [
        (1, long, "en", "s", 7), (2, long, "en", None, 7), (3, None, "en", "s", None), (4, "", "de", "s", 1),
        (5, "  \t\n", None, "s", 1), (6, "one two", "en", "s", 1), (7, "ONE  two", "en", "s", 1),
        (8, "x " + passage + "y", "en", "s", 1), (9, passage + passage + "it's 12 o'clock", "en", "s", 1),
        (9, passage + passage + "it's 12 o'clock", "en", "s", 1), (10, long + " tail of it", "en", "s", 1),
        (11, "das ist ein Satz und noch ein Satz", "de", "s", 1), (12, "12 34 !?", "en", "s", 1), (13, "x" * 5000, "en", "s", 1),
        (None, "a text without an id", "en", "s", 1), (14, "\u4e2d\u6587 \U0001d4b3\U0001f600 \u00a0 end", None, None, 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
