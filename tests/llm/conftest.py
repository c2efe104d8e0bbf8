import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, ties, repeated rows, long and empty texts and clashing extra columns."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    base = " ".join(f"alpha{i}" for i in range(60))
    near = base.replace("alpha30", "beta")
    rows = [(1, base, "en", "s1"), (2, near, "en", "s1"), (3, base, "en", "s2"), (3, base, "en", "s2"),
            (4, None, "en", "s1"), (5, "", None, "s1"), (6, "   \n\t ", "en", None), (7, "One two", "en", "s1"),
            (8, "one TWO", "en", "s1"), (9, long_text, "de", "s2"), (None, base, "en", "s1"), (10, "x", None, None),
            (11, "é ü ß z \U0001f600 á   end", "fr", "s3"),
            (12, " ".join(f"gamma{i}" for i in range(40)), "en", "s1")]
    schema = "doc_id long, text string, lang string, source string"
    return spark.createDataFrame(rows, schema).selectExpr(
        "doc_id", "text", "lang", "source", "cast(length(text) as bigint) as n_chars", "7 as part", "'k' as kind",
        "false as kept", "3 as n_words", "'t' as key", "1 as uid", "2 as n")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
