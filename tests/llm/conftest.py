import pytest

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{k % 977} and{k % 31}," for k in range(40_000))
    rows = [
        (None, None, None, None, None),
        (None, "a b c d e f", "en", None, 11),
        (1, None, "en", "s", None),
        (2, "", "en", "s", 0),
        (3, " \n\t ", None, "s", 4),
        (4, long_text, "en", "s", len(long_text)),
        (5, long_text, "en", "t", len(long_text)),
        (6, "one two three", "en", "t", 13),
        (6, "one two three", "en", "t", 13),
        (7, "one two three", "en", "t", 13),
        (8, "<|endoftext|> you \x1c idiot moron ퟿", "en", "t", 30),
    ]
    return spark.createDataFrame(
        [(*row, k, "x", 0.5, 7, "y") for k, row in enumerate(rows)],
        DOCS + ", length long, h string, score double, node long, kept string",
    )


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
