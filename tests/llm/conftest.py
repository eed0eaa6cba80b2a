import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and blank texts, repeated rows, a long text and a clashing extra column."""
    rows = [
        (1, None, "a"), (2, "", "b"), (3, "  \n\t ", None), (None, "no id here", "c"),
        (5, "same words again and again", "d"), (5, "same words again and again", "d"),
        (6, "é ñ ß ÀÉ İ Σ ﬁ 12.5% <|endoftext|> don't |", "e"),
        (7, "word " * 40_000 + "end", "f"), (8, "one", "g"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, part string")
