import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from tessera.llm.common import ship

    ship(spark)


@pytest.fixture(scope="session")
def documents(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in any column, empty and long texts, repeated rows."""
    long = "Thing of the other word, and so on. " * 6000
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "one", "en", "s", 3), (3, "one", "en", "s", 3),
            (None, "a b c d e", "fr", None, 9), (None, None, None, None, None), (4, " \n\t ", "de", "s", 4),
            (5, long, "en", "s", len(long)), (6, long, "en", "s", len(long)), (7, "12 34 !!", None, "s", 8),
            (8, "日本 語 é̀ \x00 😀 ÅÀß", "ja", "s", 5)]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
