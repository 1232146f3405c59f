import pyarrow.parquet as pq
import pytest

from rowproof.llm import substring

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def rows():
    return pq.read_table(f"{SMALL}/documents.parquet").to_pylist()


@pytest.fixture
def texts(spark):
    """Makes a table of documents from texts, with ids from 0 and columns whose names clash with results."""

    def make(values, ids=None):
        data = [(i if ids is None else ids[i], t, "x", i, "y", None) for i, t in enumerate(values)]
        return spark.createDataFrame(data, "doc_id long, text string, kept string, node int, lang string, id string")

    return make


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(autouse=True)
def few_shares(monkeypatch):
    """Results don't depend on the number of shares (see test_shares_give_one_result); each takes some jobs."""
    monkeypatch.setattr(substring, "SHARES", 1)
