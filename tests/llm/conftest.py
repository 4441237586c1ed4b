import pytest

from annualis.llm.common import configure

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    return configure(spark)


@pytest.fixture(scope="session")
def docs(llm):
    """The smallest test table."""
    return llm.read.parquet(f"{SF}/documents.parquet")


LONG = " ".join(f"word{k % 977}" for k in range(30_000))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, "
          "fingerprint string, spans string, ids string, th long, base string, start long")


def row(doc_id, text):
    return doc_id, text, None, None, None, None, 0.5, "x", "y", "z", 7, "b", 3


@pytest.fixture(scope="session")
def odd(llm):
    """Null ids and texts, an empty text, a very long one, copies, repeated rows, and columns whose
    names clash with those the operators add."""
    return llm.createDataFrame([
        row(1, "alpha beta gamma delta"), row(2, "alpha beta gamma delta"), row(2, "alpha beta gamma delta"),
        row(3, None), row(4, ""), row(None, "alpha beta gamma delta"), row(None, None), row(5, LONG),
        row(6, LONG + " tail"), row(7, "  \n\t "), row(8, "mail a.b@c.example.com now")], SCHEMA)


@pytest.fixture(scope="session")
def none(llm):
    return llm.createDataFrame([], SCHEMA)
