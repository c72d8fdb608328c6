import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, __host string, host int, norm string, `__rest` int, th long"


def rows_of(texts, source="s"):
    """Rows of the documents' columns and of others whose names operators might use themselves."""
    return [(i, t, "en", source, len(t or ""), f"x{i}", "h", i, "n", 7, 1) for i, t in texts]


@pytest.fixture(scope="session")
def docs(spark):
    def make(texts, source="s"):
        pairs = list(enumerate(texts)) if not texts or not isinstance(texts[0], tuple) else texts
        return spark.createDataFrame(rows_of(pairs, source), SCHEMA)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """Documents of the smallest tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture
def odd(docs):
    """Null, empty, blank, long, repeated and tied rows."""
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "  \n\n "), (4, long), (5, "Same text here, for all of us."), (6, "same Text here, for all of us."), (6, "same Text here, for all of us."), (None, "no id"), (8, "é Ünï 漢字 \U0001f600 <|endoftext|>  two  blanks"), (9, None)]
    return docs(rows)

