import pytest

SF = "/root/testdata/sf0.001"
ODD = [
    (5, None), (1, ""), (2, "   \n\t "), (None, "no id here at all"), (7, "same text twice"), (7, "same text twice"),
    (9, "x" * 50_000), (10, " ".join(f"w{i}" for i in range(9_000))), (11, "Ünïcode é² ½ 日本語   text"),
    (12, "a  <|endoftext|> b"), (None, None),
]


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns whose names clash with results."""
    rows = [(i, t, "k", 1, "x") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, component_id int, words string")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def small_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def make_docs(spark):
    def make(texts):
        rows = list(texts.items()) if isinstance(texts, dict) else list(enumerate(texts))
        return spark.createDataFrame(rows, "doc_id long, text string")

    return make
