import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Columns that results have as well: no operator may trip over them.
CLASHING = SCHEMA + ", size long, kept boolean, fp long, _text string, rule string"


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""))


ODD_TEXTS = [
    row(1, None),
    row(2, ""),
    row(3, " \n\t "),
    row(4, "one"),
    row(5, "one two three four five " * 40),
    row(5, "one two three four five " * 40),
    row(None, "no id here", None),
    row(6, "Ünïcode 😀 wörds und Ɣ\n" * 3, None),
    row(7, "x" * 50_000 + " " + "long word text " * 5_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, and repeated rows, with columns that clash."""
    rows = [(*r, 9, True, 1, "t", "r") for r in ODD_TEXTS]
    return spark.createDataFrame(rows, CLASHING)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture
def make(spark):
    return lambda *texts: spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA)
