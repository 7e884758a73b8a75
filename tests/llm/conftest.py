import pytest

from tests.conftest import SF_SMALL

#: A table with nulls in every column, empty and long texts, ties, repeated rows and columns that bear operators' names.
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, spans string, n_lines long, hits string, shard long"
LONG = " ".join(f"word{i % 977} thing{i % 31}." for i in range(30000))
ODD = [
    (1, "", "en", "a", 0), (2, None, "en", "a", None), (None, "no id here at all, but a text of some words.", "en", "a", 1),
    (3, "one two three four five six seven eight nine", "en", "a", 1), (3, "one two three four five six seven eight nine", "en", "a", 1),
    (4, "one two three four five six seven eight nine", None, None, 1), (5, LONG, "en", "b", 1), (6, LONG + " more", "en", "b", 1),
    (7, "x", "de", "b", 1), (8, " \n\n \t ", "de", "b", 1), (9, "é" * 300, "fr", "b", 1), (10, "a" * 70000, "fr", "c", 1),
    (None, None, None, None, None), (11, "\U0001F600 中文 " * 20, "zh", "c", 1), (12, "l1 a b\nl2 c d\nl3 e f\nl1 a b\nl2 c d\nl3 e f", "en", "c", 1),
    (3, "the same id with another text of nine words", "en", "a", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(*r, 0.5, "r", "s", 7, "h", 1) for r in ODD], ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def docs10(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]
