import duckdb
import pytest

from tests.conftest import SF0001


@pytest.fixture(scope="session")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF0001}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


#: ids and texts with nulls, empty texts, a very long text, ties and repeated rows
AWKWARD = [
    (1, "one two three four five six seven eight nine ten"), (2, "one two three four five six seven eight nine ten"),
    (2, "one two three four five six seven eight nine ten"), (3, None), (4, ""), (5, " \n\t "), (None, "no id here"),
    (None, None), (6, "word " * 60_000), (7, "a line that is long enough\nshort\na line that is long enough"),
    (8, "A LINE that is long enough \nother"), (9, "\ta line that is long enough\n"), (10, "é" * 300 + "\x00 \x85 end"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows above with extra columns whose names the operators use inside."""
    rows = [(i, t, k, "x", k, 1.5) for k, (i, t) in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, id int, t string, n int, row double")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF0001}/labels.parquet")
