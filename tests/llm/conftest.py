import pytest
from hard_rows import HARD

SF = "/root/testdata/sf0.01"

@pytest.fixture(scope="session")
def hard(spark):
    """Awkward documents with extra columns whose names the operators use themselves."""
    rows = [(*r, "x", 1, 2.0, True, 7) for r in HARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, "
                                       "shard int, size double, kept boolean, `a.b` int")


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
