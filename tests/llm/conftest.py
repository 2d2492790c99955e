import pytest


@pytest.fixture(scope="session", autouse=True)
def code(spark):
    from strata.llm.common import ship_code

    ship_code(spark)


@pytest.fixture
def docs(spark):
    """Rows with nulls, empties, a long text, ties, repeated rows and a clashing extra column."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, shingles string, n int")
    return make
