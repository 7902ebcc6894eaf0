import pytest

from salesloom.llm.shared import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)


@pytest.fixture
def texts(spark):
    """documents with more columns than any operator reads, under names that operators use for their own."""

    def build(rows):
        schema = "doc_id long, text string, id int, n int, digest string, node string, label string, tree int, bucket int"
        return spark.createDataFrame([(i, t, 1, 2, "d", "n", "l", 3, 4) for i, t in rows], schema)

    return build
