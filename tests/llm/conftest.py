import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts_of(spark):
    """A table of (doc_id, text) with extra columns whose names clash with inner ones."""

    def build(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        return frame.selectExpr("*", "1 AS _row", "'x' AS _text", "2 AS length", "0 AS shard", "'k' AS key")

    return build
