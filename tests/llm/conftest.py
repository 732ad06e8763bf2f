import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def table(spark):
    """A small table from rows and a schema string."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
