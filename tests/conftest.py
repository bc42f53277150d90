import pytest

from checks.compare import session


@pytest.fixture(scope="session")
def spark():
    spark = session("4")
    yield spark
    spark.stop()


@pytest.fixture
def folder(tmp_path):
    return f"file:{tmp_path}"
