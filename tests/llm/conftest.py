import pytest

from tests.llm import tables


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    return tables.write(spark, tables.awkward_rows(), tables.SCHEMA, tmp_path_factory.mktemp("awkward"))


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    return tables.write(spark, [], tables.SCHEMA, tmp_path_factory.mktemp("empty"), files=1)
