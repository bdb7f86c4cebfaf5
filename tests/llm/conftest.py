import pytest

from fleetlens.llm.common import prepare


@pytest.fixture(autouse=True)
def prepared(spark):
    return prepare(spark)
