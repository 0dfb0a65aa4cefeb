import os

import pytest

from marketloom.llm.queries import REGISTRY
from tests.support import DATA, check, oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return oracle(DATA)


@pytest.mark.parametrize("name", sorted(REGISTRY.oracles))
def test_same_rows_as_sql(name, spark, con):
    check(REGISTRY, name, spark, con)


@pytest.mark.parametrize("name", sorted(REGISTRY.queries.keys() - REGISTRY.oracles.keys()))
def test_runs(name, spark):
    REGISTRY.queries[name](spark, DATA).collect()
