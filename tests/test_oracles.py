"""Every query of the core with SQL gives the same rows as the oracle engine; the others run."""

import os

import pytest

from marketloom.plans import catalogue
from tests.support import DATA, check, oracle

REGISTRY = catalogue.core()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
#: Run by other tests, or too slow to run twice.
HEAVY = {"c1_single_user", "c3_tracked_pool", "c8_lists_by_segment", "c9_submission", "c10_contributions", "g14_bpr", "c2_cascade_top10", "l1_multitask_scores"}


@pytest.fixture(scope="module")
def con():
    return oracle(DATA)


@pytest.mark.parametrize("name", sorted(REGISTRY.oracles))
def test_same_rows_as_sql(name, spark, con):
    check(REGISTRY, name, spark, con)


@pytest.mark.parametrize("name", sorted(REGISTRY.queries.keys() - REGISTRY.oracles.keys() - HEAVY))
def test_runs(name, spark):
    REGISTRY.queries[name](spark, DATA).collect()


def test_every_oracle_has_a_query():
    assert REGISTRY.oracles.keys() <= REGISTRY.queries.keys()


def test_padded_lists_are_complete(spark):
    lists = REGISTRY.queries["c7_padded_cascade"](spark, DATA).toPandas()
    sizes = lists.groupby("user_id").agg(n=("item_id", "size"), items=("item_id", "nunique"), first=("pos", "min"), last=("pos", "max"))
    assert (sizes["n"] == 10).all() and (sizes["items"] == 10).all() and (sizes["first"] == 1).all() and (sizes["last"] == 10).all()
