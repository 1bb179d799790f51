"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference

from ordertide.plans.oracle import ORACLE
from ordertide.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert difference(QUERIES[name](spark, FOLDER).toPandas(), db.execute(ORACLE[name]).df()) is None
